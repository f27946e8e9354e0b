"""The corpus pipeline: documents -> language filter -> near-duplicate removal -> repeated-passage
removal -> source mix -> token ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame. ``run`` writes each stage's result to the shared checkpoint folder as Parquet and
rereads it as the next stage's input, so a lost executor repeats one stage's tasks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelens.llm import stages
from carelens.llm.common import written

STAGES = [
    ("language", stages.language),
    ("near_duplicates", stages.near_duplicates_stage),
    ("repeated_passages", stages.repeated_passages),
    ("mix", stages.mix),
    ("encode", stages.encode),
]

#: SQL has no trained language model and no BPE; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
