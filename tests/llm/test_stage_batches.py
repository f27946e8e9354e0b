"""The pipeline's stages hand texts to Python workers in small Arrow batches."""

import pyarrow as pa
import pytest

import corpus_pipeline
from carelens.llm import common, stages

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def batch_setting(spark):
    before = spark.conf.get(common.BATCH)
    spark.conf.unset(common.BATCH)
    yield
    spark.conf.set(common.BATCH, before)


def documents(spark, n=40, size=200_000):
    rows = spark.range(n).selectExpr("id AS doc_id", f"repeat(concat('word', id, ' '), {size} div 8) AS text", "'en' AS lang", "'web' AS source")
    return rows.selectExpr("*", "cast(length(text) AS long) AS n_chars").coalesce(1)


def largest_batch(docs):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    return docs.mapInArrow(run, "n long").agg({"n": "max"}).first()[0]


@pytest.mark.parametrize("name", ["language", "near_duplicates", "repeated_passages", "encode"])
def test_a_stage_bounds_the_batches_of_its_lazy_result(spark, batch_setting, name):
    empty = spark.createDataFrame([], SCHEMA)
    dict(corpus_pipeline.STAGES)[name](spark, empty, "")
    docs = documents(spark)
    assert docs.agg({"n_chars": "sum"}).first()[0] > 3 * common.BATCH_BYTES
    assert largest_batch(docs) < 1.5 * common.BATCH_BYTES


def test_a_smaller_setting_stays(spark, batch_setting):
    spark.conf.set(common.BATCH, "1m")
    stages.small_batches(spark)
    assert spark.conf.get(common.BATCH) in ("1m", str(1 << 20), f"{1 << 20}b")


def test_batches_do_not_change_what_a_stage_returns(spark, batch_setting):
    docs = documents(spark, 8, 1_000_000)
    docs = docs.unionAll(docs.selectExpr("doc_id + 100", "concat('new ', text)", "lang", "source", "n_chars")).coalesce(1)
    large = {r["doc_id"]: r["text"] for r in stages.dedup_documents(docs).select("doc_id", "text").collect()}
    small = {r["doc_id"]: r["text"] for r in stages.repeated_passages(spark, docs, "").select("doc_id", "text").collect()}
    assert len(large) == 16 and small == large
    assert all(len(small[i + 100]) < 100 for i in range(8))
