"""The stages of the corpus pipeline: each applies one operator to all that its predecessor kept.

Every function takes (spark, docs, sf_dir); all but the last return the columns of documents. JVMs
and Python workers live through all stages, so those with Python tasks bound the batches between them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm.bpe import encode_documents
from carelens.llm.bytecnn import identify_language
from carelens.llm.common import free_name, small_batches, written
from carelens.llm.mixing import mix_documents
from carelens.llm.queries import remainder, tokenizer_file
from carelens.llm.simhash import near_duplicates
from carelens.llm.suffixes import dedup_documents

#: The least probability of a text's predicted language; texts that mix languages fall below.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a letter whose language the network tells with ``LEAST_SCORE``."""
    small_batches(docs.sparkSession)
    columns = tuple(docs.columns)
    found = identify_language(docs, remainder(3) == 1, carry=columns)
    kept = found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return kept.select(*[F.col(f"`carry_{c}`").alias(c) for c in columns])


#: Words of 64 bits in the table that tells most rows apart before anything is shuffled.
BITMAP_WORDS = 1 << 17


def apart(rows: DataFrame, key: str, keys: DataFrame, words: int = BITMAP_WORDS) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``key`` is surely not in ``keys``, all others), by a bitmap over a hash of the key.

    The bitmap has a row per word, ``words`` at most, so it is broadcast whatever the keys are: with
    more keys than bits it tells fewer rows apart, which costs a shuffle of more rows later."""
    bit = F.pmod(F.xxhash64(key), F.lit(words * 64))
    one = keys.select(F.floor(bit / 64).alias("__word"), F.expr(f"shiftleft(1L, cast(pmod(pmod(xxhash64({key}), {words * 64}), 64) as int))").alias("b"))
    table = one.groupBy("__word").agg(F.bit_or("b").alias("__bits"))
    marked = rows.join(F.broadcast(table), F.floor(bit / 64) == F.col("__word"), "left")
    hit = F.coalesce(F.expr(f"(shiftrightunsigned(__bits, cast(pmod(pmod(xxhash64({key}), {words * 64}), 64) as int)) & 1L) = 1"), F.lit(False))
    return marked.where(~hit).drop("__word", "__bits"), marked.where(hit).drop("__word", "__bits")


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component: the one with the smallest id, and one row of
    those that repeat its id (an id whose rows fall in several components stays if it is the smallest
    of one). Rows without an id stand behind all others, in order of a text hash.

    Most ids are kept and occur once. Only the others (to be dropped, or repeated) are looked up: a
    bitmap of them passes most rows on where they are, and the rest is joined exactly."""
    small_batches(docs.sparkSession)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    key = free_name(docs.columns, "__id")
    stand_in = F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 2) + F.lit(1 << 62)
    named = docs.withColumn(key, F.coalesce("doc_id", stand_in))
    groups = near_duplicates(named, doc_id=key)
    ids = groups.groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias("n"), F.max(F.col("doc_id") == F.col("component_id")).alias("stays"))
    others = written(ids.where("n > 1 OR NOT stays").select(key, "stays"), "other-ids")
    plain, rest = apart(named, key, others)
    rest = rest.join(others.withColumnRenamed(key, "__k"), F.col(key) == F.col("__k"), "left")
    once = rest.where("stays IS NULL").select(*columns)
    first = rest.where("stays").groupBy(key).agg(F.min(F.struct(*columns)).alias("__row")).select("__row.*")
    return plain.select(*columns).unionByName(once).unionByName(first)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages out of all texts; ``n_chars`` follows the text."""
    small_batches(docs.sparkSession)
    cut = dedup_documents(docs)
    return cut.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes).get("n_chars", "bigint"))) if "n_chars" in docs.columns else cut


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: every document as often as its plan says."""
    return mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, with their digests."""
    small_batches(docs.sparkSession)
    return encode_documents(docs, tokenizer_file("byte_bpe_50k.tiktoken"), with_ids=True)
