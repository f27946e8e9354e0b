"""The ``opN_`` queries: each applies its operator to the whole of its table and derives the
contract's columns from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.automaton import score_texts

    scored = score_texts(table(spark, sf_dir, "documents"), remainder(5) != 1)
    return scored.select("doc_id", F.coalesce(remainder(5) == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.mixing import mix_plan

    return mix_plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken", "mix.copies")


def tokenizer_file(name: str) -> bytes:
    """A public vocabulary file, read on the driver (at most a few megabytes) and sent with the tasks."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.bpe import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.kdtree import top_k

    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.suffixes import dedup_report

    return dedup_report(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.transducer import token_counts

    return token_counts(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def remainder(divisor: int) -> Column:
    """crc32 of the id as text, modulo."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.bytecnn import identify_language

    return identify_language(table(spark, sf_dir, "documents"), remainder(3) == 1)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.bytecnn import score_quality

    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder(4) == 2)


def op10_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.repetition import repetition_rules

    return repetition_rules(table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.centroids import cluster

    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256")
    return cluster(table(spark, sf_dir, "embeddings")).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest)


def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.periods import periodic_runs

    found = periodic_runs(table(spark, sf_dir, "documents"), seed=F.crc32(F.col("doc_id").cast("string")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.col2")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"), F.expr("1000 * best.length div -best.col3").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelens.llm.contamination import contamination

    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


OP2_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         (CAST(CAST('0x' || substr(md5('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)
           / 4503599627370496.0 AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS weight,
             CAST(3.0 AS DOUBLE) * source_size AS cap FROM s),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER o, 0.0))
                / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0.0)) AS level
      FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, least(cap, coalesce(max(CASE WHEN cap >= level * weight THEN level END) OVER (), 0.0) * weight) AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS ratio FROM t),
f AS (SELECT *, CAST(floor(ratio) AS BIGINT) AS whole, ratio - floor(ratio) AS fraction FROM r),
q AS (SELECT d.rid, d.doc_id, d.source, d.size, f.source_size, f.target, f.whole, f.fraction * f.source_size AS open,
             CASE WHEN fraction > 0 THEN (u / (1 - u)) / (fraction / (1 - fraction)) ELSE 0.0 END AS rnk
      FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source),
m AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rnk, doc_id NULLS FIRST, size, rid ROWS UNBOUNDED PRECEDING) AS so_far
      FROM q WHERE open > 0),
g AS (SELECT *, open - coalesce(max(CASE WHEN so_far <= open THEN so_far END) OVER (PARTITION BY source), 0) AS gap FROM m),
n AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rnk, doc_id NULLS FIRST, size, rid ROWS UNBOUNDED PRECEDING) AS filled
      FROM g WHERE so_far > open AND size < 2 * gap),
p AS (SELECT rid FROM g WHERE so_far <= open UNION ALL SELECT rid FROM n WHERE filled - 0.5 * size <= gap),
c AS (SELECT q.*, whole + CASE WHEN p.rid IS NULL THEN 0 ELSE 1 END AS copies FROM q LEFT JOIN p USING (rid))
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, copies FROM c
"""

OP5_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT a.vec_id AS query_id, b.vec_id,
             CAST(list_sum([z[1] * z[2] FOR z IN list_zip(a.q, b.q)]) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP13_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
i AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
p AS MATERIALIZED (
  SELECT DISTINCT item_id, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS gram
  FROM (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS pos FROM i WHERE len(w) > 0)),
g AS (
  SELECT rid, pos, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS gram
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM d, (SELECT DISTINCT size FROM p) WHERE len(w) >= size)),
m AS MATERIALIZED (SELECT g.rid, g.pos, g.size, p.item_id FROM g JOIN p USING (size, gram)),
h AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(pos, pos + size)) AS place FROM m) GROUP BY rid),
t AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
      FROM m GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid)
"""


def _op11_sql(k: int = 8, rounds: int = 10) -> str:
    """One assignment and one update per round; ``cs`` is the list of centroids."""
    near = """SELECT v.*, list_min(ds) AS distance, list_position(ds, list_min(ds)) - 1 AS cluster
  FROM (SELECT v.*, c.cs, [CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(v.q, c.cs[i])]) AS BIGINT)
                           FOR i IN range(1, len(c.cs) + 1)] AS ds FROM v, c{0} c) v"""
    parts = [f"""
v AS MATERIALIZED (
  SELECT vec_id, [CAST(greatest(least(floor(1024 * CAST(x AS DOUBLE)), 134217728), -134217728) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS MATERIALIZED (
  SELECT list(q ORDER BY h NULLS LAST, q) AS cs
  FROM (SELECT q, sha256('3:' || CAST(vec_id AS VARCHAR)) AS h FROM v ORDER BY h NULLS LAST, q LIMIT {k}))"""]
    for i in range(rounds):
        parts.append(f"""
a{i} AS MATERIALIZED (SELECT cluster, q FROM ({near.format(i)})),
m{i} AS (SELECT cluster, j, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n
  FROM (SELECT cluster, unnest(q) AS x, unnest(range(1, 65)) AS j FROM a{i}) GROUP BY cluster, j),
u{i} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS q FROM m{i} GROUP BY cluster),
c{i + 1} AS MATERIALIZED (
  SELECT list(coalesce(u.q, o.q) ORDER BY o.cluster) AS cs
  FROM (SELECT unnest(cs) AS q, unnest(range(0, len(cs))) AS cluster FROM c{i}) o LEFT JOIN u{i} u USING (cluster))""")
    return "WITH" + ",".join(parts) + f""",
f AS MATERIALIZED (SELECT vec_id, cluster, distance, v.cs[cluster + 1] AS centroid FROM ({near.format(rounds)}) v)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(centroid, ',')) AS centroid_sha256
FROM f"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_automaton": op1_automaton,
    "op2_mix": op2_mix,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_simhash": op4_simhash,
    "op5_kdtree": op5_kdtree,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_language": op8_language,
    "op9_quality": op9_quality,
    "op10_repetition": op10_repetition,
    "op11_centroids": op11_centroids,
    "op12_periods": op12_periods,
    "op13_contamination": op13_contamination,
}
SQL: dict[str, str] = {"op2_mix": OP2_SQL, "op5_kdtree": OP5_SQL, "op11_centroids": _op11_sql(), "op13_contamination": OP13_SQL}
