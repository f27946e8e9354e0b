"""Sinks, deliveries and request files."""

import datetime as dt
import time
import json

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from carelens.operators import quality
from carelens.schemas import RAW_ENCOUNTER_SCHEMA
from carelens.sources import io
from carelens.streaming import landing


def test_rows_are_counted_by_the_write(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = spark.range(100).selectExpr("id", "id % 3 split", "if(id % 10 = 0, null, 'x,y') s").mapInArrow(touch, "id long, split long, s string")
    for n, suffix in enumerate((".csv", ".json", ".parquet"), 1):
        info = io.write_table(df, str(tmp_path / f"t{suffix}"))
        assert info["rows"] == 100 and info["columns"] == 3 and reads.value == 100 * n  # evaluated once
        back = io.read_table(spark, info["path"], df.schema)
        assert back.where("s is null").count() == 10 and back.schema == df.schema
    assert io.write_table(df.where("false"), str(tmp_path / "none.parquet"))["rows"] == 0
    # the session still serialises plans with a freshly fitted model
    x = VectorAssembler(inputCols=["id"], outputCol="features").transform(spark.range(50).selectExpr("id", "cast(id % 2 as double) label"))
    assert LogisticRegression(maxIter=2).fit(x).transform(x).select("probability").count() == 50
    assert LogisticRegression(maxIter=2).fit(x).transform(x).select("probability").first() is not None
    assert not [t for t in spark.catalog.listTables("global_temp") if t.name.startswith("carelens_write_")]


def test_rewriting_one_split_leaves_the_others(spark, tmp_path):
    df = spark.range(60).selectExpr("id", "case when id < 40 then 'train' when id < 50 then 'val' else 'test' end split")
    path = str(tmp_path / "splits")
    assert io.persist_splits(df, path)["rows"] == 60
    again = io.persist_splits(df.where("split = 'val'").withColumn("id", F.col("id") + 1000), path)
    assert again["rows"] == 10
    back = spark.read.parquet(again["path"])
    assert {r["split"]: r["n"] for r in back.groupBy("split").agg(F.count("*").alias("n")).collect()} == {"train": 40, "val": 10, "test": 10}
    assert back.where("split = 'val' and id < 1000").count() == 0
    io.persist_splits(df.where("split = 'val'"), path, replace="all")
    assert spark.read.parquet(again["path"]).count() == 10


def encounters(spark, day, n, start=0):
    rows = [(f"E{start + i}", f"P{i % 4}", day, day, *[None] * (len(RAW_ENCOUNTER_SCHEMA) - 4)) for i in range(n)]
    return spark.createDataFrame(rows, RAW_ENCOUNTER_SCHEMA)


def test_a_files_folder_is_found_without_searching_the_path(spark):
    paths = ["file:///a/b%20c/part-0.parquet", "s3://bucket/x/y=1/z.parquet", "viewfs://store/in/2024-01-02-again/q"]
    found = spark.createDataFrame([(p,) for p in paths], "p string").select(landing.folder_of(F.col("p")).alias("f"))
    assert [r.f for r in found.collect()] == ["b%20c", "y=1", "2024-01-02-again"]
    rows = spark.range(200_000).select(F.concat(F.lit("file:///" + "long-folder-name-of-a-scratch-table/" * 8), "id", F.lit("/part-00000.parquet")).alias("p"))

    def seconds(column):
        started = time.perf_counter()
        rows.agg(F.max(F.length(column))).collect()
        return time.perf_counter() - started

    searched = F.regexp_extract("p", "([^/]+)/[^/]+$", 1)
    assert rows.where(searched != landing.folder_of(F.col("p"))).count() == 0
    assert min(seconds(landing.folder_of(F.col("p"))) for _ in range(3)) < seconds(searched) / 2


def test_a_delivery_sent_again_adds_nothing(spark, tmp_path):
    land, raw = str(tmp_path / "landing"), str(tmp_path / "raw")
    one, two = encounters(spark, dt.date(2024, 1, 1), 30), encounters(spark, dt.date(2024, 1, 2), 20, 100)
    one.repartition(2).write.parquet(f"{land}/2024-01-01")
    one.repartition(5).write.parquet(f"{land}/2024-01-01-copy")  # in the same round
    assert landing.ingest(spark, land, raw).count() == 1
    one.repartition(1).write.parquet(f"{land}/again")  # in a later round
    two.write.parquet(f"{land}/2024-01-02")
    found = landing.ingest(spark, land, raw).collect()
    assert [(r.delivery, r.rows) for r in found] == [("2024-01-02", 20)]
    assert landing.ingest(spark, land, raw).count() == 0  # nothing new
    corrected = two.withColumn("sex", F.when(F.col("encounter_id") == "E100", "F"))
    corrected.write.parquet(f"{land}/2024-01-02-corrected")
    assert landing.ingest(spark, land, raw).count() == 1
    assert landing.raw_rows(spark, raw).count() == 70 and landing.raw_rows(spark, raw).schema == RAW_ENCOUNTER_SCHEMA
    assert sorted(r.delivery for r in landing.manifest(spark, raw).collect())[1:] == ["2024-01-02", "2024-01-02-corrected"]
    assert landing.raw_rows(spark, str(tmp_path / "nowhere")).count() == 0


REC = {"encounter_id": "E", "age": 70, "sex": "F", "insurance_type": "A", "admission_type": "Emergency", "discharge_disposition": "SNF",
       "length_of_stay": 5, "comorbidity_count": 2, "charlson_index": 3.0, "prior_admissions_12mo": 4, "prior_ed_visits_12mo": 2,
       "num_medications": 9, "bmi": 27.0, "systolic_bp": 130.0, "glucose_level": 110.0, "creatinine": 1.1}


def test_large_request_files_are_read_by_lines(spark, tmp_path):
    lines = [json.dumps({**REC, "encounter_id": f"E{i}"}) for i in range(5000)]
    lines[7], lines[4000] = "{broken", "[]"
    (tmp_path / "large.json").write_text("\n".join(["# no JSON first", *lines, ""]))
    (tmp_path / "small.json").write_text(json.dumps({"data": [REC, {**REC, "age": 500}]}, indent=2))
    (tmp_path / "small_good.json").write_text(json.dumps({"data": [REC, REC]}, indent=2))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        docs = io.request_documents(spark, str(tmp_path / "*.json"), whole_bytes=4096)
        assert docs.where(F.col("file").endswith("large.json")).rdd.getNumPartitions() > 4  # read in splits
        plan = docs._jdf.queryExecution().optimizedPlan().toString()
        assert "file_size" in plan
        parsed = io.parse_requests(docs)
        good, bad = io.split_requests(parsed)
        assert good.where("not is_batch").count() == 4998 and good.where("is_batch").count() == 2
        assert bad.where("envelope_error is not null").count() == 3 and bad.where("is_batch").count() == 2
        assert "accepted" not in good.columns and bad.where("size(failures) > 0").count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_gate_report_names_the_failures(spark):
    df = encounters(spark, dt.date(2024, 1, 1), 5).withColumn("sex", F.lit("?"))
    results = quality.run_expectations(df)
    r = quality.gate_report(results).first()
    failed = results.where("not success").orderBy("idx").collect()
    assert r.failed == len(failed) > 0 and r.failures.split(", ")[0].startswith("expect_column_values")
    with pytest.raises(quality.ValidationError, match="in_set|sex"):
        quality.validation_gate(results)
    assert quality.gate_report(results.where("success")).first() == (0, "")
