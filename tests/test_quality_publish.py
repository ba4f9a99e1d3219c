"""DQ rules/gate and the typed publish contracts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from farelake.operators import publish, quality


def test_rules_count_nulls_as_violations(spark):
    df = spark.createDataFrame(
        [(1, 6, 1, 1, 1.0, 1.0), (4, None, None, 2, -1.0, 0.0), (None, 7, 3, None, None, -2.0)],
        "vendorid long, payment_type long, pulocationid long, dolocationid long, total_amount double, fare_amount double",
    )
    report = {r["Rule"]: r for r in quality.dq_report(df).collect()}
    assert report['ColumnValues "vendorid" in [1, 2, 6, 7]']["failed_rows"] == 2
    assert report['ColumnValues "payment_type" <= 6']["failed_rows"] == 2
    assert report['IsComplete "pulocationid"']["failed_rows"] == 1
    assert report['ColumnValues "total_amount" >= 0']["FailureReason"] == "2 of 3 rows failed"
    assert quality.evaluate_gate(df).decision == "QUARANTINE"
    assert quality.evaluate_gate(df.limit(1)).decision == "PUBLISH"


def test_missing_column_is_error_and_blocks(spark):
    df = spark.createDataFrame([(1,)], "vendorid long")
    report = quality.dq_report(df).collect()
    assert {r["Outcome"] for r in report} == {"Passed", "Error"}
    assert quality.evaluate_gate(df).decision == "QUARANTINE"
    assert quality.evaluate_gate(df, block_on_error=False).decision == "PUBLISH"
    assert quality.gate_decision(quality.dq_report(df)).first()["error_rules"] == 5


def test_quarantine_run_id(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert quality.quarantine_rows(df, "2026-03-04 05:06:07").first()["quarantine_run_id"] == "20260304_0506"


def test_publish_positional_rename_and_types(spark, tmp_path):
    df = spark.createDataFrame([("Helix", 3, 0.01)], "vendor_name string, total_trips long, revenue_in_M double")
    path = str(tmp_path / "vp")
    publish.publish(df, publish.CONTRACTS_BY_NAME["vendor_performance"], path)
    out = spark.read.parquet(path)
    assert out.columns == ["vendor_name", "total_trips", "revenue"]
    assert out.first()["revenue"] == 0.01


def test_publish_rejects_too_long_strings(spark, tmp_path):
    df = spark.createDataFrame([("x" * 51, 1, 1.0)], "vendor_name string, total_trips long, revenue_in_M double")
    with pytest.raises(Exception, match="longer than 50 bytes"):
        publish.publish(df, publish.CONTRACTS_BY_NAME["vendor_performance"], str(tmp_path / "bad"))


def test_publish_wrong_width_fails_fast(spark):
    df = spark.createDataFrame([("x", 1)], "a string, b long")
    with pytest.raises(ValueError):
        publish.conform(df, publish.CONTRACTS_BY_NAME["vendor_performance"])


def test_publish_all_reports_skips(spark, tmp_path):
    df = spark.createDataFrame([("x", 1)], "a string, b long")
    report = dict((t, s) for t, s, _ in publish.publish_all({"vendor_performance": df}, str(tmp_path)))
    assert report["vendor_performance"] == "SKIPPED" and report["dim_zones"] == "SKIPPED"


def test_fact_layout_splits_hot_key(spark):
    df = spark.range(0, 2000).select(
        F.lit(132).alias("pulocationid"), (F.col("id") * 86400).cast("timestamp").alias("tpep_pickup_datetime")
    )
    contract = publish.TableContract("t", (), "curated", dist_key="pulocationid", sort_keys=("tpep_pickup_datetime",))
    laid = publish.lay_out(df, contract)
    # AQE would merge these tiny partitions; at scale they are full-size
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [n for n in laid.rdd.glom().map(len).collect() if n]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1  # one hot zone still spreads over several partitions


def test_fact_layout_splits_one_zone_on_one_day(spark, tmp_path):
    df = spark.range(0, 60000, numPartitions=8).select(
        F.lit(132).alias("pulocationid"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(86400))).alias("tpep_pickup_datetime"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    contract = publish.TableContract("t", (), "curated", dist_key="pulocationid", sort_keys=("tpep_pickup_datetime",))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        publish.lay_out(df, contract).write.parquet(str(tmp_path / "fact"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    written = spark.read.parquet(str(tmp_path / "fact"))
    files = written.withColumn("f", F.input_file_name()).groupBy("f").count().collect()
    assert written.columns == df.columns and sum(r["count"] for r in files) == 60000
    assert len(files) > 3 and max(r["count"] for r in files) < 30000
    for r in files:
        times = [x[0] for x in spark.read.parquet(r["f"]).select("tpep_pickup_datetime").collect()]
        assert times == sorted(times)


def test_publish_modes_overwrite_or_append(spark, tmp_path):
    df = spark.createDataFrame([("Helix", 3, 0.01)], "vendor_name string, total_trips long, revenue_in_M double")
    root = str(tmp_path / "wh")
    for _ in range(2):
        publish.publish_all({"vendor_performance": df, "location_performance": None}, root)
    assert spark.read.parquet(f"{root}/vendor_performance").count() == 1
    publish.publish_all({"vendor_performance": df}, root, modes={"vendor_performance": "append"})
    assert spark.read.parquet(f"{root}/vendor_performance").count() == 2
