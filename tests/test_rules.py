"""Standardization and validation: a row just inside and just outside each
bound, and a NULL row (FIXTURES.md §1)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.constants import TRIP_COLUMNS
from farelake.operators.standardize import standardize_trips
from farelake.operators.validate import valid_fares, valid_trips

AS_OF = "2026-01-01 00:00:00"

RAW_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.LongType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.DoubleType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("payment_type", T.LongType()),
    ]
    + [
        T.StructField(c, T.DoubleType())
        for c in TRIP_COLUMNS[10:]
    ]
)

BASE = dict(
    VendorID=1,
    tpep_pickup_datetime=dt.datetime(2024, 5, 1, 10, 0),
    tpep_dropoff_datetime=dt.datetime(2024, 5, 1, 10, 30),
    passenger_count=1.0,
    trip_distance=2.0,
    RatecodeID=1.0,
    store_and_fwd_flag="N",
    PULocationID=10,
    DOLocationID=20,
    payment_type=1,
    fare_amount=10.0,
    extra=1.0,
    mta_tax=0.5,
    tip_amount=2.0,
    tolls_amount=0.0,
    improvement_surcharge=1.0,
    total_amount=15.0,
    congestion_surcharge=2.5,
    airport_fee=0.0,
    cbd_congestion_fee=0.75,
)


def rows(spark, *changes):
    data = []
    for change in changes:
        row = dict(BASE)
        row.update(change)
        data.append(tuple(row[c] for c in TRIP_COLUMNS))
    return spark.createDataFrame(data, RAW_SCHEMA)


def test_standardize_defaults_and_casts(spark):
    df = rows(
        spark,
        {"passenger_count": None, "RatecodeID": None, "store_and_fwd_flag": " y "},
        {"fare_amount": None, "store_and_fwd_flag": "x", "payment_type": None},
        {"store_and_fwd_flag": None, "airport_fee": None},
    )
    out = standardize_trips(df).collect()
    assert out[0]["passenger_count"] == 0 and out[0]["RatecodeID"] == 99 and out[0]["store_and_fwd_flag"] == "Y"
    assert out[1]["fare_amount"] == 0 and out[1]["store_and_fwd_flag"] == "U" and out[1]["payment_type"] is None
    assert out[2]["store_and_fwd_flag"] == "U" and out[2]["airport_fee"] == 0
    assert standardize_trips(df).columns == TRIP_COLUMNS
    assert dict(standardize_trips(df).dtypes)["passenger_count"] == "int"


@pytest.mark.parametrize("vendor,kept", [(1, True), (2, True), (6, True), (7, True), (4, False), (None, False)])
def test_vendor_filter(spark, vendor, kept):
    assert (standardize_trips(rows(spark, {"VendorID": vendor})).count() == 1) == kept


@pytest.mark.parametrize(
    "change,kept",
    [
        ({"tpep_pickup_datetime": dt.datetime(1999, 12, 31, 23, 59)}, False),
        ({"tpep_pickup_datetime": dt.datetime(2000, 1, 1), "tpep_dropoff_datetime": dt.datetime(2000, 1, 1, 1)}, True),
        ({"tpep_pickup_datetime": dt.datetime(2026, 1, 1), "tpep_dropoff_datetime": dt.datetime(2026, 1, 2)}, True),
        ({"tpep_pickup_datetime": dt.datetime(2026, 1, 1, 0, 1), "tpep_dropoff_datetime": dt.datetime(2026, 1, 2)}, False),
        ({"tpep_dropoff_datetime": dt.datetime(2024, 5, 1, 10, 0)}, False),
        ({"tpep_dropoff_datetime": dt.datetime(2024, 5, 1, 9, 0)}, False),
        ({"PULocationID": None}, False),
        ({"PULocationID": 0}, False),
        ({"PULocationID": 1}, True),
        ({"PULocationID": 263}, True),
        ({"DOLocationID": 264}, False),
    ],
)
def test_valid_trips_bounds(spark, change, kept):
    out = valid_trips(standardize_trips(rows(spark, change)), AS_OF)
    assert (out.count() == 1) == kept


@pytest.mark.parametrize(
    "change,kept",
    [
        ({"passenger_count": None}, False),
        ({"passenger_count": 0.0}, False),
        ({"trip_distance": None}, False),
        ({"trip_distance": 0.0, "fare_amount": 0.0}, True),
        ({"payment_type": None}, False),
        ({"payment_type": 0}, True),
        ({"payment_type": 6}, True),
        ({"payment_type": 7}, False),
        ({"airport_fee": -1.75}, True),
        ({"cbd_congestion_fee": -0.75}, False),
        ({"cbd_congestion_fee": None}, True),
        ({"tip_amount": -0.01}, False),
        ({"tip_amount": None}, True),
        ({"improvement_surcharge": -1.0}, False),
        ({"congestion_surcharge": -2.5}, False),
        ({"total_amount": -1.0}, False),
    ],
)
def test_valid_fares_rules(spark, change, kept):
    out = valid_fares(valid_trips(standardize_trips(rows(spark, change)), AS_OF))
    assert (out.count() == 1) == kept


def test_standardize_is_idempotent_on_processed_rows(spark):
    df = standardize_trips(rows(spark, {}, {"store_and_fwd_flag": "Y"}))
    again = standardize_trips(df)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, again.collect()))


def test_filters_collapse_into_one_scan_stage(spark, small_dir):
    from farelake.plans.catalog import processed

    plan = processed(spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert plan.count("FileScan") == 1


def test_predicates_reach_the_scan_on_landed_files(spark, small_dir, tmp_path):
    from farelake.operators.validate import processed_trips
    from farelake.sources.trips import raw_trips, read_landing

    path = str(tmp_path / "landing")
    raw_trips(spark, small_dir).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    plan = processed_trips(read_landing(spark, path), AS_OF)._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.splitlines() if "FileScan" in ln][0]
    pushed = scan.split("PushedFilters: [")[1].split("], ReadSchema")[0]
    for predicate in ["In(VendorID", "LessThanOrEqual(tpep_pickup_datetime", "GreaterThanOrEqual(PULocationID",
                      "LessThanOrEqual(DOLocationID"]:
        assert predicate in pushed, (predicate, pushed)


def test_stored_sql_step_with_named_parameters(spark, small_dir, tmp_path):
    from farelake.plans.catalog import standardized
    from farelake.sources.sql_text import load_sql, run_sql

    path = tmp_path / "trip_bounds.sql"
    path.write_text(
        "SELECT * FROM {trips}\n"
        "WHERE tpep_pickup_datetime < tpep_dropoff_datetime\n"
        "  AND tpep_pickup_datetime BETWEEN CAST(:lo AS TIMESTAMP_NTZ) AND CAST(:as_of AS TIMESTAMP_NTZ)\n"
        "  AND PULocationID BETWEEN 1 AND 263 AND DOLocationID BETWEEN 1 AND 263;\n"
    )
    trips = standardized(spark, small_dir)
    text = load_sql(spark, str(path))
    out = run_sql(spark, text, {"lo": "2000-01-01 00:00:00", "as_of": AS_OF}, trips=trips)
    expected = valid_trips(trips, AS_OF)
    assert out.count() == expected.count() and out.exceptAll(expected).count() == 0


def test_string_columns_are_parsed(spark):
    df = rows(spark, {}, {"passenger_count": None, "extra": None}).withColumns(
        {c: F.col(c).cast("string") for c in ("passenger_count", "RatecodeID", "payment_type", "extra", "tip_amount")}
    )
    bad = df.limit(1).withColumns({c: F.lit("n/a") for c in ("passenger_count", "RatecodeID", "extra")})
    got = standardize_trips(df.union(bad)).orderBy("passenger_count").collect()
    assert [r["passenger_count"] for r in got] == [None, 0, 1]
    assert [r["extra"] for r in got] == [None, 0.0, 1.0]
    assert got[2]["RatecodeID"] == 1 and got[2]["payment_type"] == 1 and got[0]["RatecodeID"] is None
    assert dict(standardize_trips(df).dtypes)["tip_amount"] == "double"


def test_landing_drift(spark, tmp_path):
    from farelake.sources.landing import SchemaLog, read_landing, schema_drift

    path = str(tmp_path / "landing")
    first = rows(spark, {"passenger_count": 2.0}, {"passenger_count": None})
    first.drop("cbd_congestion_fee").write.parquet(f"{path}/a")
    first.withColumn("passenger_count", F.col("passenger_count").cast("bigint")).write.parquet(f"{path}/b")
    first.withColumns({"extra": F.lit("2.5"), "sensor": F.lit(1)}).write.parquet(f"{path}/c")
    landed = read_landing(spark, path)
    assert landed.columns == [*TRIP_COLUMNS, "sensor"] and landed.count() == 6
    assert dict(landed.dtypes)["passenger_count"] == "double" and dict(landed.dtypes)["cbd_congestion_fee"] == "double"
    assert landed.filter("passenger_count = 2").count() == 3
    assert landed.filter("cbd_congestion_fee is null").count() == 2 and landed.filter("extra is null").count() == 0
    drift = schema_drift(spark, path, SchemaLog(spark, str(tmp_path / "log"))).collect()
    assert {(r["column"], r["change"]) for r in drift} >= {
        ("cbd_congestion_fee", "missing"), ("passenger_count", "type: bigint"), ("extra", "type: string"), ("sensor", "extra"),
    }
    # a landing where the column is absent everywhere
    only = str(tmp_path / "only")
    first.drop("cbd_congestion_fee").write.parquet(only)
    assert read_landing(spark, only).filter("cbd_congestion_fee is null").count() == 2
