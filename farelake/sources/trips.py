"""Raw trip sources.

``raw_trips`` maps the driver's ``lineitem`` table onto the 20-column raw trip
layout (FIXTURES.md §A). Money is divided by 7 so that no half-cent ties reach
``round``; dates move by ten years so that most trips pass the year-2000 bound.
Every filter stage rejects something on this data.

``farelake.sources.landing`` reads folders of landed files whose schema may drift.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farelake.sources.landing import read_landing  # noqa: F401 - callers also find it here
from farelake.sources.tables import read_table

# SQL expressions of the adapter; they also run unchanged in DuckDB.
RAW_TRIP_EXPRESSIONS: list[str] = [
    "CAST(CASE l_suppkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 6 WHEN 3 THEN 7 ELSE 4 END AS BIGINT) AS VendorID",
    "l_shipdate + INTERVAL '10' YEAR + CAST((l_partkey * 37 + l_orderkey) % 1440 AS INT) * INTERVAL '1' MINUTE AS tpep_pickup_datetime",
    "l_shipdate + INTERVAL '10' YEAR + CAST((l_partkey * 37 + l_orderkey) % 1440 + CAST(l_quantity AS BIGINT) - 2 AS INT) * INTERVAL '1' MINUTE AS tpep_dropoff_datetime",
    "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_linenumber - 1 AS DOUBLE) END AS passenger_count",
    "CASE WHEN l_orderkey % 50 = 0 THEN 0.0E0 WHEN l_orderkey % 50 = 1 THEN NULL ELSE l_quantity / 2 END AS trip_distance",
    "CASE WHEN l_partkey % 8 = 7 THEN NULL ELSE CAST(l_partkey % 8 AS DOUBLE) END AS RatecodeID",
    "CASE l_returnflag WHEN 'R' THEN ' y ' WHEN 'N' THEN 'N' ELSE NULL END AS store_and_fwd_flag",
    "l_partkey % 266 AS PULocationID",
    "(l_partkey + l_suppkey) % 266 AS DOLocationID",
    "CAST(l_linenumber AS BIGINT) AS payment_type",
    "CASE WHEN l_orderkey % 40 = 3 THEN -l_extendedprice / 7 ELSE l_extendedprice / 7 END AS fare_amount",
    "CASE WHEN l_orderkey % 20 = 7 THEN NULL ELSE 1.0E0 END AS extra",
    "l_tax AS mta_tax",
    "CASE WHEN l_orderkey % 30 = 5 THEN NULL ELSE l_discount * l_extendedprice / 7 END AS tip_amount",
    "CASE WHEN l_orderkey % 25 = 4 THEN 6.94E0 ELSE 0.0E0 END AS tolls_amount",
    "CASE WHEN l_orderkey % 60 = 9 THEN -1.0E0 ELSE 1.0E0 END AS improvement_surcharge",
    "CASE WHEN l_orderkey % 45 = 8 THEN l_discount * l_extendedprice / 7 ELSE l_extendedprice / 7 * (1 + l_tax) + l_discount * l_extendedprice / 7 END AS total_amount",
    "CASE WHEN l_orderkey % 70 = 11 THEN NULL ELSE 2.5E0 END AS congestion_surcharge",
    "CASE WHEN l_partkey % 266 = 132 THEN 1.75E0 ELSE NULL END AS airport_fee",
    "CASE WHEN l_orderkey % 80 = 12 THEN -0.75E0 WHEN l_orderkey % 80 = 13 THEN NULL ELSE 0.75E0 END AS cbd_congestion_fee",
]


def raw_trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """The 20 raw trip columns derived row-by-row from ``lineitem`` (no shuffle)."""
    return lineitem.selectExpr(*RAW_TRIP_EXPRESSIONS)


def raw_trips(spark: SparkSession, base_dir: str) -> DataFrame:
    """Full scan of the raw trip landing (adapter over ``lineitem``)."""
    return raw_trips_from_lineitem(read_table(spark, base_dir, "lineitem"))
