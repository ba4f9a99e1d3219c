"""Master-data landings derived from the driver's tables.

* ``vendor_names``: the vendor list to de-duplicate, one row per distinct
  ``part.p_name`` with the smallest ``p_partkey`` as its id (a partial +
  final aggregate over the whole ``part`` table).
* ``vendor_parts``: the same names with one row per ``p_partkey``, so names
  repeat.
* ``vendor_master`` / ``ratecode_master``: the vendor and rate-code master
  lists, every row of ``supplier`` and ``nation``.
* ``order_activity``: one landing of a customer-activity dimension from the
  orders of a time slice — the latest order of each customer (golden record)
  gives ``last_order_date``, ``last_order_status``, ``last_order_priority``.
  Two consecutive slices are two landings of the same dimension, the natural
  input of SCD2: some customers reappear (new version), some do not
  (untouched), some are new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.config import DEFAULT_JOB
from farelake.functions.columns import ts_literal_like
from farelake.operators.golden import audit_block, top_per_key
from farelake.sources.tables import read_table

ACTIVITY_SPLIT = "1998-01-01 00:00:00"


def vendor_names(spark: SparkSession, base_dir: str) -> DataFrame:
    part = read_table(spark, base_dir, "part").select("p_partkey", "p_name")
    return (
        part.filter(F.col("p_name").isNotNull())
        .groupBy("p_name")
        .agg(F.min("p_partkey").alias("vendorid"))
        .select("vendorid", F.col("p_name").alias("vendor_name"))
    )


def vendor_parts(spark: SparkSession, base_dir: str) -> DataFrame:
    part = read_table(spark, base_dir, "part")
    return part.select(F.col("p_partkey").alias("vendorid"), F.col("p_name").alias("vendor_name"))


def vendor_master(spark: SparkSession, base_dir: str) -> DataFrame:
    supplier = read_table(spark, base_dir, "supplier")
    return supplier.select(
        F.col("s_suppkey").cast("bigint").alias("vendorid"), F.col("s_name").alias("vendor_name")
    )


def ratecode_master(spark: SparkSession, base_dir: str) -> DataFrame:
    nation = read_table(spark, base_dir, "nation")
    return nation.select(
        F.col("n_nationkey").cast("bigint").alias("ratecodeid"), F.col("n_name").alias("ratecode_desc")
    )


def order_activity(
    spark: SparkSession,
    base_dir: str,
    as_of: str,
    since: str | None = None,
    until: str | None = None,
    job_name: str = DEFAULT_JOB,
) -> DataFrame:
    """Activity landing for orders with ``since <= o_orderdate < until``."""
    orders = read_table(spark, base_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"
    )
    if since is not None:
        orders = orders.filter(F.col("o_orderdate") >= ts_literal_like(orders, "o_orderdate", since))
    if until is not None:
        orders = orders.filter(F.col("o_orderdate") < ts_literal_like(orders, "o_orderdate", until))
    latest = top_per_key(
        orders.filter(F.col("o_custkey").isNotNull()),
        "o_custkey",
        [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()],
    )
    return latest.select(
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderdate").alias("last_order_date"),
        F.col("o_orderstatus").alias("last_order_status"),
        F.col("o_orderpriority").alias("last_order_priority"),
        *audit_block(as_of, job_name),
    )
