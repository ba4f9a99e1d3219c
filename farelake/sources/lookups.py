"""Lookup sources: the zone CSV and the literal dictionaries.

The zone lookup arrives as a CSV with a header row and is read without
schema inference, so every column is a string (``LocationID`` included).
For the driver's tables the lookup rows are derived from the whole ``part``
table joined to ``region``: ``LocationID = p_partkey % 241`` (several rows per
id, so golden-record selection has work to do; ids 241..263 stay unknown so
the fact's LEFT joins see unmatched zones), ``Borough = r_name``,
``Zone = p_name``, ``service_zone = p_brand``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.constants import RATECODES, VENDORS
from farelake.sources.tables import read_table

ZONE_LOOKUP_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.StringType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

ZONE_ID_DOMAIN = 241


def zone_lookup_rows(spark: SparkSession, base_dir: str) -> DataFrame:
    """Zone lookup rows (all strings) derived from ``part`` ⋈ ``region``.

    ``region`` has five rows by definition of the schema, so the planner's
    size-based broadcast of it is safe; no hint is forced.
    """
    part = read_table(spark, base_dir, "part").select("p_partkey", "p_name", "p_brand")
    region = read_table(spark, base_dir, "region").select("r_regionkey", "r_name")
    joined = part.join(region, (part.p_partkey % 5).cast("int") == region.r_regionkey, "inner")
    return joined.select(
        (F.col("p_partkey") % ZONE_ID_DOMAIN).cast("string").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("p_name").alias("Zone"),
        F.col("p_brand").alias("service_zone"),
    )


def write_zone_csv(rows: DataFrame, path: str) -> None:
    """Land lookup rows as a CSV folder with a header row."""
    rows.write.mode("overwrite").option("header", "true").csv(path)


def read_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    """S3: header=true, every column a string, no inference pass over the data."""
    return spark.read.option("header", "true").schema(ZONE_LOOKUP_SCHEMA).csv(path)


def vendor_dictionary(spark: SparkSession) -> DataFrame:
    """The literal vendor rows (vendorid BIGINT, vendor_name STRING)."""
    return spark.createDataFrame(VENDORS, "vendorid BIGINT, vendor_name STRING")


def ratecode_dictionary(spark: SparkSession) -> DataFrame:
    """The literal rate-code rows (ratecodeid BIGINT, ratecode_desc STRING)."""
    return spark.createDataFrame(RATECODES, "ratecodeid BIGINT, ratecode_desc STRING")
