"""Reader for the Parquet tables a run starts from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Full scan of one Parquet table ``<base_dir>/<name>.parquet``.

    Column pruning and filter push-down reach the scan because callers only
    express projections/filters on the returned frame.
    """
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
