"""Run a stored SQL step over a DataFrame.

Rule sets that users keep as SQL text run through ``spark.sql`` with the
input frames bound by name (``{trips}`` in the text, no global temp view) and
run parameters bound as named markers (``:as_of``), so the clock is a
parameter here too. The text is a small file read once on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load_sql(spark: SparkSession, path: str) -> str:
    """Read one SQL file (local or shared storage) as a single string."""
    return spark.read.text(path, wholetext=True).first()[0].strip().rstrip(";")


def run_sql(spark: SparkSession, text: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """``spark.sql(text, args, **frames)``: ``{name}`` refers to ``frames[name]``."""
    return spark.sql(text, args=args or {}, **frames)
