"""L2: daily metrics of a stream of facts, in event time.

A file stream over landed facts with a watermark on the pickup time: a day and
vendor is one window of state, and a window is written once, when the watermark
has passed its end. A trip that is late by less than ``delay`` still counts; one
whose window has been written is dropped, and counted as dropped. State is one
row of partial measures per open window, whatever the number of trips.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.operators.curated import finished, partial_measures


@dataclass
class StreamedDays:
    rows: int
    dropped: int


def stream_daily_metrics(
    spark: SparkSession, facts: str, out: str, checkpoint: str, schema: T.StructType, delay: str = "2 days"
) -> StreamedDays:
    """Take up the facts that landed since the last run; append the days that are closed now."""
    trips = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(facts)
    days = (
        trips.withColumn("at", F.col("tpep_pickup_datetime").cast("timestamp"))
        .withWatermark("at", delay)
        .groupBy(F.window("at", "1 day").alias("w"), "vendor_name")
        .agg(*partial_measures())
    )
    measures = [c for c in days.columns if c not in ("w", "vendor_name")]
    query = (
        days.select(F.col("w.start").cast("timestamp_ntz").alias("trip_date"), "vendor_name", *measures)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    progress = query.recentProgress
    dropped = sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])
    return StreamedDays(sum(p["numInputRows"] for p in progress), dropped)


def streamed_metrics(spark: SparkSession, out: str) -> DataFrame:
    """The daily metrics of the days that were written."""
    return finished("daily_metrics", spark.read.parquet(out))
