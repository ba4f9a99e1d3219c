"""Operator 6: rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair gets a pseudorandom draw ``u`` in (0, 1) from two
chained XXH64 hashes; the record goes to the shard with the smallest
``-ln(u) / weight``. A shard therefore receives a share of the keys in
proportion to its weight, and adding a shard moves only the keys whose new
draw wins, all of them into the new shard. There is no shuffle and no state:
the shard is a column expression.

Slots number the rows of a shard from 0 without gaps. Rows are spread over
``buckets`` hash buckets per shard; a bounded table of bucket counts gives the
offsets and a window numbers the rows inside a bucket, so a shard of any size
is never sorted by one task.

Defined cases: a null key is a key of its own (all null keys share a shard);
a null text has size ``overhead`` and the checksum of the empty text; repeated
rows are numbered one by one; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelake.llm.common import documents, text_of
from farelake.sinks.snapshots import materialize

SHARDS = 24
BUCKETS = 256


def shard_costs(key: Column, weights: Sequence[float]) -> list[Column]:
    """One ``(cost, shard)`` struct per shard; the smallest one wins."""
    costs = []
    for shard, weight in enumerate(weights):
        draw = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard).cast("long")), 11).cast("double")
        uniform = (draw + 0.5) / float(2**53)
        costs.append(
            F.struct((-F.log(uniform) / float(weight)).alias("cost"), F.lit(shard).alias("shard"))
        )
    return costs


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """Shard of a key among ``len(weights)`` weighted shards."""
    costs = shard_costs(key, weights)
    return (costs[0] if len(costs) == 1 else F.least(*costs))["shard"]


def assign_shards(
    df: DataFrame,
    weights: Sequence[float],
    grown_weight: float | None = None,
    key: str = "doc_id",
    text: str = "text",
    overhead: int = 8,
) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, grown_shard)`` for every row of ``df``."""
    body = F.encode(text_of(text), "UTF-8")
    grown = (
        rendezvous_shard(F.col(key), [*weights, grown_weight])
        if grown_weight is not None
        else F.lit(None).cast("int")
    )
    return df.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        rendezvous_shard(F.col(key), weights).alias("shard"),
        grown.alias("grown_shard"),
    )


def number_slots(assigned: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Add ``slot``: 0 … n-1 within each shard, without gaps."""
    keys = ["doc_id", "text_crc32", "size"]
    rows = materialize(
        assigned.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")),
        "shard-rows",
    )
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("shard", "bucket")
        .agg(F.count("*").alias("n"))
        .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("shard", "bucket").orderBy(*keys)
    return (
        rows.withColumn("place", F.row_number().over(inside) - 1)
        .join(materialize(offsets, "shard-offsets"), ["shard", "bucket"])
        .withColumn("slot", (F.col("offset") + F.col("place")).cast("long"))
        .drop("bucket", "place", "offset")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 24 equal shards; ``grown_shard`` with one more."""
    weights = [1.0] * SHARDS
    slots = number_slots(assign_shards(documents(spark, sf_dir), weights, grown_weight=1.0))
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
