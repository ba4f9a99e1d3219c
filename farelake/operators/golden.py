"""Golden records for the master dimensions.

A golden record is the top row per business key under a fixed preference
order. ``row_number() ... = 1`` is planned as a partial ``WindowGroupLimit``
before the shuffle and a final one after it, so only one candidate row per
key and map task crosses the network, however many duplicates a key has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.config import DEFAULT_AS_OF, DEFAULT_JOB
from farelake.constants import SYSTEM_AUTO_APPROVED
from farelake.functions.columns import to_int, ts_literal


def audit_block(
    as_of: str = DEFAULT_AS_OF,
    job_name: str = DEFAULT_JOB,
    approved_by: str = SYSTEM_AUTO_APPROVED,
) -> list[Column]:
    """The audit columns of a new current dimension row (version excluded)."""
    return [
        F.lit(job_name).alias("updated_by"),
        F.lit(approved_by).alias("approved_by"),
        ts_literal(as_of).alias("effective_from"),
        F.lit(None).cast(T.TimestampNTZType()).alias("effective_to"),
        F.lit(True).alias("is_current_flag"),
    ]


def top_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """W1 + W2: keep the first row per ``key`` under ``order``."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def golden_zones(
    lookup: DataFrame, as_of: str = DEFAULT_AS_OF, job_name: str = DEFAULT_JOB
) -> DataFrame:
    """One row per ``LocationID`` (string key, before the int cast).

    Preference: ``Borough`` desc, then ``Zone`` desc (NULLs last), then
    ``service_zone`` desc as a deterministic tie-break. Strings are trimmed
    and the id cast to INT (NULL for a non-numeric id).
    """
    best = top_per_key(
        lookup,
        "LocationID",
        [
            F.col("Borough").desc_nulls_last(),
            F.col("Zone").desc_nulls_last(),
            F.col("service_zone").desc_nulls_last(),
        ],
    )
    return best.select(
        to_int(F.col("LocationID")).alias("locationid"),
        F.trim(F.col("Borough")).alias("borough"),
        F.trim(F.col("Zone")).alias("zone"),
        F.trim(F.col("service_zone")).alias("service_zone"),
        *audit_block(as_of, job_name),
    )


def golden_vendors(
    vendors: DataFrame, as_of: str = DEFAULT_AS_OF, job_name: str = DEFAULT_JOB
) -> DataFrame:
    """Every row of the vendor master ``(vendorid, vendor_name)`` + audit block."""
    return vendors.select("vendorid", "vendor_name", *audit_block(as_of, job_name))


def golden_ratecodes(
    ratecodes: DataFrame, as_of: str = DEFAULT_AS_OF, job_name: str = DEFAULT_JOB
) -> DataFrame:
    """Every row of the rate-code master ``(ratecodeid, ratecode_desc)`` + audit block."""
    return ratecodes.select("ratecodeid", "ratecode_desc", *audit_block(as_of, job_name))
