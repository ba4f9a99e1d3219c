"""The steward review queue and its lifecycle.

``PENDING_REVIEW`` rows are landed by matching; a person sets ``APPROVED``
(outside the code; ``record_decisions`` and ``decision_events`` stand in for
that in tests and demos); promotion turns approved rows into new vendor versions
through SCD2 and marks them ``PROCESSED`` so they are not promoted twice.

On storage the queue is never rewritten: rows are appended by matching, and a
change of status is one more row in a table of status events. ``queue_state`` is
the queue with the latest status of each row, so rows that are appended between
a read and a mark cannot get lost.

The queue carries both vendor ids, so a promotion knows which vendor it
renames: the *source* vendor takes the *matched* vendor's name.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.config import DEFAULT_AS_OF, DEFAULT_JOB
from farelake.constants import APPROVED, PENDING_REVIEW, PROCESSED, STEWARD_APPROVED, STEWARD_REVIEW
from farelake.functions.columns import ts_literal
from farelake.operators import scd2
from farelake.operators.golden import audit_block, top_per_key

QUEUE_COLUMNS = [
    "source_vendorid",
    "source_vendor_name",
    "matched_vendorid",
    "matched_vendor_name",
    "confidence",
    "status",
    "landed_at",
    "detected_by_job",
]


def steward_queue(routed: DataFrame, as_of: str = DEFAULT_AS_OF, job_name: str = DEFAULT_JOB) -> DataFrame:
    """Keep only the pairs routed to a steward, as ``PENDING_REVIEW``."""
    return routed.filter(F.col("approved_by") == STEWARD_REVIEW).select(
        "source_vendorid",
        "source_vendor_name",
        "matched_vendorid",
        "matched_vendor_name",
        "confidence",
        F.lit(PENDING_REVIEW).alias("status"),
        ts_literal(as_of).alias("landed_at"),
        F.lit(job_name).alias("detected_by_job"),
    )


#: what identifies a queue row
QUEUE_KEY = ["source_vendorid", "matched_vendorid", "landed_at"]
#: of events with one time stamp the one further down the lifecycle counts
LIFECYCLE = [PENDING_REVIEW, APPROVED, PROCESSED]


def status_events(rows: DataFrame, status: str, as_of: str) -> DataFrame:
    """One event per queue row of ``rows``: it has ``status`` from ``as_of`` on."""
    return rows.select(*QUEUE_KEY, F.lit(status).alias("status"), ts_literal(as_of).alias("event_at"))


def decision_events(state: DataFrame, approve: Column, as_of: str) -> DataFrame:
    """The steward's decision as events: pending rows that match ``approve``."""
    pending = F.col("status") == PENDING_REVIEW
    return status_events(state.filter(pending & F.coalesce(approve, F.lit(False))), APPROVED, as_of)


def latest_events(events: DataFrame) -> DataFrame:
    """The last event of every queue row (one ``max`` per key, combined map-side)."""
    place = F.array_position(F.array(*[F.lit(s) for s in LIFECYCLE]), F.col("status"))
    last = F.max(F.struct(F.col("event_at"), place.alias("place"), F.col("status"))).alias("last")
    return events.groupBy(*QUEUE_KEY).agg(last).select(*QUEUE_KEY, "last.status", "last.event_at")


def queue_state(queue: DataFrame, events: DataFrame) -> DataFrame:
    """The queue with the latest status of every row."""
    latest = latest_events(events).select(*[F.col(c).alias(f"_{c}") for c in QUEUE_KEY], F.col("status").alias("_status"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in QUEUE_KEY])
    joined = queue.join(latest, same, "left")
    return joined.select(
        *[F.coalesce("_status", "status").alias("status") if c == "status" else F.col(c) for c in queue.columns]
    )


def pending_count(queue: DataFrame) -> DataFrame:
    """One row with the number of rows waiting for review."""
    return queue.agg(F.count_if(F.col("status") == PENDING_REVIEW).alias("pending_count"))


def record_decisions(queue: DataFrame, approve: Column) -> DataFrame:
    """The steward's decision: pending rows matching ``approve`` become ``APPROVED``."""
    pending = F.col("status") == PENDING_REVIEW
    return queue.withColumn(
        "status", F.when(pending & F.coalesce(approve, F.lit(False)), F.lit(APPROVED)).otherwise(F.col("status"))
    )


def promotions(queue: DataFrame, as_of: str = DEFAULT_AS_OF, job_name: str = DEFAULT_JOB) -> DataFrame:
    """M4: approved rows → vendor rows named by the matched name.

    A source vendor with several approved rows is promoted once: the latest
    landing wins, then the smallest matched id (a MERGE source must have one
    row per key).
    """
    approved = queue.filter(F.col("status") == APPROVED)
    best = top_per_key(
        approved, "source_vendorid", [F.col("landed_at").desc(), F.col("matched_vendorid").asc()]
    )
    return best.select(
        F.col("source_vendorid").alias("vendorid"),
        F.col("matched_vendor_name").alias("vendor_name"),
        *audit_block(as_of, job_name, STEWARD_APPROVED),
    )


def promote(vendor_dim: DataFrame, queue: DataFrame, as_of: str = DEFAULT_AS_OF, job_name: str = DEFAULT_JOB) -> DataFrame:
    """M4: the next vendor-dimension snapshot after applying approved rows."""
    return scd2.apply_batch(vendor_dim, promotions(queue, as_of, job_name), "vendorid")


def mark_processed(queue: DataFrame) -> DataFrame:
    """M5: ``APPROVED`` → ``PROCESSED``; every other row unchanged."""
    return queue.withColumn(
        "status", F.when(F.col("status") == APPROVED, F.lit(PROCESSED)).otherwise(F.col("status"))
    )
