"""Slowly changing dimensions of type 2.

A dimension is a table of versions with the audit block
``updated_by, approved_by, effective_from, effective_to, is_current_flag,
version``. Applying a batch is one plan over one immutable snapshot of the
target:

* **closed** — the current row of every key present in the batch gets
  ``is_current_flag = false``, ``effective_to`` = the batch row's
  ``effective_from`` and ``updated_by`` = the batch row's ``updated_by``;
* **untouched** — every other target row, unchanged;
* **new** — every batch row with ``version`` = max current version + 1
  (1 for a new key) and ``is_current_flag = true``.

The result is written as a new snapshot (see ``farelake.sinks``); readers of
the old snapshot never see a key without a current row. Parquet tables have no
row-level MERGE, so the close step is a left join plus ``when``.

Scale: one aggregate over the batch proves its keys unique; a duplicate fails
the apply before anything is written. No join carries a broadcast hint: the
batch is a written table, so the planner (and AQE at run time) compares its
bytes with the broadcast threshold. A small batch is broadcast and the target
is read twice (close join; semi-join to the touched keys before the
max-version aggregate) without a shuffle; beyond the threshold the joins
shuffle on the key only (AQE splits a skewed key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.constants import AUDIT_COLUMNS
from farelake.functions.columns import all_of, ts_literal_like


def initial_load(batch: DataFrame) -> DataFrame:
    """M1: the first snapshot of a dimension: every row is version 1."""
    return batch.withColumn("version", F.lit(1))


def unique_key_count(batch: DataFrame, key: str) -> int:
    """Number of batch rows, failing if a non-NULL key occurs twice.

    A duplicated key would make the close step ambiguous. A NULL key matches
    no target row (as in a MERGE), so such rows are simply appended as
    version 1. One partial + final aggregate (a hot key costs one row per map
    task) and a single summary row to the driver, before anything is written.
    """
    per_key = batch.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    stats = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias("duplicate_keys"),
    ).first()
    if stats["duplicate_keys"]:
        raise ValueError(f"SCD2 batch key {key} is not unique: {stats['duplicate_keys']} duplicated keys")
    return int(stats["rows"])


def require_unique_key(batch: DataFrame, key: str) -> DataFrame:
    """``batch`` unchanged, after ``unique_key_count`` found no duplicate."""
    unique_key_count(batch, key)
    return batch


def changed_rows(batch: DataFrame, target: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    """Batch rows that are new keys or differ (null-safely) from the current row."""
    current = target.filter(F.col("is_current_flag")).select(
        key, F.lit(True).alias("_has_current"), *[F.col(c).alias(f"_cur_{c}") for c in tracked]
    )
    same = all_of([F.col(c).eqNullSafe(F.col(f"_cur_{c}")) for c in tracked]) if tracked else F.lit(True)
    joined = batch.join(current, key, "left")
    keep = F.col("_has_current").isNull() | ~same
    return joined.filter(keep).select(*batch.columns)


def versioned_batch(batch: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """J4 + A4: batch rows with ``version`` = max current version + 1, else 1.

    Only the target rows of keys in the batch are aggregated: a semi-join
    with the batch keys, so a large target is filtered where it is read when
    the batch is small. ``USING`` join, so the key becomes the first column.
    """
    keys = batch.select(key).filter(F.col(key).isNotNull())
    touched = target.filter(F.col("is_current_flag")).join(keys, key, "left_semi")
    max_v = touched.groupBy(key).agg(F.max("version").alias("_max_v"))
    return (
        batch.join(max_v, key, "left")
        .withColumn("version", F.coalesce(F.col("_max_v") + 1, F.lit(1)))
        .drop("_max_v")
    )


def close_current(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Close the current target row of every key in ``batch``."""
    closing = batch.select(
        key,
        F.col("effective_from").alias("_close_at"),
        F.col("updated_by").alias("_close_by"),
        F.lit(True).alias("_hit"),
    )
    joined = target.join(closing, key, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False)) & F.col("is_current_flag")
    replaced = {
        "is_current_flag": F.when(hit, F.lit(False)).otherwise(F.col("is_current_flag")),
        "effective_to": F.when(hit, F.col("_close_at")).otherwise(F.col("effective_to")),
        "updated_by": F.when(hit, F.col("_close_by")).otherwise(F.col("updated_by")),
    }
    return joined.select(*[replaced.get(c, F.col(c)).alias(c) for c in target.columns])


def apply_batch(
    target: DataFrame,
    batch: DataFrame,
    key: str,
    change_only: bool = False,
    tracked: list[str] | None = None,
) -> DataFrame:
    """M2 + M3: the next snapshot of ``target`` after applying ``batch``.

    ``batch`` carries the business columns and the audit block without
    ``version``. By default every key in the batch is closed and reopened
    (no change detection). With ``change_only=True`` only new keys and keys
    whose ``tracked`` columns differ null-safely from the current row are
    versioned. A business column that only one side has is added to the other
    as a typed NULL, so neither new nor retired columns are lost.
    """
    require_unique_key(batch, key)
    if change_only:
        if tracked is None:
            tracked = [c for c in batch.columns if c != key and c not in AUDIT_COLUMNS]
        batch = changed_rows(batch, target, key, tracked)
    closed = close_current(target, batch, key)
    new_rows = versioned_batch(batch, target, key)
    merged = closed.unionByName(new_rows, allowMissingColumns=True)
    business = [c for c in merged.columns if c not in AUDIT_COLUMNS]
    return merged.select(*business, *[c for c in merged.columns if c in AUDIT_COLUMNS])


def current_rows(dim: DataFrame) -> DataFrame:
    """The current row of each key."""
    return dim.filter(F.col("is_current_flag"))


def rows_as_of(dim: DataFrame, ts: str) -> DataFrame:
    """M6: the row of each key that was valid at ``ts``
    (``effective_from <= ts < effective_to``, open end = still valid)."""
    at = ts_literal_like(dim, "effective_from", ts)
    return dim.filter(
        (F.col("effective_from") <= at)
        & (F.col("effective_to").isNull() | (at < F.col("effective_to")))
    )


def key_uniqueness(dim: DataFrame, key: str) -> DataFrame:
    """One summary row: keys, current rows, keys with more than one current row.

    Run before a fact join: a duplicate current row would fan trips out.
    """
    per_key = current_rows(dim).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("current_rows"),
        F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
    )

