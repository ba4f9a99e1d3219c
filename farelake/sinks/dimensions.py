"""M1–M3 on storage: a type-2 dimension in hash partitions of its key.

A key's versions all lie in partition ``pmod(xxhash64(key), partitions)``.
Applying a batch reads and rewrites only the partitions that the batch's keys
fall into (partition pruning on the read, dynamic partition overwrite on the
write), so a small batch costs its own partitions and not the dimension.

The overwrite of several partitions is not one transaction; applying a batch
is therefore idempotent: a batch row whose key already has a version opened at
the row's ``effective_from`` has been applied and is left out. Repeating a
batch after a failure completes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.constants import AUDIT_COLUMNS
from farelake.operators import scd2
from farelake.sinks.snapshots import materialize, overwrite_partitions, read_if_exists, register_external

PARTITIONS = 16


class DimensionTable:
    """A dimension under ``root``, one current row per ``key``."""

    def __init__(self, spark: SparkSession, name: str, root: str, key: str, partitions: int = PARTITIONS):
        self.spark = spark
        self.name = name
        self.root = root.rstrip("/")
        self.key = key
        self.partitions = partitions

    def _placed(self, df: DataFrame) -> DataFrame:
        # the hash of the text form, so that a key's place does not depend on its width
        return df.withColumn("part", F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.partitions)).cast("int"))

    def _stored(self) -> DataFrame | None:
        return read_if_exists(self.spark, self.root, merge_schema=True)

    def exists(self) -> bool:
        return self._stored() is not None

    def read(self) -> DataFrame:
        stored = self._stored()
        if stored is None:
            raise FileNotFoundError(f"no dimension {self.name} under {self.root}")
        audit = [c for c in stored.columns if c in AUDIT_COLUMNS]
        return stored.select(*[c for c in stored.columns if c not in AUDIT_COLUMNS and c != "part"], *audit)

    def upsert(self, batch: DataFrame) -> list[int]:
        """Apply ``batch``; return the partitions that were rewritten.

        The batch is written once first, so the key check and the branches of
        the apply read files. A key that occurs twice fails before anything
        changes. The driver sees the touched partition numbers only.
        """
        batch = materialize(self._placed(batch), f"{self.name}-batch")
        scd2.require_unique_key(batch, self.key)
        stored = self._stored()
        if stored is None:
            overwrite_partitions(scd2.initial_load(batch), self.root, ["part"])
            return sorted(r["part"] for r in batch.select("part").distinct().collect())
        known = stored.select(F.col(self.key).alias("_key"), F.col("effective_from").alias("_from"))
        touched = [r["part"] for r in batch.select("part").distinct().collect()]
        here = stored.where(F.col("part").isin(touched))
        known = known.where(F.col("part").isin(touched)) if touched else known.limit(0)
        fresh = materialize(
            batch.join(
                known, F.col(self.key).eqNullSafe(F.col("_key")) & (F.col("effective_from") == F.col("_from")), "left_anti"
            ),
            f"{self.name}-fresh",
        )
        rewrite = sorted(r["part"] for r in fresh.select("part").distinct().collect())
        if rewrite:
            target = here.where(F.col("part").isin(rewrite)).drop("part")
            merged = scd2.apply_batch(target, fresh.drop("part"), self.key)
            # the partitions are read by the apply, so it is written aside first
            overwrite_partitions(self._placed(materialize(merged, f"{self.name}-next")), self.root, ["part"])
        return rewrite

    def register(self, name: str | None = None) -> None:
        """K5: the folder as an external table partitioned by ``part``."""
        register_external(self.spark, name or self.name, self.root, partitioned=True, replace=True)
