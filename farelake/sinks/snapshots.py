"""Overwritten tables, appended tables and catalog registration.

Plain Parquet has no row-level MERGE/UPDATE and cannot be overwritten while it
is read. Two kinds of table cover what the flow needs, and no table is both:

* ``SnapshotTable`` is replaced as a whole. Every version is a folder that is
  written once; a one-row pointer table names the current one. Previous folders
  stay for rollback. A writer that has read a version commits only if that
  version is still the current one, so a stale overwrite fails instead of
  hiding a newer one. One writer at a time is assumed (the two steps of a
  commit are not one transaction).
* ``BatchTable`` only grows. A batch is one partition, written with dynamic
  partition overwrite, so a batch that is repeated after a failure replaces
  itself and never adds its rows twice. A gated table shows only accepted
  batches: what a data-quality gate has not passed is never read.

Both are found by their path alone and are written and read by Spark's Parquet
source only. A finished write cuts the lineage of the next step; a lost executor
costs the retried tasks.
"""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class StaleSnapshotError(RuntimeError):
    """The table has a newer version than the one this commit was computed from."""


def _label(as_of: str | None) -> str:
    stamp = re.sub(r"[^0-9]", "", as_of or "")[:14]
    return f"{stamp}-{uuid.uuid4().hex[:8]}" if stamp else uuid.uuid4().hex[:12]


def read_if_exists(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame | None:
    """The Parquet folder, or None if there is none yet or it holds no file."""
    try:
        return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def overwrite_partitions(df: DataFrame, path: str, columns: list[str]) -> None:
    """Replace exactly the partitions that ``df`` has rows for."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


class SnapshotTable:
    """A table under ``root`` whose content is replaced version by version."""

    def __init__(self, spark: SparkSession, name: str, root: str):
        self.spark = spark
        self.name = name
        self.root = root.rstrip("/")
        self._seen: str | None = None

    def location(self) -> str | None:
        """Folder of the current version."""
        pointer = read_if_exists(self.spark, f"{self.root}/current")
        row = pointer.select("path").first() if pointer is not None else None
        if row is None:
            return None
        return row["path"] if "/" in row["path"] else f"{self.root}/{row['path']}"

    def exists(self) -> bool:
        return self.location() is not None

    def read(self, path: str | None = None) -> DataFrame:
        """The current version, with that version's schema (or the version in ``path``)."""
        path = path or self.location()
        if not path:
            raise FileNotFoundError(f"no snapshot of {self.name} under {self.root}")
        self._seen = path
        return self.spark.read.parquet(path)

    def stage(self, df: DataFrame, as_of: str | None = None) -> str:
        """Write ``df`` as a new version without making it current."""
        path = f"{self.root}/v={_label(as_of)}"
        df.write.mode("errorifexists").parquet(path)
        return path

    def adopt(self, path: str) -> str:
        """Make an already written version the current one."""
        current = self.location()
        if self._seen is not None and current != self._seen:
            raise StaleSnapshotError(f"{self.name}: read {self._seen}, but {current} is current now")
        row = self.spark.range(1).select(
            F.lit(path.removeprefix(f"{self.root}/")).alias("path"), F.lit("current").alias("slot")
        )
        # the new row is written before the old one goes
        overwrite_partitions(row, f"{self.root}/current", ["slot"])
        self._seen = path
        return path

    def commit(self, df: DataFrame, as_of: str | None = None) -> str:
        """K1: write ``df`` as the next version and make it current."""
        return self.adopt(self.stage(df, as_of))

    def register(self, name: str | None = None) -> None:
        """K5: the current version as an external table of the catalog."""
        register_external(self.spark, name or self.name, self.location(), replace=True)


def _names(batches: DataFrame) -> list[str]:
    return sorted({r["batch"] for r in batches.select("batch").collect() if r["batch"] is not None})


class BatchTable:
    """A table under ``root`` that grows by batches (partition column ``batch``)."""

    def __init__(self, spark: SparkSession, name: str, root: str, gated: bool = False):
        self.spark = spark
        self.name = name
        self.root = root.rstrip("/")
        self.gated = gated

    @property
    def data(self) -> str:
        return f"{self.root}/data"

    def put(self, df: DataFrame, batch: str) -> None:
        """K3: add (or repeat) one batch; other batches are not touched."""
        self.put_all(df.withColumn("batch", F.lit(batch)))

    def put_all(self, df: DataFrame) -> None:
        """Like ``put`` for several batches, named by the column ``batch``."""
        overwrite_partitions(df, self.data, ["batch"])

    def accept(self, batch: str) -> None:
        """Make a batch of a gated table visible."""
        row = self.spark.range(1).select(F.lit(batch).alias("name"), F.lit(batch).alias("batch"))
        overwrite_partitions(row, f"{self.root}/accepted", ["batch"])

    def accepted(self) -> DataFrame:
        """``(batch)``: the batches that readers see."""
        found = read_if_exists(self.spark, f"{self.root}/accepted")
        return found.select(F.col("name").alias("batch")) if found is not None else self.spark.range(0).select(F.lit("").alias("batch"))

    def rows_of(self, batch: str) -> DataFrame:
        """The rows of one batch, seen or not (one partition is read)."""
        return self.spark.read.parquet(f"{self.data}/batch={batch}")

    def read(self, batches: DataFrame | None = None, keep_batch: bool = False) -> DataFrame:
        """All rows that readers see, of the given ``batches`` if any.

        The names of the batches, one per run or micro-batch, are a filter on the
        partition column: the folders of all others are never listed for a task,
        and no row is shuffled to find its batch.
        """
        found = read_if_exists(self.spark, self.data)
        if found is None:
            raise FileNotFoundError(f"no batch of {self.name} under {self.root}")
        found = found.withColumn("batch", F.col("batch").cast("string"))
        if self.gated:
            found = found.where(F.col("batch").isin(_names(self.accepted())))
        if batches is not None:
            found = found.where(F.col("batch").isin(_names(batches)))
        rows = [c for c in found.columns if c != "batch"]
        return found.select(*rows, "batch") if keep_batch else found.select(*rows)

    def exists(self) -> bool:
        if read_if_exists(self.spark, self.data) is None:
            return False
        return not self.gated or bool(self.accepted().limit(1).count())

    def register(self, name: str | None = None, batch: str | None = None) -> None:
        """K5: the folder as an external table; a known table learns one more partition."""
        register_external(self.spark, name or self.name, self.data, {"batch": batch} if batch else None, partitioned=True)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """K2 / K3: append rows (optionally partitioned) to a Parquet folder."""
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def register_external(
    spark: SparkSession,
    name: str,
    path: str,
    partition: dict[str, str] | None = None,
    partitioned: bool = False,
    replace: bool = False,
) -> None:
    """K5: ``CREATE TABLE IF NOT EXISTS ... USING parquet LOCATION``.

    A table whose folder moves with every version is created anew
    (``replace``; the files stay). The partitions of a partitioned folder are
    recovered when the catalog sees it first; later each new ``partition`` is
    added on its own, without listing the others.
    """
    known = spark.catalog.tableExists(name)
    if known and replace:
        spark.sql(f"DROP TABLE {name}")
        known = False
    if not known:
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    if partitioned and (not known or not partition):
        spark.sql(f"MSCK REPAIR TABLE {name}")
    elif partitioned:
        spec = ", ".join(f"{column}='{value}'" for column, value in partition.items())
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec})")
    spark.sql(f"REFRESH TABLE {name}")


def materialize(df: DataFrame, label: str = "materialized") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where one intermediate feeds several branches of a plan: it is
    computed once, its lineage is cut (a lost executor re-reads files instead
    of recomputing the chain) and the reader sees real file sizes.
    """
    from farelake.session import scratch_path

    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def sized(df: DataFrame) -> DataFrame:
    """``df`` (flat columns, cheap to read) as the side of a join that is broadcast only if its rows fit.

    The planner knows a written table by the bytes of its compressed files. Ids
    in order and repeated names take a few bytes a row there and many times that
    in memory, and the driver holds a broadcast whole. Here the rows are counted as they lie
    in memory: up to ``spark.sql.autoBroadcastJoinThreshold`` the side is
    broadcast, beyond it both sides are shuffled.
    """
    bound = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    # a row is a null word, a word per column, and its texts in whole words
    texts = [F.ceil(F.coalesce(F.octet_length(f.name), F.lit(0)) / 8) * 8 for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    row = sum(texts, F.lit(8 + 8 * len(df.columns)))
    held = df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).first()["bytes"]
    return F.broadcast(df) if held <= bound else df.hint("merge")
