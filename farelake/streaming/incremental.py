"""Incremental pick-up of newly landed trip files.

A file-source stream over the landing folder with ``trigger(availableNow)``
delivers the *paths* of the files that arrived since the previous run (the
checkpoint remembers them), in bounded micro-batches. The stream has no data
columns, hence no fixed schema: each micro-batch reads its files by their own
schemas (``sources.landing``), which are stored in the schema log, so a column
that is missing, new or of another type does not stop it.

Each micro-batch is standardized, validated and written once, as one batch of
the processed table. The data-quality rules are counted by that same write
(``quality.observed``), so the batch is not read back:

* gate passes → the batch is accepted and becomes visible;
* gate fails → its rows go to the quarantine table under the run id and the
  batch id, and the run stops with ``DataQualityError``. The checkpoint does not
  advance past the batch; the next run judges it again.

Rows that cannot be read as the declared types are kept apart, with what landed
as text. A batch that is retried replaces itself: every write is the overwrite
of its own partition.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from zlib import crc32

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.config import DEFAULT_AS_OF, TripRules
from farelake.operators import quality
from farelake.operators.quality import DataQualityError
from farelake.operators.validate import processed_trips
from farelake.sinks.snapshots import BatchTable, overwrite_partitions
from farelake.sources.landing import CORRUPT, LANDED_FILES, RAW_TRIP_TYPES, SchemaLog, inspect, logged, read_files


@dataclass
class LandingRun:
    batches: list[tuple[int, str, int]] = field(default_factory=list)  # (epoch, decision, rows)
    names: list[str] = field(default_factory=list)  # accepted batches


def landed_paths(spark: SparkSession, landing_path: str, max_files: int | None) -> DataFrame:
    """The stream of landed files: ``(path, landed_at)``; no content is read."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", LANDED_FILES)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(landing_path).select("path", F.col("modificationTime").alias("landed_at"))


def batch_name(checkpoint_path: str, epoch: int) -> str:
    """Name of a micro-batch in the tables: its checkpoint and number."""
    return f"s{crc32(checkpoint_path.encode()):08x}-{epoch:08d}"


def process_landing(
    spark: SparkSession,
    landing_path: str,
    processed: BatchTable,
    quarantine_path: str,
    checkpoint_path: str,
    as_of: str = DEFAULT_AS_OF,
    rules: TripRules = TripRules(),
    ruleset: tuple[quality.Rule, ...] = quality.PROCESSED_RULES,
    max_files_per_trigger: int | None = 1000,
    dq_results_path: str | None = None,
    schema_log: SchemaLog | None = None,
    corrupt_path: str | None = None,
) -> LandingRun:
    """Process every file that landed since the last run, then stop."""
    run = LandingRun()
    failed: list[DataQualityError] = []

    def handle(batch: DataFrame, epoch: int) -> None:
        name = batch_name(checkpoint_path, epoch)
        # the driver holds the paths of one micro-batch
        files = spark.createDataFrame(batch.collect(), batch.schema)
        if schema_log is not None:
            schema_log.learn(files)
            found = logged(schema_log.read(), files)
        else:
            paths = [r["path"] for r in files.collect()]
            found = list(zip(paths, inspect(spark, paths)))
        rows = read_files(spark, found)
        if corrupt_path:
            landed = [c for c in RAW_TRIP_TYPES if c in rows.columns]
            bad = rows.where(F.col(CORRUPT).isNotNull()).select(*landed, CORRUPT)
            overwrite_partitions(bad.withColumn("batch", F.lit(name)), corrupt_path, ["batch"])
        good = rows.where(F.col(CORRUPT).isNull())
        watched, outcome_of = quality.observed(processed_trips(good, as_of, rules), ruleset)
        processed.put(watched, name)
        outcome = outcome_of()
        if dq_results_path and outcome.report:
            overwrite_partitions(
                quality.result_rows(spark, outcome).withColumn("run_id", F.lit(f"{_run_id(as_of)}-{epoch}")),
                dq_results_path, ["run_id"],
            )
        run.batches.append((epoch, outcome.decision, outcome.rows))
        if outcome.decision == "PUBLISH":
            processed.accept(name)
            run.names.append(name)
            return
        if outcome.rows:
            processed.rows_of(name).write.mode("overwrite").parquet(
                f"{quarantine_path}/quarantine_run_id={_run_id(as_of)}/epoch={epoch}"
            )
        failed.append(DataQualityError(f"micro-batch {epoch} of {outcome.rows} rows quarantined"))
        raise failed[0]

    query = (
        landed_paths(spark, landing_path, max_files_per_trigger)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if failed:
            raise failed[0] from None
        raise
    return run


def _run_id(as_of: str) -> str:
    digits = "".join(ch for ch in as_of if ch.isdigit())
    return f"{digits[:8]}_{digits[8:12]}"
