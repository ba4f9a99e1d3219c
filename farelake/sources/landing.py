"""Landed trip files with drifting schemas, Parquet or CSV.

Every file is read by its own schema and brought to the declared trip columns:
a column that the file does not have is a typed NULL, a column that landed as
another type is cast, a column of its own follows the trip columns. A value
that cannot be read as the declared type makes its row corrupt: the row keeps
the landed values as text in ``_corrupt_record`` and is set aside, so no
default stands in for it.

What was found in a file is stored in a **schema log**: one row per file and
column. A file in the log is not opened again to learn its schema. ``changes``
derives from the log what every file adds, drops, re-types or lacks.

Schemas are read in parallel (one footer or header line per new file); files
with equal schemas are one scan, so the number of scans is the number of
distinct schemas, not of files.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelake.constants import TRIP_COLUMNS
from farelake.sinks.snapshots import append, read_if_exists

LANDED_FILES = "*.{parquet,csv,csv.gz}"
CORRUPT = "_corrupt_record"
#: the type that the schema log gives to a CSV column
TEXT = "text"
FOOTER_THREADS = 16

# The declared types of a raw trip; a landing may hold them as other types.
RAW_TRIP_TYPES: dict[str, str] = {
    c: "timestamp_ntz" if c.endswith("_datetime")
    else "string" if c == "store_and_fwd_flag"
    else "bigint" if c in ("VendorID", "PULocationID", "DOLocationID", "payment_type")
    else "double"
    for c in TRIP_COLUMNS
}

LOG_SCHEMA = "path string, landed_at timestamp, position int, column string, type string"


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, landed_at)`` of every file under ``path``; no content is read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", LANDED_FILES).load(path)
    )
    return files.select("path", F.col("modificationTime").alias("landed_at"))


def _is_csv(path: str) -> bool:
    return path.endswith((".csv", ".csv.gz"))


def inspect(spark: SparkSession, paths: list[str]) -> list[list[tuple[str, str]]]:
    """``(column, type)`` lists of files, each opened once, several at a time."""

    def columns(path: str) -> list[tuple[str, str]]:
        if _is_csv(path):
            return [(c, TEXT) for c in spark.read.option("header", "true").csv(path).columns]
        return [(f.name, f.dataType.simpleString()) for f in spark.read.parquet(path).schema]

    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        return list(pool.map(columns, paths))


class SchemaLog:
    """The stored schemas of landed files, a Parquet folder that is only appended to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def read(self) -> DataFrame:
        found = read_if_exists(self.spark, self.path)
        # a file that was inspected by two attempts of a batch is logged once
        return found.dropDuplicates(["path", "position"]) if found is not None else self.spark.createDataFrame([], LOG_SCHEMA)

    def learn(self, files: DataFrame) -> list[str]:
        """Inspect and log the files ``(path, landed_at)`` that the log does not have; return their paths.

        The driver holds the new files of one landing or micro-batch.
        """
        new = files.join(self.read().select("path"), "path", "left_anti").orderBy("path").collect()
        paths = [r["path"] for r in new]
        rows = [
            (r["path"], r["landed_at"], i, name, kind)
            for r, found in zip(new, inspect(self.spark, paths))
            for i, (name, kind) in enumerate(found)
        ]
        if rows:
            append(self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1), self.path)
        return paths


def changes(log: DataFrame, types: dict[str, str] = RAW_TRIP_TYPES) -> DataFrame:
    """``(path, column, change)`` of every logged file.

    Against the declared schema: ``missing``, ``extra`` or ``type: <landed>`` (a
    CSV file has no types). Against the file that landed before: ``added``,
    ``dropped`` or ``retyped``.
    """
    files = log.groupBy("path").agg(F.min("landed_at").alias("landed_at"))
    # one row per file; a landing's history is small beside its data
    before = files.withColumn("previous", F.lag("path").over(Window.orderBy("landed_at", "path"))).select("path", "previous")
    columns = log.select("path", "column", "type")
    expected = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    wanted = files.select("path", F.explode(expected).alias("column", "declared"))
    versus = (
        columns.join(wanted, ["path", "column"], "full")
        .select(
            "path", "column",
            F.when(F.col("type").isNull(), "missing")
            .when(F.col("declared").isNull(), "extra")
            .when((F.col("type") != F.col("declared")) & (F.col("type") != TEXT), F.concat(F.lit("type: "), "type"))
            .alias("change"),
        )
        .where("change is not null")
    )
    old = columns.select(F.col("path").alias("previous"), "column", F.col("type").alias("was")).join(
        before.where("previous is not null"), "previous"
    )
    succession = (
        columns.join(before.where("previous is not null").select("path"), "path", "left_semi")
        .join(old.select("path", "column", "was"), ["path", "column"], "full")
        .select(
            "path", "column",
            F.when(F.col("type").isNull(), "dropped")
            .when(F.col("was").isNull(), "added")
            .when((F.col("type") != F.col("was")) & (F.col("type") != TEXT) & (F.col("was") != TEXT), "retyped")
            .alias("change"),
        )
        .where("change is not null")
    )
    return versus.union(succession)


def _conformed(df: DataFrame, columns: list[tuple[str, str]], types: dict[str, str]) -> list[Column]:
    """The declared columns of a scan, and the landed text of its unreadable rows."""
    landed = dict(columns)
    out, failed = [], []
    for name, target in types.items():
        if name not in landed:
            out.append(F.lit(None).cast(target).alias(name))
        elif landed[name] == target:
            out.append(F.col(f"`{name}`").alias(name))
        else:
            value = F.col(f"`{name}`").try_cast(target)
            out.append(value.alias(name))
            failed.append(F.col(f"`{name}`").isNotNull() & value.isNull())
    text = F.to_json(F.struct(*[F.col(f"`{n}`") for n, _ in columns if n != CORRUPT]))
    corrupt = F.when(reduce(or_, failed), text) if failed else F.lit(None).cast("string")
    if CORRUPT in df.columns:
        # the reader only judges the columns that are asked for, so all of them are:
        # whether a line is corrupt must not depend on the query
        always = F.hash(*[F.col(f"`{n}`") for n, _ in columns]) >= F.lit(-(2**31))
        corrupt = F.coalesce(F.when(always, F.col(CORRUPT)), corrupt)
    return [*out, corrupt.alias(CORRUPT)]


def _scan(spark: SparkSession, columns: list[tuple[str, str]], paths: list[str], types: dict[str, str]) -> DataFrame:
    if columns and columns[0][1] != TEXT:
        return spark.read.parquet(*paths)
    # typed by header order; a malformed value leaves its whole line in the corrupt column
    schema = ", ".join([f"`{n}` {types.get(n, 'string')}" for n, _ in columns] + [f"`{CORRUPT}` string"])
    return (
        spark.read.schema(schema).option("header", "true").option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT).csv(paths)
    )


def read_files(
    spark: SparkSession,
    files: Iterable[tuple[str, list[tuple[str, str]]]],
    types: dict[str, str] = RAW_TRIP_TYPES,
) -> DataFrame:
    """The files ``(path, columns)`` by their own schemas: declared columns, ``_corrupt_record``, extra columns."""
    groups: dict[tuple, list[str]] = {}
    for path, columns in files:
        groups.setdefault(tuple(columns), []).append(path)
    parts = []
    for columns, paths in sorted(groups.items()):
        df = _scan(spark, list(columns), paths, types)
        typed = [(n, types.get(n, "string") if t == TEXT else t) for n, t in columns]
        extra = [F.col(f"`{n}`") for n, _ in columns if n not in types]
        parts.append(df.select(*_conformed(df, typed, types), *extra))
    if not parts:
        return spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in types.items()) + f", {CORRUPT} string")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def logged(log: DataFrame, paths: DataFrame | None = None) -> list[tuple[str, list[tuple[str, str]]]]:
    """``(path, columns)`` of the logged files, of the given ``paths`` if any."""
    if paths is not None:
        log = log.join(paths.select("path"), "path", "left_semi")
    rows = log.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("position", "column", "type"))).alias("c"))
    return [(r["path"], [(c["column"], c["type"]) for c in r["c"]]) for r in rows.orderBy("path").collect()]


def read_landing(spark: SparkSession, path: str, log: SchemaLog | None = None) -> DataFrame:
    """A whole landing folder: the declared trip columns, then extra ones.

    Corrupt rows are left out (``read_files`` shows them). With a ``log`` only
    files that it does not have are inspected.
    """
    if log is not None:
        log.learn(landed_files(spark, path))
        found = logged(log.read(), landed_files(spark, path))
    else:
        paths = [r["path"] for r in landed_files(spark, path).orderBy("path").collect()]
        found = list(zip(paths, inspect(spark, paths)))
    rows = read_files(spark, found)
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def schema_drift(spark: SparkSession, path: str, log: SchemaLog) -> DataFrame:
    """``changes`` of a landing folder, after its new files were logged."""
    log.learn(landed_files(spark, path))
    return changes(log.read())
