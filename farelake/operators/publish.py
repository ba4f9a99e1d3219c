"""K4, K6–K8: typed, laid-out export of the master and curated tables.

Each warehouse table has a contract: ordered columns with a type and, for
strings, a byte limit (``VARCHAR(n)``); a distribution style and sort keys.
Publishing maps the source **by position** onto the contract (names may
differ, e.g. ``daily_revenue_in_M`` → ``daily_revenue_mln``), casts, checks
string lengths inside the write (a too-long value fails the job through
``raise_error`` — no extra pass over the data), lays the rows out and writes
Parquet (zstd).

Layout at scale:

* ``DISTSTYLE KEY`` (the fact): rebalance on ``(dist key, day of the first
  sort key)`` and sort within partitions by ``(dist key, sort key)``. The
  rebalance is a hash shuffle whose large partitions AQE splits and whose
  small ones it merges to the advisory size, so a hot zone, even on a single
  day, becomes several files of bounded size. No sampling pass is needed
  (range partitioning would read the fact twice), and each file is ordered by
  zone and pickup time.
* ``DISTSTYLE ALL`` (dimensions, marts): small by construction; sorted within
  partitions by the sort keys, readers broadcast them after a size check.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ColumnContract:
    name: str
    type: str
    max_bytes: int | None = None


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: tuple[ColumnContract, ...]
    source: str  # "master" or "curated"
    dist_key: str | None = None  # None = DISTSTYLE ALL
    sort_keys: tuple[str, ...] = field(default_factory=tuple)
    replace: bool = True  # overwrite (default) or append on re-publish


def _c(name: str, type_: str, max_bytes: int | None = None) -> ColumnContract:
    return ColumnContract(name, type_, max_bytes)


_AUDIT = (
    _c("updated_by", "string", 50),
    _c("approved_by", "string", 50),
    _c("effective_from", "timestamp_ntz"),
    _c("effective_to", "timestamp_ntz"),
    _c("is_current_flag", "boolean"),
    _c("version", "int"),
)

# Warehouse table contracts, in publish order.
CONTRACTS: tuple[TableContract, ...] = (
    TableContract(
        "dim_zones",
        (_c("locationid", "int"), _c("borough", "string", 50), _c("zone", "string", 100), _c("service_zone", "string", 50)) + _AUDIT,
        "master",
        sort_keys=("locationid", "is_current_flag"),
    ),
    TableContract(
        "dim_vendors",
        (_c("vendorid", "bigint"), _c("vendor_name", "string", 100)) + _AUDIT,
        "master",
        sort_keys=("vendorid", "is_current_flag"),
    ),
    TableContract(
        "dim_ratecodes",
        (_c("ratecodeid", "bigint"), _c("ratecode_desc", "string", 50)) + _AUDIT,
        "master",
        sort_keys=("ratecodeid", "is_current_flag"),
    ),
    TableContract(
        "trip_details",
        (
            _c("vendorid", "int"),
            _c("vendor_name", "string", 50),
            _c("tpep_pickup_datetime", "timestamp_ntz"),
            _c("tpep_dropoff_datetime", "timestamp_ntz"),
            _c("pulocationid", "int"),
            _c("pickup_zone", "string", 100),
            _c("pickup_borough", "string", 50),
            _c("dolocationid", "int"),
            _c("dropoff_zone", "string", 100),
            _c("dropoff_borough", "string", 50),
            _c("passenger_count", "int"),
            _c("trip_distance", "double"),
            _c("ratecodeid", "int"),
            _c("ratecode_desc", "string", 50),
            _c("fare_amount", "double"),
            _c("extra", "double"),
            _c("mta_tax", "double"),
            _c("tip_amount", "double"),
            _c("tolls_amount", "double"),
            _c("improvement_surcharge", "double"),
            _c("total_amount", "double"),
            _c("congestion_surcharge", "double"),
            _c("airport_fee", "double"),
            _c("cbd_congestion_fee", "double"),
        ),
        "curated",
        dist_key="pulocationid",
        sort_keys=("tpep_pickup_datetime",),
    ),
    TableContract(
        "daily_metrics",
        (
            _c("trip_date", "date"),
            _c("vendor_name", "string", 50),
            _c("total_trips", "bigint"),
            _c("daily_revenue_mln", "double"),
            _c("avg_tip", "double"),
            _c("avg_tip_percentage", "double"),
            _c("longest_trip", "double"),
        ),
        "curated",
        sort_keys=("trip_date", "vendor_name"),
    ),
    TableContract(
        "vendor_performance",
        (_c("vendor_name", "string", 50), _c("total_trips", "bigint"), _c("revenue", "double")),
        "curated",
        sort_keys=("vendor_name",),
    ),
    TableContract(
        "location_performance",
        (
            _c("pickup_zone", "string", 100),
            _c("pickup_borough", "string", 50),
            _c("pickup_count", "bigint"),
            _c("avg_fare_by_zone", "double"),
        ),
        "curated",
        sort_keys=("pickup_borough", "pickup_zone"),
    ),
)

CONTRACTS_BY_NAME = {c.name: c for c in CONTRACTS}


def conform(df: DataFrame, contract: TableContract) -> DataFrame:
    """Positional rename + cast to the contract, with in-write length checks."""
    if len(df.columns) != len(contract.columns):
        raise ValueError(
            f"{contract.name}: source has {len(df.columns)} columns, contract {len(contract.columns)}"
        )
    out = []
    for i, target in enumerate(contract.columns):
        col = df[df.columns[i]].cast(target.type)
        if target.max_bytes is not None:
            too_long = F.octet_length(col) > target.max_bytes
            message = F.concat(
                F.lit(f"{contract.name}.{target.name} longer than {target.max_bytes} bytes: "), col
            )
            col = F.when(too_long, F.raise_error(message).cast(target.type)).otherwise(col)
        out.append(col.alias(target.name))
    return df.select(*out)


def lay_out(df: DataFrame, contract: TableContract) -> DataFrame:
    """K8: distribution and sort order of the published files."""
    if contract.dist_key is not None:
        keys = [contract.dist_key, *contract.sort_keys]
        spread = [F.col(contract.dist_key)]
        if contract.sort_keys:
            spread.append(F.to_date(F.col(contract.sort_keys[0])))
        laid = df.withColumn("__day", spread[1]) if len(spread) > 1 else df
        by = [contract.dist_key, *(["__day"] if len(spread) > 1 else [])]
        return laid.hint("rebalance", *by).drop("__day").sortWithinPartitions(*keys)
    if contract.sort_keys:
        return df.sortWithinPartitions(*contract.sort_keys)
    return df


def publish(df: DataFrame, contract: TableContract, path: str, mode: str | None = None) -> None:
    """K6 + K7: conform, lay out and write one table as Parquet.

    ``mode`` is ``overwrite`` (default, re-publishing replaces) or ``append``
    (re-publishing adds rows, as a create-if-missing + load would).
    """
    mode = mode or ("overwrite" if contract.replace else "append")
    lay_out(conform(df, contract), contract).write.mode(mode).parquet(path)


#: files that one hot key is split over, at least
KEY_SPLITS = 4
#: rows that a writing task gets on average, at most
TASK_ROWS = 250_000


def publish_colocated(df: DataFrame, contract: TableContract, path: str, table: str, buckets: int = 8) -> None:
    """K8: write a table in buckets of its distribution key, as an external table of the catalog.

    Rows of one key are in one bucket, so aggregates and joins on the key read
    the table without a shuffle. The tasks that write are dealt by bucket and by
    the day of the sort key, so a key with a third of all rows is written by
    ``KEY_SPLITS`` tasks at least into as many files. Their number grows with the
    rows (counted first), so that what one task sorts does not.
    """
    rows = conform(df, contract)
    splits = max(KEY_SPLITS, math.ceil(df.count() / (buckets * TASK_ROWS)))
    bucket = F.pmod(F.hash(contract.dist_key), F.lit(buckets))
    split = F.pmod(F.hash(F.to_date(contract.sort_keys[0])), F.lit(splits))
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    (
        rows.repartition(buckets * splits, bucket, split)
        .write.mode("overwrite")
        .bucketBy(buckets, contract.dist_key)
        .sortBy(contract.dist_key, *contract.sort_keys)
        .option("path", path)
        .saveAsTable(table)
    )


def publish_all(
    tables: dict[str, DataFrame], root: str, modes: dict[str, str] | None = None
) -> list[tuple[str, str, str]]:
    """K4 + K6 over all contracts in order; returns ``(table, status, detail)``.

    ``modes`` optionally sets ``overwrite``/``append`` per table (K7). A table
    that is missing or fails is reported as skipped and the export continues
    with the next table (the failure is returned, not swallowed).
    """
    report = []
    for contract in CONTRACTS:
        df = tables.get(contract.name)
        if df is None:
            report.append((contract.name, "SKIPPED", "no source table"))
            continue
        path = f"{root.rstrip('/')}/{contract.name}"
        try:
            publish(df, contract, path, (modes or {}).get(contract.name))
            report.append((contract.name, "PUBLISHED", path))
        except Exception as exc:  # noqa: BLE001 - reported to the caller
            report.append((contract.name, "SKIPPED", f"{type(exc).__name__}: {str(exc)[:500]}"))
    return report
