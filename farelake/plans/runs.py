"""The run-level data flow.

``raw → processed → master → curated → warehouse`` as plain functions over
tables in one folder, called in order; the first failure stops the run (a
failed DQ gate raises ``DataQualityError`` after quarantining the batch).

* **raw → processed**: the standardized, validated batch is written once as a
  staged snapshot; the ruleset is counted by that write; on success the staged
  snapshot *becomes* the processed table (a pointer, no rewrite), on failure
  it is appended to quarantine under the run id and the run stops.
* **lookup → master**: golden zones/vendors/rate codes are applied to their
  SCD2 dimensions, each checked for one row per key before anything is
  written, each rewriting only the hash partitions it touches; vendor names
  are matched, the matches are resolved to every member vendor, and the steward
  rows are appended to the review queue.
* **steward review** (not part of the chain): approved rows are written to the
  promotions table, applied, and marked by status events. Promotions are known
  by the queue row they come from and applied under their first run's clock, so
  a review that is repeated after a failure promotes nothing twice.
* **processed → curated**: the fact is written once; the marts come from the
  partial measures of the processed trips per day, vendor and pickup location.
* **curated → warehouse**: typed export in contract order.

``run`` replaces the curated tables by those of one processed snapshot.
``run_landed`` adds what landed since the last run: facts and measures of the
new batches, the daily mart's touched months, and the small marts. Months, not
days, are the partitions of the measures and of the daily mart: a day has one
row per vendor and location, too little for a file of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.config import DEFAULT_AS_OF, DEFAULT_JOB, MatchRules, TripRules
from farelake.constants import APPROVED, PROCESSED
from farelake.operators import curated, golden, matching, publish, quality, scd2, steward
from farelake.operators.quality import DataQualityError
from farelake.operators.validate import processed_trips
from farelake.sinks.dimensions import DimensionTable
from farelake.sinks.snapshots import (
    BatchTable,
    SnapshotTable,
    append,
    materialize,
    overwrite_partitions,
    register_external,
    sized,
)
from farelake.sources.landing import SchemaLog
from farelake.streaming.incremental import process_landing

DIMENSIONS = {"dim_zones": "locationid", "dim_vendors": "vendorid", "dim_ratecodes": "ratecodeid"}
MARTS = ("daily_metrics", "location_performance", "vendor_performance")


@dataclass
class Lakehouse:
    """Where the tables of one deployment live (a folder on shared storage)."""

    spark: SparkSession
    root: str
    prefix: str = "farelake"

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def name(self, table: str) -> str:
        return f"{self.prefix}_{table}"

    def table(self, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, self.name(name), self.path(name))

    def batches(self, name: str, gated: bool = False) -> BatchTable:
        return BatchTable(self.spark, self.name(name), self.path(name), gated)

    def dimension(self, name: str) -> DimensionTable:
        return DimensionTable(self.spark, self.name(name), self.path(name), DIMENSIONS[name])

    def current(self, name: str) -> DataFrame:
        return scd2.current_rows(self.dimension(name).read())

    @property
    def queue(self) -> BatchTable:
        return self.batches("steward_queue")

    @property
    def events(self) -> BatchTable:
        return self.batches("steward_events")

    @property
    def landed(self) -> BatchTable:
        """The processed trips of ``run_landed``."""
        return self.batches("processed_landed", gated=True)

    @property
    def quarantine_path(self) -> str:
        return self.path("quarantine")

    @property
    def dq_results_path(self) -> str:
        return self.path("dq_results")

    @property
    def export_path(self) -> str:
        return self.path("warehouse_staging")


def run_label(as_of: str) -> str:
    """Name of a run's batch: the digits of its clock, marked so that it stays text."""
    return "r" + "".join(c for c in as_of if c.isdigit())[:14]


def publish_processed(
    lake: Lakehouse,
    raw: DataFrame,
    as_of: str = DEFAULT_AS_OF,
    rules: TripRules = TripRules(),
    ruleset: tuple[quality.Rule, ...] = quality.PROCESSED_RULES,
) -> quality.GateOutcome:
    table = lake.table("processed")
    watched, outcome_of = quality.observed(processed_trips(raw, as_of, rules), ruleset)
    staged_path = table.stage(watched, as_of)
    outcome = outcome_of()
    publish_rule_results(lake, outcome, as_of)
    if outcome.decision == "PUBLISH":
        table.adopt(staged_path)
        table.register()
        return outcome
    staged = lake.spark.read.parquet(staged_path)
    append(quality.quarantine_rows(staged, as_of), lake.quarantine_path, ["quarantine_run_id"])
    register_external(lake.spark, lake.name("quarantine"), lake.quarantine_path, partitioned=True)
    failed = [r["Rule"] for r in outcome.report if r["Outcome"] != quality.PASSED]
    raise DataQualityError(
        f"batch of {outcome.rows} rows quarantined under run {as_of}; failed rules: {failed}"
    )


def publish_rule_results(lake: Lakehouse, outcome: quality.GateOutcome, as_of: str) -> None:
    """Q6: this run's rule results (one row per rule) in ``dq_results``; a repeated run replaces its own."""
    if not outcome.report:
        return
    label = "".join(c for c in as_of if c.isdigit())
    run = f"{label[:8]}_{label[8:12]}"
    overwrite_partitions(
        quality.result_rows(lake.spark, outcome).withColumn("run_id", F.lit(run)), lake.dq_results_path, ["run_id"]
    )
    register_external(lake.spark, lake.name("dq_results"), lake.dq_results_path, {"run_id": run}, partitioned=True)


def build_masters(
    lake: Lakehouse,
    zone_lookup: DataFrame,
    vendors: DataFrame,
    ratecodes: DataFrame,
    as_of: str = DEFAULT_AS_OF,
    job_name: str = DEFAULT_JOB,
    match_rules: MatchRules = MatchRules(),
) -> int:
    """Build the master dimensions; return the number of steward rows this run adds."""
    batches = {
        "dim_zones": golden.golden_zones(zone_lookup, as_of, job_name),
        "dim_vendors": golden.golden_vendors(vendors, as_of, job_name),
        "dim_ratecodes": golden.golden_ratecodes(ratecodes, as_of, job_name),
    }
    for name, batch in batches.items():
        table = lake.dimension(name)
        table.upsert(batch)
        table.register()

    matches = matching.match_members(vendors, min_score=match_rules.review_low)
    new_rows = materialize(steward.steward_queue(matching.route(matches, match_rules), as_of, job_name), "queue-rows")
    lake.queue.put(new_rows, run_label(as_of))
    if lake.queue.exists():
        lake.queue.register(batch=run_label(as_of))
    return steward.pending_count(new_rows).first()["pending_count"]


def queue_view(lake: Lakehouse) -> DataFrame:
    """The review queue with the latest status of every row."""
    queue = lake.queue.read()
    return steward.queue_state(queue, lake.events.read()) if lake.events.exists() else queue


def review_queue(lake: Lakehouse, as_of: str = DEFAULT_AS_OF, job_name: str = DEFAULT_JOB) -> int:
    """Promote approved queue rows; return how many vendors this review promoted.

    1. Approved rows that no earlier review wrote down go to the promotions
       table, with this review's clock. 2. The promotions of rows that are still
       approved are applied, clock by clock; one that an earlier attempt applied
       is found in the dimension and left out. 3. Status events close them.
    """
    if not lake.queue.exists():
        return 0
    approved = materialize(queue_view(lake).filter(F.col("status") == APPROVED), "approved")
    if not approved.limit(1).count():
        return 0
    table = lake.batches("steward_promotions")
    key = steward.QUEUE_KEY
    new = approved.withColumn("promoted_at", F.lit(as_of))
    if table.exists():
        new = new.join(table.read().select(*key), key, "left_anti")
    table.put(materialize(new, "new-promotions"), run_label(as_of))
    due = materialize(table.read().join(approved.select(*key), key, "left_semi"), "due-promotions")
    promoted = 0
    # one clock per review that did not finish, and this one's
    for r in due.select("promoted_at").distinct().orderBy("promoted_at").collect():
        rows = due.filter(F.col("promoted_at") == r["promoted_at"]).drop("promoted_at")
        batch = materialize(steward.promotions(rows, r["promoted_at"], job_name), "promotions")
        lake.dimension("dim_vendors").upsert(batch)
        promoted += batch.count()
    lake.events.put(steward.status_events(due, PROCESSED, as_of), f"{run_label(as_of)}-done")
    return promoted


# -- curated tables of one processed snapshot --------------------------------------------

def _names(lake: Lakehouse, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names of the zones, and of the vendors that have trips in the measures ``state``.

    The vendor list may be far longer than what the trips name, and trips are
    many per vendor: joined to the whole list they would be shuffled.
    """
    used = materialize(state.select(F.col("VendorID").alias("_used")).distinct(), "used-vendors")
    vendors = lake.current("dim_vendors").select("vendorid", "vendor_name")
    named = materialize(vendors.join(sized(used), F.col("vendorid") == F.col("_used"), "left_semi"), "vendor-names")
    return sized(lake.current("dim_zones").select("locationid", "zone", "borough")), sized(named)


def _facts(lake: Lakehouse, trips: DataFrame, names: tuple[DataFrame, DataFrame]) -> DataFrame:
    ratecodes = lake.current("dim_ratecodes").select("ratecodeid", "ratecode_desc")
    return curated.trip_details(trips, *names, sized(ratecodes))


def build_curated(lake: Lakehouse, as_of: str = DEFAULT_AS_OF) -> dict[str, str]:
    """Write the fact once, and the marts from one aggregate over the processed trips."""
    processed = lake.table("processed").read()
    state = materialize(curated.trip_state(processed), "mart-state")
    names = _names(lake, state)
    fact = lake.table("trip_details")
    paths = {"trip_details": fact.commit(_facts(lake, processed, names), as_of)}
    fact.register()
    for name in MARTS:
        paths[name] = lake.table(name).commit(curated.mart_of_state(state, name, *names), as_of)
        lake.table(name).register()
    return paths


# -- curated tables of landed batches ------------------------------------------------------

def _signature(lake: Lakehouse) -> str:
    """What facts and marts take from the dimensions, as one number."""
    parts = {"dim_zones": ["locationid", "zone", "borough"], "dim_vendors": ["vendorid", "vendor_name"],
             "dim_ratecodes": ["ratecodeid", "ratecode_desc"]}
    sums = []
    for name, columns in parts.items():
        total = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
        sums.append(str(lake.current(name).agg(total.alias("h")).first()["h"]))
    return " ".join(sums)


def update_curated(lake: Lakehouse, as_of: str = DEFAULT_AS_OF) -> dict[str, list]:
    """Bring the curated tables up to the accepted batches of ``processed_landed``.

    Batches without facts get their facts and their measures (one partition per
    batch, and per month and batch); the daily mart is rewritten for the months
    that these batches have trips in. The two marts without a day come from the
    measures, not from the trips. If a name in a dimension has changed, facts
    and daily mart are rebuilt whole, as a full refresh would. Every step can be
    repeated; a batch is done when all of them are.
    """
    spark, done = lake.spark, lake.batches("curated_done")
    basis = lake.table("curated_basis")
    signature = _signature(lake)
    renamed = basis.exists() and basis.read().first()["signature"] != signature
    new = lake.landed.accepted()
    if done.exists() and not renamed:
        new = new.join(done.read().select(F.col("name").alias("batch")), "batch", "left_anti")
    names = sorted(r["batch"] for r in new.collect())
    if not names:
        return {"batches": [], "months": []}
    new = spark.createDataFrame([(n,) for n in names], "batch string")
    trips = lake.landed.read(new, keep_batch=True)
    state_path = lake.path("mart_state")
    measures = curated.trip_state(trips, (*curated.STATE_KEYS, "batch"))
    # doubles are added up in the order of the file, smallest first: it must not depend on the tasks
    _by_month(measures, state_path, "batch", order=("trip_date", "VendorID", "sum_tip", "PULocationID"))
    stored = spark.read.parquet(state_path)
    named = _names(lake, stored)
    # a batch is written on its own: its name is a constant, so no task sorts its facts by it
    for name in names:
        lake.batches("trip_details").put(_facts(lake, lake.landed.rows_of(name), named), name)
    months = sorted(r["month"] for r in stored.where(F.col("batch").isin(names)).select("month").distinct().collect())
    touched = stored if renamed else stored.where(F.col("month").isin(months))
    _by_month(curated.mart_of_state(touched, "daily_metrics", *named), lake.path("daily_metrics"))
    for name in ("location_performance", "vendor_performance"):
        lake.table(name).commit(curated.mart_of_state(stored, name, *named), as_of)
        lake.table(name).register()
    lake.batches("trip_details").register()
    register_external(spark, lake.name("daily_metrics"), lake.path("daily_metrics"), partitioned=True, replace=True)
    basis.commit(spark.range(1).select(F.lit(signature).alias("signature")), as_of)
    done.put_all(new.select(F.col("batch").alias("name"), "batch"))
    return {"batches": names, "months": months}


def _by_month(df: DataFrame, path: str, *more: str, order: tuple[str, ...] = ()) -> None:
    """Overwrite the months (and further partition columns) that ``df`` has rows for, one file each, its rows in ``order``."""
    placed = df.withColumn("month", F.year("trip_date") * 100 + F.month("trip_date"))
    files = placed.repartition("month", *more).sortWithinPartitions("month", *more, *order)
    overwrite_partitions(files, path, ["month", *more])


def landed_marts(lake: Lakehouse) -> dict[str, DataFrame]:
    """The marts that ``update_curated`` keeps."""
    daily = lake.spark.read.parquet(lake.path("daily_metrics")).drop("month")
    return {"daily_metrics": daily, **{name: lake.table(name).read() for name in MARTS[1:]}}


# -- export and the two runs -----------------------------------------------------------------

def _dimensions(lake: Lakehouse) -> dict[str, DataFrame]:
    found = {name: lake.dimension(name) for name in DIMENSIONS}
    return {name: table.read() for name, table in found.items() if table.exists()}


def export_warehouse(lake: Lakehouse, modes: dict[str, str] | None = None) -> list[tuple[str, str, str]]:
    """Typed export; ``modes`` sets ``overwrite`` or ``append`` per table (K7)."""
    tables = _dimensions(lake)
    for name in ("trip_details", *MARTS):
        table = lake.table(name)
        if table.exists():
            tables[name] = table.read()
    return publish.publish_all(tables, lake.export_path, modes)


def export_landed(lake: Lakehouse, batches: list[str], modes: dict[str, str] | None = None) -> list[tuple[str, str, str]]:
    """Typed export after ``update_curated``: the facts of the given batches, a folder per batch that
    a repeated export replaces; dimensions and marts whole."""
    report = publish.publish_all({**_dimensions(lake), **landed_marts(lake)}, lake.export_path, modes)
    report = [r for r in report if r[0] != "trip_details"]
    contract = publish.CONTRACTS_BY_NAME["trip_details"]
    for name in batches:
        path = f"{lake.export_path}/trip_details/batch={name}"
        publish.publish(lake.batches("trip_details").rows_of(name), contract, path, "overwrite")
        report.append(("trip_details", "PUBLISHED", path))
    return report


def run(
    lake: Lakehouse,
    raw: DataFrame,
    zone_lookup: DataFrame,
    vendors: DataFrame,
    ratecodes: DataFrame,
    as_of: str = DEFAULT_AS_OF,
    job_name: str = DEFAULT_JOB,
    modes: dict[str, str] | None = None,
) -> dict:
    """The four stages in order; an exception stops the run."""
    gate = publish_processed(lake, raw, as_of)
    pending = build_masters(lake, zone_lookup, vendors, ratecodes, as_of, job_name)
    curated_paths = build_curated(lake, as_of)
    export = export_warehouse(lake, modes)
    return {"gate": gate.decision, "processed_rows": gate.rows, "pending_review": pending,
            "curated": curated_paths, "export": export}


def run_landed(
    lake: Lakehouse,
    landing_path: str,
    checkpoint_path: str,
    zone_lookup: DataFrame,
    vendors: DataFrame,
    ratecodes: DataFrame,
    as_of: str = DEFAULT_AS_OF,
    job_name: str = DEFAULT_JOB,
    modes: dict[str, str] | None = None,
) -> dict:
    """L1 + R1: process what landed since the last run, then masters, marts and export.

    A lake is kept by ``run`` or by ``run_landed``, not by both. A micro-batch
    that fails the gate is quarantined and stops the run.
    """
    landing = process_landing(
        lake.spark, landing_path, lake.landed, lake.quarantine_path, checkpoint_path, as_of,
        dq_results_path=lake.dq_results_path, schema_log=SchemaLog(lake.spark, lake.path("schema_log")),
        corrupt_path=lake.path("corrupt"),
    )
    pending = build_masters(lake, zone_lookup, vendors, ratecodes, as_of, job_name)
    changed = update_curated(lake, as_of)
    return {"batches": landing.batches, "pending_review": pending, "curated": changed,
            "export": export_landed(lake, changed["batches"], modes)}
