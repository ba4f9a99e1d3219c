"""Registered queries: one callable ``(spark, base_dir) -> DataFrame`` per operator.

Every query reads the given tables (or data Spark derives from them) in full;
the run clock is the fixed ``AS_OF`` so that results are reproducible and
comparable with the SQL twins in ``farelake.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from farelake.config import DEFAULT_AS_OF, DEFAULT_JOB, MatchRules, TripRules
from farelake.functions.columns import normalize_flag
from farelake.operators import curated, golden, matching, publish, quality, scd2, steward
from farelake.operators.standardize import standardize_trips
from farelake.operators.validate import valid_fares, valid_trips
from farelake.session import scratch_path
from farelake.plans import runs
from farelake.sinks.dimensions import DimensionTable
from farelake.sinks.snapshots import BatchTable, SnapshotTable, append, materialize
from farelake.sources.landing import SchemaLog, read_landing, schema_drift
from farelake.sources.lookups import (
    ratecode_dictionary,
    read_zone_csv,
    vendor_dictionary,
    write_zone_csv,
    zone_lookup_rows,
)
from farelake.sources.masters import (
    ACTIVITY_SPLIT,
    order_activity,
    ratecode_master,
    vendor_master,
    vendor_names,
    vendor_parts,
)
from farelake.sources.tables import read_table
from farelake.sources.sql_text import run_sql
from farelake.sources.trips import raw_trips
from farelake.streaming.daily import stream_daily_metrics
from farelake.streaming.incremental import process_landing

AS_OF = DEFAULT_AS_OF
AS_OF_NEXT = "2026-01-02 00:00:00"
AS_OF_BETWEEN = "2026-01-01 12:00:00"
JOB = DEFAULT_JOB
STEWARD_APPROVES_FROM = 90.0
ROUTING = MatchRules(auto_above=84.0, review_low=75.0)
SCHEMA_CHANGE_AT = "2007-01-01 00:00:00"
SECOND_CHANGE_AT = "2009-06-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]


# -- shared building blocks ---------------------------------------------------

def standardized(spark: SparkSession, base: str) -> DataFrame:
    return standardize_trips(raw_trips(spark, base))


def trips_valid(spark: SparkSession, base: str) -> DataFrame:
    return valid_trips(standardized(spark, base), AS_OF)


def processed(spark: SparkSession, base: str) -> DataFrame:
    return valid_fares(trips_valid(spark, base))


def zones(spark: SparkSession, base: str) -> DataFrame:
    return golden.golden_zones(zone_lookup_rows(spark, base), AS_OF, JOB)


def fact(spark: SparkSession, base: str) -> DataFrame:
    # the zone dimension feeds two joins and is a written table, as in the run
    # flow, so the planner knows its bytes; the dictionaries are literals
    return curated.trip_details(
        processed(spark, base),
        materialize(zones(spark, base), "zone-dim"),
        vendor_dictionary(spark),
        ratecode_dictionary(spark),
    )


def mart(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A mart of the whole chain: aggregated per id, then named."""
    return curated.mart_of_trips(processed(spark, base), name, zones(spark, base), vendor_dictionary(spark))


# -- registered queries -------------------------------------------------------

def q_raw_trips(spark: SparkSession, base: str) -> DataFrame:
    return raw_trips(spark, base)


def q_standardized_trips(spark: SparkSession, base: str) -> DataFrame:
    return standardized(spark, base)


def q_valid_trips(spark: SparkSession, base: str) -> DataFrame:
    return trips_valid(spark, base)


def q_valid_fares(spark: SparkSession, base: str) -> DataFrame:
    return processed(spark, base)


def q_golden_zones(spark: SparkSession, base: str) -> DataFrame:
    return zones(spark, base)


def q_zone_role_join(spark: SparkSession, base: str) -> DataFrame:
    return curated.zone_role_join(processed(spark, base), materialize(zones(spark, base), "zone-dim"))


def q_trip_details(spark: SparkSession, base: str) -> DataFrame:
    return fact(spark, base)


def q_daily_metrics(spark: SparkSession, base: str) -> DataFrame:
    return mart(spark, base, "daily_metrics")


def q_location_performance(spark: SparkSession, base: str) -> DataFrame:
    return mart(spark, base, "location_performance").orderBy(F.desc("pickup_count"))


def q_vendor_performance(spark: SparkSession, base: str) -> DataFrame:
    return mart(spark, base, "vendor_performance")


def q_flag_normalization(spark: SparkSession, base: str) -> DataFrame:
    """P5: raw flag value → normalized flag, with trip counts (one scan)."""
    raw = raw_trips(spark, base).filter(F.col("VendorID").isin(*TripRules().vendor_ids))
    return (
        raw.select(
            F.col("store_and_fwd_flag").alias("raw_flag"),
            normalize_flag(F.col("store_and_fwd_flag")).alias("store_and_fwd_flag"),
        )
        .groupBy("raw_flag", "store_and_fwd_flag")
        .agg(F.count(F.lit(1)).alias("trips"))
    )


def q_ratecode_sentinel(spark: SparkSession, base: str) -> DataFrame:
    return standardized(spark, base).groupBy("RatecodeID").agg(F.count(F.lit(1)).alias("trips"))


def q_dq_report(spark: SparkSession, base: str) -> DataFrame:
    return quality.dq_report(raw_trips(spark, base))


def q_dq_gate(spark: SparkSession, base: str) -> DataFrame:
    """Q5: the gate of a staged batch, counted by the write that stages it."""
    watch = Observation()
    staged = processed(spark, base)
    staged.observe(watch, *quality.rule_counts(staged)).write.parquet(scratch_path(spark, "gate-staged"))
    return quality.gate_decision(quality.counted_report(spark, watch.get))


def q_dq_results(spark: SparkSession, base: str) -> DataFrame:
    """Q6: the rule results of a batch that fails the gate, as published per run."""
    lake = runs.Lakehouse(spark, scratch_path(spark, "dq-lake"), prefix="dq")
    watched, outcome_of = quality.observed(standardized(spark, base))
    watched.write.parquet(scratch_path(spark, "dq-staged"))
    runs.publish_rule_results(lake, outcome_of(), AS_OF)
    return spark.table("dq_dq_results").withColumn("run_id", F.col("run_id").cast("string"))


def q_golden_vendors(spark: SparkSession, base: str) -> DataFrame:
    return golden.golden_vendors(vendor_master(spark, base), AS_OF, JOB)


def q_golden_ratecodes(spark: SparkSession, base: str) -> DataFrame:
    return golden.golden_ratecodes(ratecode_master(spark, base), AS_OF, JOB)


def q_audit_columns(spark: SparkSession, base: str) -> DataFrame:
    return vendor_names(spark, base).select("vendorid", "vendor_name", *golden.audit_block(AS_OF, JOB))


def q_events_daily_window(spark: SparkSession, base: str) -> DataFrame:
    return curated.daily_window_counts(read_table(spark, base, "events"))


# -- matching and stewardship ---------------------------------------------------

def matches(spark: SparkSession, base: str) -> DataFrame:
    return matching.match_vendors(vendor_names(spark, base), min_score=80.0)


def queue(spark: SparkSession, base: str) -> DataFrame:
    return steward.steward_queue(matching.route(matches(spark, base)), AS_OF, JOB)


def decided_queue(spark: SparkSession, base: str) -> DataFrame:
    # the queue is a table in the real flow; written once here, read by both
    # branches of the SCD2 promotion
    return materialize(
        steward.record_decisions(queue(spark, base), F.col("confidence") >= STEWARD_APPROVES_FROM),
        "steward-queue",
    )


def q_vendor_pairs(spark: SparkSession, base: str) -> DataFrame:
    return matches(spark, base).select("source_vendorid", "matched_vendorid")


def q_vendor_match_scores(spark: SparkSession, base: str) -> DataFrame:
    return matches(spark, base)


def q_vendor_match_routing(spark: SparkSession, base: str) -> DataFrame:
    """G2 with bands inside the matched range, so that every route occurs."""
    found = matching.match_vendors(vendor_names(spark, base), min_score=70.0)
    return matching.route(found, ROUTING)


def q_steward_queue(spark: SparkSession, base: str) -> DataFrame:
    return queue(spark, base)


def q_steward_pending_count(spark: SparkSession, base: str) -> DataFrame:
    return steward.pending_count(queue(spark, base))


def q_steward_promotion(spark: SparkSession, base: str) -> DataFrame:
    vendors = scd2.initial_load(q_audit_columns(spark, base))
    return steward.promote(vendors, decided_queue(spark, base), AS_OF_NEXT, JOB)


def q_vendor_member_matches(spark: SparkSession, base: str) -> DataFrame:
    """J5/G1 over vendors whose names repeat: one row per member and similar class."""
    return matching.match_members(vendor_parts(spark, base), min_score=80.0)


def member_queue(spark: SparkSession, base: str) -> DataFrame:
    return steward.steward_queue(matching.route(q_vendor_member_matches(spark, base)), AS_OF, JOB)


def q_member_promotions(spark: SparkSession, base: str) -> DataFrame:
    """M4 over vendors whose names repeat: the promotion of every approved member."""
    decided = steward.record_decisions(
        member_queue(spark, base), F.col("confidence") >= STEWARD_APPROVES_FROM
    )
    return steward.promotions(materialize(decided, "member-queue"), AS_OF_NEXT, JOB)


def q_steward_mark_processed(spark: SparkSession, base: str) -> DataFrame:
    return steward.mark_processed(decided_queue(spark, base))


# -- type-2 history over two landings of the customer-activity dimension ----------

def activity_first(spark: SparkSession, base: str) -> DataFrame:
    # each landing is written once (as a landed batch would be) and read by
    # the close and the versioning branch of the SCD2 plan
    return materialize(order_activity(spark, base, AS_OF, until=ACTIVITY_SPLIT), "activity-1")


def activity_next(spark: SparkSession, base: str) -> DataFrame:
    return materialize(order_activity(spark, base, AS_OF_NEXT, since=ACTIVITY_SPLIT), "activity-2")


def history(spark: SparkSession, base: str) -> DataFrame:
    return scd2.apply_batch(scd2.initial_load(activity_first(spark, base)), activity_next(spark, base), "custkey")


def q_scd2_initial(spark: SparkSession, base: str) -> DataFrame:
    return scd2.initial_load(zones(spark, base))


def q_scd2_versioning(spark: SparkSession, base: str) -> DataFrame:
    target = scd2.initial_load(activity_first(spark, base))
    return scd2.versioned_batch(activity_next(spark, base), target, "custkey")


def q_scd2_apply(spark: SparkSession, base: str) -> DataFrame:
    return history(spark, base)


def q_current_dim(spark: SparkSession, base: str) -> DataFrame:
    return scd2.current_rows(history(spark, base))


def q_dim_as_of(spark: SparkSession, base: str) -> DataFrame:
    return scd2.rows_as_of(history(spark, base), AS_OF_BETWEEN)


def q_dim_key_uniqueness(spark: SparkSession, base: str) -> DataFrame:
    return scd2.key_uniqueness(history(spark, base), "custkey")


# -- sources and sinks that go through storage (shared folder) -------------------

def q_zones_lookup(spark: SparkSession, base: str) -> DataFrame:
    """S3: land the lookup as a header CSV, read it back as all-string columns."""
    path = scratch_path(spark, "zone-lookup")
    write_zone_csv(zone_lookup_rows(spark, base), path)
    return read_zone_csv(spark, path)


def drifting_files(spark: SparkSession, base: str) -> list[DataFrame]:
    """Three landings of the raw trips. The oldest was written before
    ``cbd_congestion_fee`` existed, the second has counts as integers and amounts
    as strings, the last a column of its own."""
    raw = raw_trips(spark, base)
    pickup = F.col("tpep_pickup_datetime")
    first, second = (F.lit(t).cast("timestamp_ntz") for t in (SCHEMA_CHANGE_AT, SECOND_CHANGE_AT))
    retyped = {
        "passenger_count": F.col("passenger_count").cast("bigint"),
        "payment_type": F.col("payment_type").cast("string"),
        "extra": F.col("extra").cast("string"),
    }
    return [
        raw.filter(pickup < first).drop("cbd_congestion_fee"),
        raw.filter((pickup >= first) & (pickup < second)).withColumns(retyped),
        raw.filter((pickup >= second) | pickup.isNull()).withColumn("sensor", F.lit("new")),
    ]


def q_raw_schema_evolution(spark: SparkSession, base: str) -> DataFrame:
    """Landings of three schemas, read with the declared columns."""
    landing = scratch_path(spark, "landing-evolving")
    for n, rows in enumerate(drifting_files(spark, base), 1):
        rows.write.parquet(f"{landing}/landing={n}")
    return read_landing(spark, landing).drop("sensor")


def q_schema_changes(spark: SparkSession, base: str) -> DataFrame:
    """What the schema log of the same landings says, landing by landing; each is inspected once."""
    root = scratch_path(spark, "landing-logged")
    log = SchemaLog(spark, f"{root}/log")
    for n, rows in enumerate(drifting_files(spark, base), 1):
        rows.write.parquet(f"{root}/landing/landing={n}")
        drift = schema_drift(spark, f"{root}/landing", log)
    landing = F.regexp_extract("path", "landing=([0-9])", 1).cast("int").alias("landing")
    return drift.select(landing, "column", "change").distinct()


def q_csv_landing(spark: SparkSession, base: str) -> DataFrame:
    """A landing of CSV files with a header beside Parquet files gives equal trips."""
    landing = scratch_path(spark, "landing-csv")
    raw = raw_trips(spark, base)
    older = F.col("tpep_pickup_datetime") < F.lit(SCHEMA_CHANGE_AT).cast("timestamp_ntz")
    # the writer would trim the padded flags
    keep = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    raw.filter(older).write.options(**keep).csv(f"{landing}/a")
    raw.filter(~older | older.isNull()).write.parquet(f"{landing}/b")
    return read_landing(spark, landing)


def q_quarantine_batch(spark: SparkSession, base: str) -> DataFrame:
    """K2: a batch that fails the gate (standardized, not validated) is
    appended to the quarantine table under its run id. The batch is staged
    once; the gate and the quarantine write read the staged files."""
    batch = materialize(standardized(spark, base), "gate-candidate")
    decision = quality.gate_decision(quality.dq_report(batch)).first()["decision"]
    if decision != "QUARANTINE":
        return quality.quarantine_rows(batch, AS_OF).filter(F.lit(False))
    path = scratch_path(spark, "quarantine")
    append(quality.quarantine_rows(batch, AS_OF), path, ["quarantine_run_id"])
    return spark.read.parquet(path)


def _land(spark: SparkSession, landings: list[DataFrame]) -> DataFrame:
    """Processed trips of landings that arrive one by one, each picked up by its own run."""
    root = scratch_path(spark, "incremental")
    table = BatchTable(spark, "processed", f"{root}/processed", gated=True)
    for n, rows in enumerate(landings, 1):
        rows.write.parquet(f"{root}/landing/file-{n}")
        process_landing(
            spark, f"{root}/landing", table, f"{root}/quarantine", f"{root}/checkpoint", AS_OF,
            schema_log=SchemaLog(spark, f"{root}/schema_log"),
        )
    return table.read()


def _halves(spark: SparkSession, base: str) -> list[DataFrame]:
    raw = raw_trips(spark, base)
    older = F.col("tpep_pickup_datetime") < F.lit(SCHEMA_CHANGE_AT).cast("timestamp_ntz")
    return [raw.filter(older), raw.filter(~older | older.isNull())]


def q_incremental_landing(spark: SparkSession, base: str) -> DataFrame:
    """Two landings picked up by two ``availableNow`` runs of one
    checkpointed stream; the result equals a full refresh (``valid_fares``)."""
    return _land(spark, _halves(spark, base))


def q_drifting_landing(spark: SparkSession, base: str) -> DataFrame:
    """S7 / L1 + S2: landings that lack, re-type and add columns pass through the stream."""
    return _land(spark, drifting_files(spark, base))


def long_marts(marts: dict[str, DataFrame]) -> DataFrame:
    """All rows and measures of the marts as one table."""
    parts = [df.withColumn("mart", F.lit(name)) for name, df in marts.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(
            part.withColumnsRenamed({"pickup_count": "total_trips", "revenue_in_M": "daily_revenue_in_M"}), allowMissingColumns=True
        )
    return out


def q_landed_marts(spark: SparkSession, base: str) -> DataFrame:
    """L1 + R1: two landings, each followed by masters, marts and export; the
    marts that were kept up after the second run cover both."""
    root = scratch_path(spark, "landed")
    lake = runs.Lakehouse(spark, f"{root}/lake", prefix="landed")
    for n, (rows, clock) in enumerate(zip(_halves(spark, base), (AS_OF, AS_OF_NEXT)), 1):
        rows.write.parquet(f"{root}/landing/file-{n}")
        runs.run_landed(
            lake, f"{root}/landing", f"{root}/checkpoint", zone_lookup_rows(spark, base),
            vendor_dictionary(spark), ratecode_dictionary(spark), clock, JOB,
        )
    return long_marts(runs.landed_marts(lake))


def q_registered_tables(spark: SparkSession, base: str) -> DataFrame:
    """Rows of the tables that a whole run leaves in the catalog, read by name."""
    lake = runs.Lakehouse(spark, scratch_path(spark, "registered"), prefix="registered")
    runs.run(
        lake, raw_trips(spark, base), zone_lookup_rows(spark, base), vendor_parts(spark, base),
        ratecode_dictionary(spark), AS_OF, JOB,
    )
    names = ["processed", "dim_zones", "dim_vendors", "dim_ratecodes", "steward_queue", "trip_details", *runs.MARTS, "dq_results"]
    counts = [spark.table(lake.name(n)).agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("rows")) for n in names]
    return reduce(DataFrame.union, counts)


def q_sql_text_step(spark: SparkSession, base: str) -> DataFrame:
    """A stored SQL step with named parameters over a frame."""
    text = "SELECT VendorID, payment_type, count(*) AS trips, max(trip_distance) AS longest FROM {trips} " \
           "WHERE tpep_pickup_datetime >= :since AND payment_type <= :top GROUP BY VendorID, payment_type"
    return run_sql(spark, text, {"since": SCHEMA_CHANGE_AT, "top": 4}, trips=processed(spark, base))


# -- tables that outlive a session ------------------------------------------------

def q_snapshot_overwrite(spark: SparkSession, base: str) -> DataFrame:
    """A snapshot overwritten by one of another schema, and batches
    added to a table, one of them twice; both are found by their path alone."""
    root = scratch_path(spark, "snapshot-overwrite")
    orders = read_table(spark, base, "orders")
    split = F.lit(ACTIVITY_SPLIT).cast("timestamp_ntz")
    SnapshotTable(spark, "orders", f"{root}/old").commit(orders.select("o_orderkey", F.lit(1).alias("retired")))
    wide = orders.select("o_orderkey", F.col("o_totalprice").cast("string").alias("price"), "o_orderdate")
    SnapshotTable(spark, "orders", f"{root}/old").commit(wide.filter(F.col("o_orderdate") < split))
    newer = wide.filter(F.col("o_orderdate") >= split)
    for name, rows in (("even", "o_orderkey % 2 = 0"), ("odd", "o_orderkey % 2 <> 0"), ("odd", "o_orderkey % 2 <> 0")):
        BatchTable(spark, "orders", f"{root}/new").put(newer.filter(rows), name)
    found = SnapshotTable(spark, "any name", f"{root}/old").read().unionByName(BatchTable(spark, "x", f"{root}/new").read())
    return found.select("o_orderkey", F.col("price").cast("double").alias("price"), "o_orderdate")


def q_scd2_second_run(spark: SparkSession, base: str) -> DataFrame:
    """M1–M3 on storage: two applies to a dimension in hash partitions, the second one repeated."""
    root = scratch_path(spark, "scd2-runs")
    for batch in (activity_first(spark, base), (again := activity_next(spark, base)), again):
        DimensionTable(spark, "activity", root, "custkey").upsert(batch)
    return DimensionTable(spark, "activity", root, "custkey").read()


def q_marts_one_pass(spark: SparkSession, base: str) -> DataFrame:
    """A1–A3: all marts from one scan of the joined fact."""
    combined = materialize(curated.marts_one_pass(fact(spark, base)), "marts")
    return long_marts(curated.split_marts(combined))


def q_queue_state(spark: SparkSession, base: str) -> DataFrame:
    """The queue on storage: two appends, decisions and marks as events, the latest status per row."""
    lake = runs.Lakehouse(spark, scratch_path(spark, "queue-events"), prefix="events")
    rows = materialize(queue(spark, base), "queue-rows")
    early = F.col("source_vendorid") % 2 == 0
    lake.queue.put(rows.filter(early), "first")
    decided = steward.decision_events(runs.queue_view(lake), F.col("confidence") >= STEWARD_APPROVES_FROM, AS_OF)
    lake.events.put(materialize(decided, "decisions"), "decided")
    # these arrive between the decision and the mark
    lake.queue.put(rows.filter(~early), "second")
    approved = runs.queue_view(lake).filter(F.col("status") == "APPROVED")
    lake.events.put(materialize(steward.status_events(approved, "PROCESSED", AS_OF_NEXT), "marks"), "marked")
    return runs.queue_view(lake)


def q_load_modes(spark: SparkSession, base: str) -> DataFrame:
    """K7: a table published twice, replaced and appended."""
    marts = mart(spark, base, "vendor_performance")
    found = []
    for mode in ("overwrite", "append"):
        path = scratch_path(spark, f"publish-{mode}")
        for _ in range(2):
            publish.publish(marts, publish.CONTRACTS_BY_NAME["vendor_performance"], path, mode)
        found.append(spark.read.parquet(path).withColumn("mode", F.lit(mode)))
    return found[0].union(found[1])


def _published(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    path = scratch_path(spark, f"publish-{table}")
    publish.publish(df, publish.CONTRACTS_BY_NAME[table], path)
    return spark.read.parquet(path)


def q_publish_dim_zones(spark: SparkSession, base: str) -> DataFrame:
    return _published(spark, scd2.initial_load(zones(spark, base)), "dim_zones")


def q_publish_dim_vendors(spark: SparkSession, base: str) -> DataFrame:
    return _published(spark, scd2.initial_load(q_golden_vendors(spark, base)), "dim_vendors")


def q_publish_dim_ratecodes(spark: SparkSession, base: str) -> DataFrame:
    return _published(spark, scd2.initial_load(q_golden_ratecodes(spark, base)), "dim_ratecodes")


def q_publish_trip_details(spark: SparkSession, base: str) -> DataFrame:
    return _published(spark, fact(spark, base), "trip_details")


def q_publish_daily_metrics(spark: SparkSession, base: str) -> DataFrame:
    return _published(spark, curated.daily_metrics(fact(spark, base)), "daily_metrics")


def q_publish_vendor_performance(spark: SparkSession, base: str) -> DataFrame:
    return _published(spark, curated.vendor_performance(fact(spark, base)), "vendor_performance")


def q_publish_location_performance(spark: SparkSession, base: str) -> DataFrame:
    return _published(spark, curated.location_performance(fact(spark, base), ordered=False), "location_performance")


def q_publish_colocated(spark: SparkSession, base: str) -> DataFrame:
    """K8: an aggregate by pickup zone over the fact as published in buckets of the zone."""
    name = "published_trip_details"
    publish.publish_colocated(
        fact(spark, base), publish.CONTRACTS_BY_NAME["trip_details"], scratch_path(spark, "publish-buckets"), name
    )
    return spark.table(name).groupBy("pulocationid").agg(
        F.count(F.lit(1)).alias("trips"), F.round(F.sum("total_amount"), 2).alias("revenue"), F.max("trip_distance").alias("longest")
    )


def late_landings(facts: DataFrame) -> list[DataFrame]:
    """Facts in three landings. Trips of the twenty days before the first cut that start in every fifth
    zone land one late, which the watermark allows; those that are ninety days old land too late."""
    pickup = F.col("tpep_pickup_datetime")
    first, second = (F.lit(t).cast("timestamp_ntz") for t in (SCHEMA_CHANGE_AT, SECOND_CHANGE_AT))
    fifth = F.col("pulocationid") % 5 == 0
    late = fifth & (pickup < first) & ((pickup >= first - F.expr("INTERVAL 20 DAY")) | (pickup < first - F.expr("INTERVAL 90 DAY")))
    return [
        facts.filter((pickup < first) & ~late),
        facts.filter(late | (pickup >= first) & (pickup < second)),
        facts.filter(pickup >= second),
    ]


def q_streamed_daily_metrics(spark: SparkSession, base: str) -> DataFrame:
    """L2: the measures of daily metrics in event time, over three landings with late trips."""
    root = scratch_path(spark, "streamed")
    facts = materialize(fact(spark, base), "streamed-facts")
    for n, rows in enumerate(late_landings(facts), 1):
        rows.write.parquet(f"{root}/facts/{n}")
        stream_daily_metrics(spark, f"{root}/facts", f"{root}/days", f"{root}/checkpoint", facts.schema, "40 days")
    return spark.read.parquet(f"{root}/days").select(
        "trip_date", "vendor_name", F.col("n").alias("total_trips"), F.round("sum_total", 4).alias("revenue"),
        F.round("sum_tip", 4).alias("tips"), F.col("max_distance").alias("longest"),
    )


def queries() -> dict[str, Query]:
    return {
        "raw_trips": q_raw_trips,
        "standardized_trips": q_standardized_trips,
        "valid_trips": q_valid_trips,
        "valid_fares": q_valid_fares,
        "golden_zones": q_golden_zones,
        "zone_role_join": q_zone_role_join,
        "trip_details": q_trip_details,
        "daily_metrics": q_daily_metrics,
        "location_performance": q_location_performance,
        "vendor_performance": q_vendor_performance,
        "flag_normalization": q_flag_normalization,
        "ratecode_sentinel": q_ratecode_sentinel,
        "dq_report": q_dq_report,
        "dq_gate": q_dq_gate,
        "golden_vendors": q_golden_vendors,
        "golden_ratecodes": q_golden_ratecodes,
        "audit_columns": q_audit_columns,
        "events_daily_window": q_events_daily_window,
        "vendor_pairs": q_vendor_pairs,
        "vendor_match_scores": q_vendor_match_scores,
        "vendor_match_routing": q_vendor_match_routing,
        "steward_queue": q_steward_queue,
        "steward_pending_count": q_steward_pending_count,
        "steward_promotion": q_steward_promotion,
        "steward_mark_processed": q_steward_mark_processed,
        "vendor_member_matches": q_vendor_member_matches,
        "vendor_member_promotions": q_member_promotions,
        "scd2_initial": q_scd2_initial,
        "scd2_versioning": q_scd2_versioning,
        "scd2_apply": q_scd2_apply,
        "current_dim": q_current_dim,
        "dim_as_of": q_dim_as_of,
        "dim_key_uniqueness": q_dim_key_uniqueness,
        "scd2_second_run": q_scd2_second_run,
        "snapshot_overwrite": q_snapshot_overwrite,
        "marts_one_pass": q_marts_one_pass,
        "zones_lookup": q_zones_lookup,
        "raw_schema_evolution": q_raw_schema_evolution,
        "schema_changes": q_schema_changes,
        "csv_landing": q_csv_landing,
        "sql_text_step": q_sql_text_step,
        "quarantine_batch": q_quarantine_batch,
        "incremental_landing": q_incremental_landing,
        "drifting_landing": q_drifting_landing,
        "landed_marts": q_landed_marts,
        "registered_tables": q_registered_tables,
        "queue_state": q_queue_state,
        "dq_results": q_dq_results,
        "load_modes": q_load_modes,
        "publish_dim_zones": q_publish_dim_zones,
        "publish_dim_vendors": q_publish_dim_vendors,
        "publish_dim_ratecodes": q_publish_dim_ratecodes,
        "publish_trip_details": q_publish_trip_details,
        "publish_colocated": q_publish_colocated,
        "streamed_daily_metrics": q_streamed_daily_metrics,
        "publish_daily_metrics": q_publish_daily_metrics,
        "publish_vendor_performance": q_publish_vendor_performance,
        "publish_location_performance": q_publish_location_performance,
    }
