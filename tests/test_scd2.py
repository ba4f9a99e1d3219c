"""SCD2 cases (FIXTURES.md §4) and invariants."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from farelake.operators import golden, scd2

T1, T2, T3 = "2026-01-01 00:00:00", "2026-02-01 00:00:00", "2026-03-01 00:00:00"


def batch(spark, rows, as_of, job="job"):
    df = spark.createDataFrame(rows, "id bigint, name string")
    return df.select("id", "name", *golden.audit_block(as_of, job))


def by_key(df):
    out = {}
    for r in df.orderBy("id", "version").collect():
        out.setdefault(r["id"], []).append(r)
    return out


def test_initial_and_apply_cases(spark):
    target = scd2.initial_load(batch(spark, [(1, "a"), (2, "b"), (3, "c")], T1))
    nxt = batch(spark, [(1, "a2"), (2, "b"), (4, "d")], T2, job="job2")
    after = by_key(scd2.apply_batch(target, nxt, "id"))
    # changed key: closed + reopened
    assert [(r["version"], r["is_current_flag"], r["name"]) for r in after[1]] == [(1, False, "a"), (2, True, "a2")]
    assert after[1][0]["effective_to"] == dt.datetime(2026, 2, 1) and after[1][0]["updated_by"] == "job2"
    # unchanged key in parity mode: still a new version
    assert [r["version"] for r in after[2]] == [1, 2]
    # absent key: untouched
    assert len(after[3]) == 1 and after[3][0]["is_current_flag"] and after[3][0]["effective_to"] is None
    # new key: version 1
    assert [(r["version"], r["is_current_flag"]) for r in after[4]] == [(1, True)]


def test_change_only_mode_skips_unchanged(spark):
    target = scd2.initial_load(batch(spark, [(1, "a"), (2, None)], T1))
    nxt = batch(spark, [(1, "a"), (2, None), (3, "c")], T2)
    after = by_key(scd2.apply_batch(target, nxt, "id", change_only=True))
    assert len(after[1]) == 1 and len(after[2]) == 1 and len(after[3]) == 1


def test_second_run_reaches_version_3_and_invariants(spark):
    dim = scd2.initial_load(batch(spark, [(1, "a"), (2, "b")], T1))
    dim = scd2.apply_batch(dim, batch(spark, [(1, "x")], T2), "id")
    dim = scd2.apply_batch(dim, batch(spark, [(1, "y"), (2, "z")], T3), "id")
    rows = by_key(dim)
    assert [r["version"] for r in rows[1]] == [1, 2, 3]
    for versions in rows.values():
        assert sum(r["is_current_flag"] for r in versions) == 1
        assert [r["version"] for r in versions] == list(range(1, len(versions) + 1))
        for older, newer in zip(versions, versions[1:]):
            assert older["effective_to"] == newer["effective_from"]
    summary = scd2.key_uniqueness(dim, "id").first()
    assert (summary["keys"], summary["current_rows"], summary["duplicate_keys"]) == (2, 2, 0)


def test_key_with_only_closed_rows_restarts_at_version_1(spark):
    target = scd2.initial_load(batch(spark, [(1, "a")], T1)).withColumn("is_current_flag", F.lit(False))
    after = by_key(scd2.apply_batch(target, batch(spark, [(1, "b")], T2), "id"))
    assert [(r["version"], r["is_current_flag"]) for r in after[1]] == [(1, False), (1, True)]


def test_duplicate_source_key_fails(spark):
    target = scd2.initial_load(batch(spark, [(1, "a")], T1))
    with pytest.raises(Exception, match="not unique"):
        scd2.apply_batch(target, batch(spark, [(1, "b"), (1, "c")], T2), "id").collect()


def test_as_of_view(spark):
    dim = scd2.apply_batch(scd2.initial_load(batch(spark, [(1, "a")], T1)), batch(spark, [(1, "b")], T2), "id")
    assert [r["name"] for r in scd2.rows_as_of(dim, "2026-01-15 00:00:00").collect()] == ["a"]
    assert [r["name"] for r in scd2.rows_as_of(dim, T2).collect()] == ["b"]
    assert scd2.rows_as_of(dim, "2025-12-31 00:00:00").count() == 0


def test_golden_zone_selection(spark):
    lookup = spark.createDataFrame(
        [("7", "Queens", "Astoria", "Boro Zone"), ("7", " Brooklyn ", "Zeta", "x"), ("7", None, "Zzz", "y"),
         ("x1", "Bronx", " Pad ", " EWR "), ("8", "Manhattan", "Alpha", "Yellow Zone")],
        "LocationID string, Borough string, Zone string, service_zone string",
    )
    out = {r["locationid"]: r for r in golden.golden_zones(lookup).collect()}
    assert out[7]["borough"] == "Queens" and out[7]["zone"] == "Astoria"  # desc, NULLs last
    assert out[None]["zone"] == "Pad" and out[None]["service_zone"] == "EWR"  # non-numeric id → NULL, trimmed
    assert out[8]["approved_by"] == "SYSTEM_AUTO_APPROVED" and out[8]["is_current_flag"] is True


def test_null_keys_are_appended_not_matched(spark):
    target = scd2.initial_load(batch(spark, [(1, "a")], T1))
    after = scd2.apply_batch(target, batch(spark, [(None, "x"), (None, "y"), (1, "b")], T2), "id")
    rows = after.filter("id IS NULL").collect()
    assert len(rows) == 2 and all(r["version"] == 1 and r["is_current_flag"] for r in rows)
    assert after.filter("id = 1").count() == 2


def test_new_and_retired_columns_survive_an_apply(spark):
    target = scd2.initial_load(batch(spark, [(1, "a"), (2, "b")], T1))
    wide = batch(spark, [(1, "a2"), (3, "c")], T2).withColumn("region", F.lit("west"))
    after = scd2.apply_batch(target, wide, "id")
    assert after.columns[:3] == ["id", "name", "region"]
    rows = {(r["id"], r["version"]): r["region"] for r in after.collect()}
    assert rows == {(1, 1): None, (2, 1): None, (1, 2): "west", (3, 1): "west"}
    narrow = scd2.apply_batch(after, batch(spark, [(3, "d")], T3), "id")
    assert {r["region"] for r in narrow.filter("id = 3").collect()} == {"west", None}


def test_batch_beyond_the_byte_threshold_is_not_broadcast(spark, tmp_path):
    target, nxt = str(tmp_path / "target"), str(tmp_path / "batch")
    scd2.initial_load(batch(spark, [(i, "a") for i in range(50)], T1)).write.parquet(target)
    batch(spark, [(i, "b") for i in range(40)], T2).write.parquet(nxt)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold, broadcast in (("-1", False), (old, True)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            applied = scd2.apply_batch(spark.read.parquet(target), spark.read.parquet(nxt), "id")
            plan = applied._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        assert ("BroadcastExchange" in plan) == broadcast
