"""G1 score and the exactness of the similarity join (vs brute force)."""

from __future__ import annotations

import itertools
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from farelake.functions import fuzzy
from farelake.functions.fuzzy import confidence, lcs_length, ratio, token_set_ratio
from farelake.operators import matching
from farelake.session import scratch_path
from farelake.sinks.snapshots import sized


def lcs_dp(a: str, b: str) -> int:
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if ca == cb else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


@given(st.text(alphabet="ab c", max_size=14), st.text(alphabet="ab c", max_size=14))
@settings(max_examples=400, deadline=None)
def test_bit_parallel_lcs_equals_dp(a, b):
    assert lcs_length(a, b) == lcs_dp(a, b)


def test_known_scores():
    assert ratio("this is a test", "this is a test!") == 97
    assert token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100
    assert token_set_ratio("new york mets vs atlanta braves", "atlanta braves vs new york mets") == 100
    assert token_set_ratio("cold rod", "old rod") == 93
    assert token_set_ratio("!!!", "abc") == 0
    assert confidence(None, "abc") == 0.0 and confidence("", "abc") == 0.0
    assert confidence("Helix", "HELIX") == 100.0


def test_reference_vendor_list_has_no_steward_pair():
    names = ["Creative Mobile Technologies, LLC", "Curb Mobility, LLC", "Myle Technologies Inc", "Helix"]
    best = max(token_set_ratio(a, b) for a, b in itertools.combinations(names, 2))
    assert best < 80


def _brute(names, min_score):
    out = set()
    for (i, a), (j, b) in itertools.combinations(enumerate(names), 2):
        s = confidence(a, b)
        if s >= min_score:
            out.add((i, j, s))
    return out


def _random_names(seed, n):
    rnd = random.Random(seed)
    words = ["blue", "blu", "rod", "rods", "cold", "old", "bolt", "bold", "gear", "gears", "x", "ab", "abc", "llc", "inc"]
    names = []
    for _ in range(n):
        k = rnd.randint(0, 4)
        name = " ".join(rnd.choice(words) for _ in range(k))
        if rnd.random() < 0.2:
            name = name.upper() + rnd.choice(["", ",", " & Co"])
        names.append(name if rnd.random() > 0.05 else None)
    return names


def test_similarity_join_is_exact(spark):
    for seed, min_score in [(1, 80.0), (2, 60.0), (3, 90.0)]:
        names = _random_names(seed, 70)
        # distinct canonical keys only (duplicates are reported against a canonical vendor)
        from farelake.functions.fuzzy import profile

        seen, kept = set(), []
        for n in names:
            key = profile(n)[0]
            if key and key not in seen:
                seen.add(key)
                kept.append(n)
        df = spark.createDataFrame(list(enumerate(kept)), "vendorid bigint, vendor_name string")
        got = {
            (r["source_vendorid"], r["matched_vendorid"], r["confidence"])
            for r in matching.match_vendors(df, min_score=min_score).collect()
        }
        assert got == _brute(kept, min_score), (seed, min_score)


def test_duplicate_names_map_to_canonical_vendor(spark):
    df = spark.createDataFrame(
        [(5, "Blue Rod"), (3, "rod blue"), (9, "BLUE, ROD"), (4, "cold gear")], "vendorid bigint, vendor_name string"
    )
    rows = {(r[0], r[2], r[4]) for r in matching.match_vendors(df).collect()}
    assert rows == {(3, 5, 100.0), (3, 9, 100.0)}


def test_names_are_profiled_once(spark):
    """The class table reads written keys; it does not make them from the names a second time."""
    rows = [(1, "Cold Rod"), (2, "rod, cold"), (3, "!!!"), (4, None), (None, "old rod"), (2, "rod, cold")]
    classes = matching.vendor_classes(spark.createDataFrame(rows, "vendorid bigint, vendor_name string"))
    plan = classes._jdf.queryExecution().optimizedPlan().toString()
    assert "array_distinct" not in plan and "regexp_replace" not in plan
    found = sorted((r["id"] or 0, r["key"], r["canon_id"], r["last_id"]) for r in classes.collect())
    assert found == [(0, "old rod", None, None), (1, "cold rod", 1, 2), (2, "cold rod", 1, 2), (2, "cold rod", 1, 2)]


def test_exploded_keys_are_not_broadcast(spark):
    """The signatures of a few names take many times the bytes of the names' files."""
    rnd = random.Random(5)
    text = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))
    names = [f"{text()} {text()} {text()}" for _ in range(2000)]
    names += [f"{n[:-1]}0" for n in names[:20]]
    df = spark.createDataFrame(list(enumerate(names)), "vendorid bigint, vendor_name string")
    old = spark.conf.get("spark.sql.maxBroadcastTableSize")
    spark.conf.set("spark.sql.maxBroadcastTableSize", "5m")
    try:
        found = {(r[0], r[2]) for r in matching.match_vendors(df, min_score=90.0).collect()}
    finally:
        spark.conf.set("spark.sql.maxBroadcastTableSize", old)
    assert found == {(i, 2000 + i) for i in range(20)}


def test_side_of_a_join_is_sized_by_its_rows(spark):
    """Ids in order and one name: a small file of many rows. Broadcast up to the bound, else shuffled."""
    path = scratch_path(spark, "sized")
    spark.range(50_000).select("id", F.lit("one name").alias("name")).write.parquet(path)
    side, rows = spark.read.parquet(path), spark.range(50_000)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plans = {}
    # 32 bytes a row: a null word, two columns, eight letters
    for bound in ("1599999", "1600000", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
        try:
            plans[bound] = rows.join(sized(side), "id", "left")._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert [("BroadcastHashJoin" in p, "SortMergeJoin" in p) for p in plans.values()] == [(False, True), (True, False), (False, True)]
    texts = spark.createDataFrame([(None, None), (1, "é"), (2, "123456789")], "id bigint, name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(3 * 24 + 8 + 16))
    try:
        assert "BroadcastHashJoin" in rows.join(sized(texts), "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_cartesian_product_in_plan(spark):
    df = spark.createDataFrame([(i, f"name {i}") for i in range(20)], "vendorid bigint, vendor_name string")
    plan = matching.match_vendors(df)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_similarity_join_is_exact_on_short_random_strings(spark):
    from farelake.functions.fuzzy import profile

    rnd = random.Random(7)
    raw = ["".join(rnd.choice("abcd  ") for _ in range(rnd.randint(1, 9))) for _ in range(120)]
    seen, kept = set(), []
    for n in raw:
        key = profile(n)[0]
        if key and key not in seen:
            seen.add(key)
            kept.append(n)
    df = spark.createDataFrame(list(enumerate(kept)), "vendorid bigint, vendor_name string")
    for min_score in (50.0, 60.0, 80.0):
        got = {
            (r["source_vendorid"], r["matched_vendorid"], r["confidence"])
            for r in matching.match_vendors(df, min_score=min_score).collect()
        }
        assert got == _brute(kept, min_score), min_score


def test_similarity_join_is_exact_with_long_names(spark):
    from farelake.functions.fuzzy import profile

    rnd = random.Random(11)
    base = ["".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(40, 90))) for _ in range(12)]
    raw = []
    for b in base:
        raw.append(b)
        for _ in range(4):  # near copies: a few random edits
            chars = list(b)
            for _ in range(rnd.randint(1, 8)):
                chars[rnd.randrange(len(chars))] = rnd.choice("abcdefgh ")
            raw.append("".join(chars))
    seen, kept = set(), []
    for n in raw:
        key = profile(n)[0]
        if key and key not in seen:
            seen.add(key)
            kept.append(n)
    df = spark.createDataFrame(list(enumerate(kept)), "vendorid bigint, vendor_name string")
    for min_score in (60.0, 80.0):
        got = {
            (r["source_vendorid"], r["matched_vendorid"], r["confidence"])
            for r in matching.match_vendors(df, min_score=min_score).collect()
        }
        assert got == _brute(kept, min_score), min_score


def _all_pairs(vendors):
    return [
        (a, b, fuzzy.confidence(na, nb))
        for a, na in vendors
        for b, nb in vendors
        if a < b and fuzzy.profile(na)[0] and fuzzy.profile(nb)[0]
    ]


def test_members_lose_no_source(spark):
    """Every vendor that is the smaller id of a qualifying pair is a source,
    once per other class, with the score of that class; names repeat."""
    for seed in (1, 5):
        vendors = list(enumerate(_random_names(seed, 90)))
        key = {i: fuzzy.profile(n)[0] for i, n in vendors}
        want = {(a, key[b], s) for a, b, s in _all_pairs(vendors) if s >= 80 and key[a] != key[b]}
        df = spark.createDataFrame(vendors, "vendorid bigint, vendor_name string")
        got = matching.match_members(df).collect()
        across = [(r[0], key[r[2]], r[4]) for r in got if key[r[0]] != key[r[2]]]
        assert len(across) == len(set(across)) and set(across) == want
        assert all(r["source_vendorid"] < r["matched_vendorid"] for r in got)
        inside = {r[2] for r in got if key[r[0]] == key[r[2]]}
        assert inside == {i for i in key if key[i] and min(j for j in key if key[j] == key[i]) != i}


def test_queue_resolves_every_member(spark):
    df = spark.createDataFrame(
        [(1, "cold rod"), (2, "rod cold"), (3, "old rod"), (4, "Rod, OLD")], "vendorid bigint, vendor_name string"
    )
    from farelake.operators import steward

    queue = steward.steward_queue(matching.route(matching.match_members(df))).collect()
    assert {(r["source_vendorid"], r["matched_vendorid"], r["confidence"]) for r in queue} == {(1, 3, 93.0), (2, 3, 93.0)}


def test_built_in_score_equals_the_definition(spark):
    names = [n for n in _random_names(9, 60) if fuzzy.profile(n)[0]] + ["Straße 5_x", "ÀÉ cafe", "日本 rod", "a-b_c d"]
    rows = [(a, b) for a in names for b in names]
    df = spark.createDataFrame(rows, "a string, b string")
    keys = df.select("a", "b", fuzzy.key_column(F.col("a")).alias("ka"), fuzzy.key_column(F.col("b")).alias("kb"))
    got = fuzzy.add_confidence(keys.filter("ka <> '' and kb <> ''"), "ka", "kb").collect()
    assert len(got) > 2000
    for r in got:
        assert r["ka"] == fuzzy.profile(r["a"])[0]
        assert r["confidence"] == fuzzy.confidence(r["a"], r["b"]), (r["a"], r["b"])
    chars = df.select("a", fuzzy.indexed_chars(fuzzy.key_column(F.col("a"))).alias("c")).distinct().collect()
    assert all(r["c"] == fuzzy.profile(r["a"])[2] for r in chars)
