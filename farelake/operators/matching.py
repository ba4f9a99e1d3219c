"""Vendor-name matching as an exact similarity self-join.

Reference semantics: score every unordered pair of vendors
(``v1.vendorid < v2.vendorid``), route > 95 to auto-approval, 80..95 to a
steward, the rest to manual resolution, and keep only the steward rows. Only
pairs scoring at least the lowest kept band can ever be kept, so this module
finds exactly the pairs with ``score >= min_score`` without enumerating all
pairs (no cross join, no per-group all-pairs):

1. **Profiles.** Each name becomes its canonical key (sorted distinct
   processed tokens joined by spaces), its token set and its indexed
   characters. Names with the same key have identical scores against
   everyone; they collapse to one *canonical* vendor (smallest id) and each
   other member is reported once against it with score 100 (linear, never
   all pairs inside a group).
2. **Necessary conditions.** Let ``t = (min_score - 0.5)/100`` (a score
   rounds to at least ``min_score`` only if ``2·LCS/(|u|+|v|) >= t``) and
   ``c = t / (2 - t)``. A pair reaches ``t`` through ``ratio(x, y)`` or
   through ``ratio(i, x)`` / ``ratio(i, y)``:

   * ``ratio(x, y) >= t`` ⇒ the character multisets of the two keys have
     Dice ≥ t (LCS ≤ multiset overlap), hence lengths within a factor ``c``
     and an overlap of at least ``ceil(c·|key|)`` for either key. Order the
     indexed characters globally rarest-first; by the k-prefix lemma two
     such keys share two elements inside their first
     ``|key| - ceil(c·|key|) + 2`` elements, so every pair of prefix
     elements is a join signature (keys too short for an overlap of two use
     single elements; they are few and only meet each other; keys longer
     than ``SIG_MAX_LEN`` also use single elements, so no key emits more
     join rows than linear in its length).
   * ``ratio(i, x) >= t`` ⇔ ``|i| >= c·|x|``: the shared tokens carry at
     least ``c·|x| + 1`` of key A's token weight (weight = length + 1).
     Token prefix filtering: A keeps its rarest-first tokens until the rest
     weighs less than that; B must contain one of them.

   Both candidate sets are equi-joins on prefix signatures with positional
   and length bounds in the join condition, so every pair that can reach
   ``min_score`` is generated (exact) and a single common character or
   token never forms a join group of its own unless a key has nothing rarer.
   Measured on 1,600 deliberately uniform names (64 product names × 25
   brands, 6% of all pairs truly match): 352 k candidates for 1.28 M pairs,
   equal to brute force.
3. **Verification** of each candidate with the exact score (one LCS per pair
   in an Arrow UDF, the rest built-in functions).
4. **Members.** ``resolve_members`` brings the matches of canonical vendors to
   every member of their classes by equi-joins, one row per member and class.

Shuffles: element frequency (partial aggregation), one regroup per key, the
two candidate joins (AQE splits a skewed element partition), one distinct. A table
that grows with the vendors is broadcast only if its rows fit (``sized``).
The profiles and the distinct keys are written once to the shared folder
(the Python profile runs once per vendor; the branches read files).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.config import MatchRules
from farelake.constants import MANUAL_RESOLUTION, STEWARD_REVIEW, SYSTEM_AUTO_APPROVED
from farelake.functions.fuzzy import add_confidence, indexed_chars, key_column
from farelake.session import ship_package
from farelake.sinks.snapshots import materialize, sized


SIG_SEP = "\x1e"
# Keys up to this length use 2-element signatures (at most C(p, 2) per key);
# longer keys use single prefix elements, so no key ever emits more than a
# linear number of join rows in its length.
SIG_MAX_LEN = 64


def _thresholds(min_score: float) -> tuple[float, float]:
    t = (min_score - 0.5) / 100.0 - 1e-9
    t = max(t, 1e-9)
    return t, t / (2.0 - t)


def vendor_profiles(vendors: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """``id, name, key`` for every vendor with a non-empty key.

    A key is dear and a vendor a few bytes: vendors are spread over the tasks
    before, and the keys are written once, before any branch filters by them.
    """
    spread = vendors.select(F.col(id_col).alias("id"), F.col(name_col).alias("name")).repartition("id", "name")
    return materialize(spread.withColumn("key", key_column(F.col("name"))), "vendor-profiles").filter(F.length("key") > 0)


def ranked_elements(keys: DataFrame) -> DataFrame:
    """``key, kind, els``: each key's tokens and indexed characters, rarest first.

    ``els`` is an ``array<struct<df, e, w>>`` (any fixed global order keeps
    prefix filtering exact). Tokens and characters share one frequency
    aggregate and one regroup; the frequency table is written, and broadcast
    only if its rows fit, else both sides shuffle on the element (skewed
    elements are split by AQE).
    """
    tokens = keys.select("key", F.lit("token").alias("kind"), F.explode("tokens").alias("e"))
    chars = keys.select("key", F.lit("char").alias("kind"), F.explode("chars").alias("e"))
    both = tokens.withColumn("w", F.length("e") + 1).unionByName(chars.withColumn("w", F.lit(1)))
    freq = materialize(both.groupBy("kind", "e").agg(F.count(F.lit(1)).alias("df")), "vendor-frequencies")
    ranked = both.join(sized(freq), ["kind", "e"]).select("key", "kind", F.struct("df", "e", "w").alias("x"))
    return ranked.groupBy("key", "kind").agg(F.array_sort(F.collect_list("x")).alias("els"))


def _suffix_weight(i):
    """Total weight of ``els`` from 0-based position ``i`` to the end."""
    return F.aggregate(F.slice("els", i + 1, F.size("els") - i), F.lit(0), lambda acc, y: acc + y["w"])


def token_positions(per_key: DataFrame) -> DataFrame:
    """``key, len, tok, pos, sw``: every token of every key in rarest-first
    order, with the weight of the key's tokens from that position on."""
    placed = F.transform("els", lambda x, i: F.struct(x["e"].alias("tok"), i.alias("pos"), _suffix_weight(i).alias("sw")))
    return per_key.select("key", F.length("key").alias("len"), F.explode(placed).alias("x")).select(
        "key", "len", "x.tok", "x.pos", "x.sw"
    )


def char_signatures(per_key: DataFrame, c: float) -> DataFrame:
    """``key, len, sig, pos`` — 2-element signatures of each key's Dice prefix.

    k-prefix lemma: if two keys share at least α elements, their prefixes of
    length ``|x| - α + 2`` share at least two, and the two rarest shared
    elements form a common signature. A per-key lower bound of α is
    ``ceil(c·|x|)`` (the length filter makes it valid for every partner), so
    the prefix is ``|x| - ceil(c·|x|) + 2`` elements (at most ``|x|``) and
    every pair of prefix elements (in rarest-first order) is a signature.
    A single very common character therefore never forms a join group on its
    own. ``pos`` is the position of the signature's later element.
    """
    n = F.length("key")
    p = F.least(n - F.ceil(F.lit(c) * n) + 2, n).cast("int")
    pre = F.slice("els", 1, p)
    sigs = F.flatten(
        F.transform(
            F.sequence(F.lit(0), p - 2),
            lambda i: F.transform(
                F.sequence(i + 1, p - 1),
                lambda j: F.struct(
                    F.concat(pre[i]["e"], F.lit(SIG_SEP), pre[j]["e"]).alias("sig"), j.alias("pos")
                ),
            ),
        )
    )
    return (
        per_key.filter((n >= 2) & (n <= SIG_MAX_LEN))
        .select("key", n.alias("len"), F.explode(sigs).alias("x"))
        .select("key", "len", "x.sig", "x.pos")
    )


def long_key_pairs(per_key: DataFrame, t: float, c: float) -> DataFrame:
    """Pairs with at least one key longer than ``SIG_MAX_LEN``: single-element
    Dice prefixes (``|x| - ceil(c·|x|) + 1`` rarest elements, the k = 1
    lemma) with the positional bound ``1 + min(rest of A, rest of B)``. Only
    keys of length ≥ ``c·SIG_MAX_LEN`` can pair with such a key."""
    per_key = per_key.filter(F.length("key") >= int(c * SIG_MAX_LEN))
    n = F.length("key")
    p = (n - F.ceil(F.lit(c) * n) + 1).cast("int")
    placed = F.transform(F.slice("els", 1, p), lambda x, i: F.struct(x["e"].alias("e"), i.alias("pos")))
    cp = per_key.select("key", n.alias("len"), F.explode(placed).alias("x")).select("key", "len", "x.e", "x.pos")
    left = cp.select(F.col("key").alias("ka"), F.col("len").alias("la"), "e", F.col("pos").alias("pa"))
    right = cp.select(F.col("key").alias("kb"), F.col("len").alias("lb"), "e", F.col("pos").alias("pb"))
    bound = F.least(F.col("la") - F.col("pa"), F.col("lb") - F.col("pb"))
    return (
        left.join(right.hint("merge"), "e")
        .filter(F.col("ka") < F.col("kb"))
        .filter(F.greatest("la", "lb") > SIG_MAX_LEN)
        .filter(F.least("la", "lb") >= F.lit(c) * F.greatest("la", "lb"))
        .filter(bound >= F.lit(t) * (F.col("la") + F.col("lb")) / 2)
        .select("ka", "kb")
    )


def short_key_pairs(keys: DataFrame, t: float, c: float) -> DataFrame:
    """Pairs the 2-signature lemma does not cover: both keys so short that
    an overlap of one element could already be enough (``|x| <= 1/c``).
    Such keys are few (their number is bounded by the alphabet), and they
    only pair with each other because of the length filter."""
    limit = int(1.0 / c)
    short = keys.filter(F.length("key") <= limit).select(
        "key", F.length("key").alias("len"), F.explode("chars").alias("e")
    )
    left = short.select(F.col("key").alias("ka"), F.col("len").alias("la"), "e")
    right = short.select(F.col("key").alias("kb"), F.col("len").alias("lb"), "e")
    return (
        left.join(right, "e")
        .filter(F.col("ka") < F.col("kb"))
        .filter(F.least("la", "lb") >= F.lit(c) * F.greatest("la", "lb"))
        .select("ka", "kb")
    )


def candidate_key_pairs(keys: DataFrame, min_score: float) -> DataFrame:
    """Every pair of distinct keys that can score ≥ ``min_score`` (plus some
    that cannot; they are removed by verification). Columns ``ka < kb``.

    Positional filters (exact): on the *first* shared element (signature) of a
    pair all other shared elements come later in both rarest-first orders, so

    * tokens: the shared weight is at most B's suffix weight from there, and
      must reach ``c·|A| + 1``;
    * characters: the overlap is at most ``2 + min(rest of A, rest of B)``
      after the signature's later element, and must reach
      ``t·(|A| + |B|) / 2``.

    A join row failing its bound is dropped; the row of the first shared
    signature of a qualifying pair always passes.

    The joins are shuffled by hint: the planner knows their sides by the files
    before the explode, so it would broadcast many times what it takes them for.
    """
    t, c = _thresholds(min_score)
    # feeds all branches: computed once, read from files
    elements = materialize(ranked_elements(keys), "vendor-elements")
    tp = token_positions(elements.filter(F.col("kind") == "token"))
    need = F.lit(c) * F.col("la") + 1
    probe = tp.filter(F.col("sw") >= F.lit(c) * F.col("len") + 1).select(
        F.col("key").alias("ka"), F.col("len").alias("la"), "tok"
    )
    index = tp.select(F.col("key").alias("kb"), "tok", F.col("sw").alias("swb"))
    by_token = (
        probe.join(index.hint("merge"), "tok")
        .filter((F.col("ka") != F.col("kb")) & (F.col("swb") >= need))
        .select(F.least("ka", "kb").alias("ka"), F.greatest("ka", "kb").alias("kb"))
    )
    ranked = elements.filter(F.col("kind") == "char").select("key", "els")
    cs = char_signatures(ranked, c)
    left = cs.select(F.col("key").alias("ka"), F.col("len").alias("la"), "sig", F.col("pos").alias("pa"))
    right = cs.select(F.col("key").alias("kb"), F.col("len").alias("lb"), "sig", F.col("pos").alias("pb"))
    overlap_bound = F.least(F.col("la") - F.col("pa"), F.col("lb") - F.col("pb")) + 1
    by_chars = (
        left.join(right.hint("merge"), "sig")
        .filter(F.col("ka") < F.col("kb"))
        .filter(F.least("la", "lb") >= F.lit(c) * F.greatest("la", "lb"))
        .filter(overlap_bound >= F.lit(t) * (F.col("la") + F.col("lb")) / 2)
        .select("ka", "kb")
    )
    out = by_token.unionByName(by_chars)
    out = out.unionByName(short_key_pairs(keys, t, c)).unionByName(long_key_pairs(ranked, t, c))
    return out.distinct()


def match_vendors(
    vendors: DataFrame,
    id_col: str = "vendorid",
    name_col: str = "vendor_name",
    min_score: float = 80.0,
) -> DataFrame:
    """G1 over the similarity join: ``source_vendorid, source_vendor_name,
    matched_vendorid, matched_vendor_name, confidence`` for every pair of
    canonical vendors with ``confidence >= min_score`` (source id < matched
    id), and for every other member of a class against its canonical vendor.
    ``vendor_classes`` has the members of every class."""
    ship_package(vendors.sparkSession)
    classes = materialize(vendor_classes(vendors, id_col, name_col), "vendor-classes")
    return _match_classes(classes, min_score)


def vendor_classes(vendors: DataFrame, id_col: str = "vendorid", name_col: str = "vendor_name") -> DataFrame:
    """The linear membership table: every vendor with its class.

    ``id, name, key, canon_id, canon_name, last_id, last_name``: vendors with
    the same canonical key score the same against everyone; the class is named
    by its smallest id, ``last_id`` is its largest. One aggregate (combined
    map-side) and one equi-join on the key.
    """
    prof = vendor_profiles(vendors, id_col, name_col)
    keys = prof.groupBy("key").agg(
        F.min("id").alias("canon_id"),
        F.min_by("name", "id").alias("canon_name"),
        F.max("id").alias("last_id"),
        F.max_by("name", "id").alias("last_name"),
    )
    return prof.join(sized(materialize(keys, "vendor-keys")), "key")


def resolve_members(matches: DataFrame, classes: DataFrame) -> DataFrame:
    """Matches of canonical vendors → one row per member and similar class.

    Every vendor that would be the smaller id of some pair with a member of
    the other class is a source here, against one member of that class with a
    larger id: the smallest if that is larger, else the largest. All pairs
    between two classes are never built; the rows grow with the members. Rows
    inside a class (score 100 by construction) stay as they are. The matches
    between classes are written, so that they are broadcast to the members, if
    any side is: there is a member per vendor.
    """
    heads = classes.filter(F.col("id") == F.col("canon_id")).select(
        F.col("id").alias("head"), "last_id", "last_name"
    )
    others = classes.filter(F.col("id") != F.col("canon_id")).select(F.col("id").alias("matched_vendorid"), F.lit(True).alias("inner"))
    across = matches.join(sized(others), "matched_vendorid", "left")
    inside = across.filter(F.col("inner").isNotNull()).select(*matches.columns)
    pairs = across.filter(F.col("inner").isNull())
    one_way = pairs.select(
        F.col("source_vendorid").alias("mine"),
        F.col("matched_vendorid").alias("head"),
        F.col("matched_vendor_name").alias("head_name"),
        *[c for c in matches.columns if c not in MATCH_COLUMNS[:4]],
    )
    other_way = pairs.select(
        F.col("matched_vendorid").alias("mine"),
        F.col("source_vendorid").alias("head"),
        F.col("source_vendor_name").alias("head_name"),
        *[c for c in matches.columns if c not in MATCH_COLUMNS[:4]],
    )
    members = classes.select(F.col("canon_id").alias("mine"), "id", "name")
    first = F.col("head") > F.col("id")
    ways = materialize(one_way.unionByName(other_way).join(sized(heads), "head"), "vendor-ways")
    resolved = (
        members.join(sized(ways), "mine")
        .filter(F.col("last_id") > F.col("id"))
        .select(
            F.col("id").alias("source_vendorid"),
            F.col("name").alias("source_vendor_name"),
            F.when(first, F.col("head")).otherwise(F.col("last_id")).alias("matched_vendorid"),
            F.when(first, F.col("head_name")).otherwise(F.col("last_name")).alias("matched_vendor_name"),
            *[c for c in matches.columns if c not in MATCH_COLUMNS[:4]],
        )
    )
    return resolved.unionByName(inside)


def match_members(
    vendors: DataFrame,
    id_col: str = "vendorid",
    name_col: str = "vendor_name",
    min_score: float = 80.0,
) -> DataFrame:
    """``match_vendors`` resolved to every member vendor, same columns."""
    ship_package(vendors.sparkSession)
    classes = materialize(vendor_classes(vendors, id_col, name_col), "vendor-classes")
    matches = materialize(_match_classes(classes, min_score), "vendor-matches")
    return resolve_members(matches, classes)


MATCH_COLUMNS = ["source_vendorid", "source_vendor_name", "matched_vendorid", "matched_vendor_name", "confidence"]


def _match_classes(classes: DataFrame, min_score: float) -> DataFrame:
    canonical = classes.filter(F.col("id") == F.col("canon_id"))
    keys = materialize(
        canonical.select(
            "key",
            "canon_id",
            "canon_name",
            F.split("key", " ").alias("tokens"),
            indexed_chars(F.col("key")).alias("chars"),
        ).dropDuplicates(["key"]),
        "vendor-canonical",
    )
    pairs = candidate_key_pairs(keys.select("key", "tokens", "chars"), min_score)
    named = sized(keys.select("key", "canon_id", "canon_name"))
    a = named.select(F.col("key").alias("ka"), F.col("canon_id").alias("ida"), F.col("canon_name").alias("na"))
    b = named.select(F.col("key").alias("kb"), F.col("canon_id").alias("idb"), F.col("canon_name").alias("nb"))
    scored = add_confidence(pairs.join(a, "ka").join(b, "kb"), "ka", "kb").filter(
        F.col("confidence") >= min_score
    )
    swap = F.col("ida") > F.col("idb")
    across = scored.select(
        F.when(swap, F.col("idb")).otherwise(F.col("ida")).alias("source_vendorid"),
        F.when(swap, F.col("nb")).otherwise(F.col("na")).alias("source_vendor_name"),
        F.when(swap, F.col("ida")).otherwise(F.col("idb")).alias("matched_vendorid"),
        F.when(swap, F.col("na")).otherwise(F.col("nb")).alias("matched_vendor_name"),
        "confidence",
    )
    members = (
        classes.filter(F.col("id") != F.col("canon_id"))
        .select(
            F.col("canon_id").alias("source_vendorid"),
            F.col("canon_name").alias("source_vendor_name"),
            F.col("id").alias("matched_vendorid"),
            F.col("name").alias("matched_vendor_name"),
            F.lit(100.0).alias("confidence"),
        )
    )
    return across.unionByName(members) if min_score <= 100 else across


def route(matches: DataFrame, rules: MatchRules = MatchRules()) -> DataFrame:
    """``approved_by`` from the confidence band."""
    conf = F.col("confidence")
    return matches.withColumn(
        "approved_by",
        F.when(conf > rules.auto_above, F.lit(SYSTEM_AUTO_APPROVED))
        .when(conf.between(rules.review_low, rules.auto_above), F.lit(STEWARD_REVIEW))
        .otherwise(F.lit(MANUAL_RESOLUTION)),
    )
