"""G1: the fuzzy confidence of two names (token-set ratio, 0..100).

Definition (the public token-set ratio with full processing):

1. process each string: drop the characters U+0080..U+00FF, replace every
   non-word character with a space, lower-case, trim; an empty result → 0;
2. token sets A, B; ``i`` = sorted(A ∩ B) joined by spaces,
   ``x`` = ``i + ' ' + sorted(A − B)``, ``y`` = ``i + ' ' + sorted(B − A)``,
   both trimmed;
3. score = max(ratio(i, x), ratio(i, y), ratio(x, y)), where
   ratio(u, v) = 100 if u == v, 0 if either is empty, else
   round_half_even(100 · 2·LCS(u, v) / (|u| + |v|)).

``2·LCS/(|u|+|v|)`` is the indel-distance ratio (an insertion or deletion
costs 1, a substitution 2), so Spark's ``levenshtein`` is *not* this number.
LCS uses the bit-parallel recurrence (one big-int step per character).

The plain functions define the score. On columns, tokenizing, set operations
and the ratios are built-in functions; only the LCS of two prepared strings is
an Arrow ``pandas_udf``, over pairs that a Spark similarity join produced
(``farelake.operators.matching``), never over a cross product.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NON_WORD = re.compile(r"(?u)\W")
_LATIN1 = {code: None for code in range(128, 256)}
ELEMENT_SEP = "\x1f"


def process(value: str | None) -> str:
    """Full processing of one string (step 1)."""
    if value is None:
        return ""
    s = str(value).translate(_LATIN1)
    return _NON_WORD.sub(" ", s).lower().strip()


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence (bit-parallel)."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    bit = 1
    for ch in a:
        masks[ch] = masks.get(ch, 0) | bit
        bit <<= 1
    full = bit - 1
    v = full
    for ch in b:
        m = masks.get(ch)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def ratio(u: str, v: str) -> int:
    if u == v:
        return 100
    if not u or not v:
        return 0
    r = (2 * lcs_length(u, v)) / (len(u) + len(v))
    return int(round(100 * r))


def token_set_ratio(s1: str | None, s2: str | None) -> int:
    p1, p2 = process(s1), process(s2)
    if not p1 or not p2:
        return 0
    t1, t2 = set(p1.split()), set(p2.split())
    sect = " ".join(sorted(t1 & t2))
    x = (sect + " " + " ".join(sorted(t1 - t2))).strip()
    y = (sect + " " + " ".join(sorted(t2 - t1))).strip()
    return max(ratio(sect, x), ratio(sect, y), ratio(x, y))


def confidence(name1: str | None, name2: str | None) -> float:
    """0.0 when either name is NULL or empty, else the token-set ratio."""
    if not name1 or not name2:
        return 0.0
    return float(token_set_ratio(name1, name2))


def profile(value: str | None) -> tuple[str, list[str], list[str]]:
    """Blocking profile of one name: canonical key, token set, indexed chars.

    The key is ``sorted(tokens)`` joined by spaces (the string ``x`` of a pair
    with no shared token); the indexed characters ``c␟k`` (k-th occurrence of
    ``c``) turn the key's character multiset into a set.
    """
    tokens = sorted(set(process(value).split()))
    key = " ".join(tokens)
    seen: dict[str, int] = {}
    chars = []
    for ch in key:
        seen[ch] = seen.get(ch, 0) + 1
        chars.append(f"{ch}{ELEMENT_SEP}{seen[ch]}")
    return key, tokens, chars


def key_column(name: Column) -> Column:
    """Canonical key of a name (``profile``'s first part) from built-in functions."""
    kept = F.lower(F.regexp_replace(F.regexp_replace(name, "[\\u0080-\\u00FF]", ""), r"[^\p{L}\p{N}_]", " "))
    tokens = F.array_remove(F.split(kept, " +", -1), "")
    return F.coalesce(F.array_join(F.array_sort(F.array_distinct(tokens)), " "), F.lit(""))


def indexed_chars(key: Column) -> Column:
    """``c␟k`` for the k-th occurrence of each character ``c`` of a key."""
    def numbered(c: Column, i: Column) -> Column:
        prefix = F.substring(key, F.lit(1), i + 1)
        seen = F.char_length(prefix) - F.char_length(F.replace(prefix, c))
        return F.concat(c, F.lit(ELEMENT_SEP), seen.cast("string"))

    return F.transform(F.filter(F.split(key, "", -1), lambda c: c != ""), numbered)


@F.pandas_udf(T.LongType())
def _lcs(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([lcs_length(a, b) for a, b in zip(left, right, strict=True)], dtype="int64")


# Marked non-deterministic only so that the optimizer never repeats the Python
# call when a filter on the score is pushed through the projection.
lcs_column = _lcs.asNondeterministic()


def _percent(common: Column, u: Column, v: Column) -> Column:
    total = F.char_length(u) + F.char_length(v)
    return F.bround(F.lit(100.0) * (F.lit(2) * common / total), 0)


def add_confidence(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """``pairs`` with ``confidence`` (0..100) of two canonical keys.

    The shared tokens are a prefix of either full string, so their two ratios
    need lengths only; Python computes one LCS per pair, on prepared strings.
    """
    a, b = F.split(left, " "), F.split(right, " ")
    shared = F.array_intersect(a, b)
    rest = lambda t: F.filter(t, lambda w: ~F.array_contains(shared, w))
    text = pairs.withColumns(
        {
            "__i": F.array_join(shared, " "),
            "__x": F.array_join(F.concat(shared, rest(a)), " "),
            "__y": F.array_join(F.concat(shared, rest(b)), " "),
        }
    ).withColumn("__lcs", lcs_column("__x", "__y"))
    i, x, y = F.col("__i"), F.col("__x"), F.col("__y")
    prefix = lambda s: F.when(i == "", F.lit(0.0)).otherwise(_percent(F.char_length(i), i, s))
    score = F.greatest(prefix(x), prefix(y), _percent(F.col("__lcs"), x, y))
    return text.withColumn("confidence", score.cast("double")).drop("__i", "__x", "__y", "__lcs")
