"""Operator 10: secret scans with sliding-window entropy.

Three base patterns (assignments, access keys, long hex runs) are matched
leftmost and non-overlapping. The entropy method then adds spans: candidate runs
of at least ``SHORTEST`` characters that mix letters and digits are swept by a
window of ``WINDOW`` characters (the whole run, if it is shorter). The sum of
``c * log2(c)`` over the character counts is updated for the one character that
enters and the one that leaves, which gives the Shannon entropy of every window.
A window counts when it mixes letters and digits and its entropy reaches the
threshold of the class of its characters: hex, digits with one letter case, or
any. The thresholds are those that 99.5 % of random strings of the class and
window length reach. A run with such a window is reported unless a base span
already covers part of it.

The allow-list works on the segments of a run between ``/`` and ``=``: a segment
it names is blanked out, and windows that touch it do not count; the rest of the
run is judged as usual. A run in which every part between separators is letters
only or digits only is a name, not a secret.

Everything is an expression of built-in functions: one scan, no shuffle.
``regexp_extract_all`` gives the matches, ``split`` with the same pattern the
gaps between them, and their code-point lengths give the positions, summed in
blocks of ``BLOCK`` matches. Runs longer than ``PIECE`` are swept in pieces that
overlap by a window, so time grows linearly with a run and with the number of
matches.

Defined cases: a null or empty text has no spans; a repeated row is reported
per row; positions are code points, end exclusive; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import bind, documents, text_of

ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# A run shorter than the minimum fails at each of its characters, so the
# bounded forms find exactly the runs of the unbounded ones that are long enough.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_MIN = 8

WINDOW = 20
SHORTEST = 16
CANDIDATE = r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST
#: class of a window: pattern, bits per character that 99.5 % of random windows of SHORTEST and of WINDOW reach
CLASSES = [
    ("hex", r"^[0-9a-fA-F]+$", 2.60, 2.82),
    ("one case", r"^(?:[0-9a-z]+|[0-9A-Z]+)$", 3.07, 3.34),
    ("any", r"^[A-Za-z0-9+/_=-]+$", 3.32, 3.58),
]
#: segments that look random but are no secrets
ALLOW = (
    r"(?i)example|sample|dummy|placeholder|changeme|0123456789|123456789|abcdefgh|qwerty|000000|xxxxxx"
    r"|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
)
#: letters and digits never stand side by side
NAME = r"^(?:[A-Za-z]+|[0-9]+|[+/_=-]+)(?:[+/_=-]+(?:[A-Za-z]+|[0-9]+))*[+/_=-]*$"
PIECE = 64
BLOCK = 256
KINDS = ("assign", "access", "hex", "entropy")
SPAN = "array<struct<start:int,rank:int,end:int>>"


def match_spans(text: Column, matches: Column, pattern: str, kind: str, ok=None) -> Column:
    """Spans ``(start, rank, end)`` of ``matches``, the matches of ``pattern`` in ``text``.

    ``ok(x, i)`` filters by the index of the match.
    """
    rank = KINDS.index(kind)
    empty = F.array().cast(SPAN)

    def block(x: Column, b: Column) -> Column:
        """Spans of one block of matches from the block's start, and its length."""
        first, last = b * BLOCK, F.least((b + 1) * BLOCK, F.size(x["found"])) - 1

        def step(acc: Column, i: Column) -> Column:
            begin = acc["at"] + F.char_length(F.get(x["gaps"], i))
            end = begin + F.char_length(F.get(x["found"], i))
            added = F.concat(acc["spans"], F.array(F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"))))
            if ok is not None:
                added = F.when(ok(x, i), added).otherwise(acc["spans"])
            return F.struct(end.alias("at"), added.alias("spans"))

        return F.aggregate(F.sequence(first, last), F.struct(F.lit(0).alias("at"), empty.alias("spans")), step)

    def shifted(blocks: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
        starts = F.aggregate(
            blocks, start,
            lambda acc, b: F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")),
        )["all"]

        def move(b: Column, o: Column) -> Column:
            return F.transform(
                b["spans"],
                lambda s: F.struct((s["start"] + o).alias("start"), s["rank"].alias("rank"), (s["end"] + o).alias("end")),
            )

        return F.flatten(F.zip_with(blocks, starts, move))

    def place(x: Column) -> Column:
        count = F.floor((F.size(x["found"]) - 1) / BLOCK).cast("int")
        return bind(F.transform(F.sequence(F.lit(0), count), lambda b: block(x, b)), shifted)

    value = F.struct(
        matches.alias("found"),
        F.split(text, pattern, -1).alias("gaps"),
        (F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == "assign" else F.array()).alias("value"),
    )
    return F.when(F.size(matches) > 0, bind(value, place)).otherwise(empty)


def _terms(up: int) -> Column:
    """Change of the sum of ``c * log2(c)`` when a count ``c`` (the index) goes up (1) or down (-1)."""
    term = lambda c: c * math.log2(c) if c > 1 else 0.0
    steps = [term(c + up) - term(c) if c + up >= 0 else 0.0 for c in range(WINDOW + 1)]
    return F.from_json(F.lit(json.dumps(steps)), "array<double>")


def _counts_as_random(window: Column, size: Column, entropy: Column) -> Column:
    """Whether a window mixes letters and digits and reaches the threshold of its class."""
    bar = F.lit(None).cast("double")
    for _, pattern, low, high in reversed(CLASSES):
        bar = F.when(window.rlike(pattern), low + (size - SHORTEST) * ((high - low) / (WINDOW - SHORTEST))).otherwise(bar)
    least = F.lit(min(low for _, _, low, _ in CLASSES))
    mixes = window.rlike("[0-9]") & window.rlike("[A-Za-z]")
    return F.when(entropy >= least, F.coalesce(mixes & (entropy >= bar), F.lit(False))).otherwise(F.lit(False))


def _swept(value: Column, size: Column) -> Column:
    """Whether any window of ``size`` characters of a piece counts as random."""

    def step(acc: Column, i: Column) -> Column:
        # the window before this step: the up to `size` characters before i
        first = F.greatest(i - size, F.lit(1))
        seen = F.substring(value, first, i - first)
        leaving = F.substring(value, i - size, F.lit(1))
        drops = i > size
        rest = F.when(drops, F.substring(value, i - size + 1, size - 1)).otherwise(seen)
        gone = F.length(seen) - F.length(F.replace(seen, leaving))
        less = F.when(drops, F.get(_terms(-1), gone)).otherwise(F.lit(0.0))
        entering = F.substring(value, i, F.lit(1))
        had = F.length(rest) - F.length(F.replace(rest, entering))
        total = acc["total"] + less + F.get(_terms(1), had)
        entropy = F.log2(size.cast("double")) - total / size
        window = F.substring(value, i - size + 1, size)
        hit = F.when(acc["hit"] | (i < size), acc["hit"]).otherwise(_counts_as_random(window, size, entropy))
        return F.struct(total.alias("total"), hit.alias("hit"))

    zero = F.struct(F.lit(0.0).alias("total"), F.lit(False).alias("hit"))
    return F.aggregate(F.sequence(F.lit(1), F.length(value)), zero, step)["hit"]


def _pieces(value: Column) -> Column:
    """A run in pieces of ``PIECE`` characters, each followed by the beginning of the next one."""
    cut = F.regexp_extract_all(value, F.lit("(?s).{1,%d}" % PIECE), F.lit(0))
    lend = lambda parts: F.transform(
        parts, lambda p, i: F.concat(p, F.coalesce(F.substring(F.get(parts, i + 1), F.lit(1), F.lit(WINDOW - 1)), F.lit("")))
    )
    return F.when(F.length(value) <= PIECE, F.array(value)).otherwise(bind(cut, lend))


def without_allowed(value: Column) -> Column:
    """The run with blanks for the segments that the allow-list names (separators become ``/``)."""
    blanked = lambda s: F.when(s.rlike(ALLOW), F.repeat(F.lit(" "), F.length(s))).otherwise(s)
    return F.when(value.rlike(ALLOW) | value.rlike("[/=]"), F.array_join(F.transform(F.split(value, "[/=]", -1), blanked), "/")).otherwise(value)


def is_high_entropy(value: Column) -> Column:
    """Whether a candidate run is reported."""
    mixes = value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~value.rlike(NAME)
    size = F.least(F.length(value), F.lit(WINDOW))
    swept = bind(size, lambda w: F.exists(_pieces(without_allowed(value)), lambda p: _swept(p, w)))
    return F.when(mixes, swept).otherwise(F.lit(False))


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(
                ":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def find_secrets(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, assign, access, hex, entropy)``: one span array per kind and row."""
    body = F.col("body")
    found = df.select(F.col(key).alias("doc_id"), text_of(text).alias("body"))
    for kind, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("entropy", CANDIDATE)):
        group = 0
        found = found.withColumn(f"m_{kind}", F.regexp_extract_all(body, F.lit(pattern), F.lit(group)))
    long_enough = lambda x, i: F.char_length(F.get(x["value"], i)) >= ASSIGN_MIN
    random = lambda x, i: is_high_entropy(F.get(x["found"], i))
    # only texts with a candidate that mixes letters and digits are split
    likely = F.when(
        F.exists("m_entropy", lambda m: m.rlike("[0-9]") & m.rlike("[A-Za-z]")), F.col("m_entropy")
    ).otherwise(F.array().cast("array<string>"))
    spans = found.select(
        "doc_id",
        match_spans(body, F.col("m_assign"), ASSIGN, "assign", long_enough).alias("assign"),
        match_spans(body, F.col("m_access"), ACCESS, "access").alias("access"),
        match_spans(body, F.col("m_hex"), HEX, "hex").alias("hex"),
        match_spans(body, likely, CANDIDATE, "entropy", random).alias("entropy"),
    )
    base = F.concat("assign", "access", "hex")
    clear = bind(
        F.struct(base.alias("base"), F.col("entropy").alias("extra")),
        lambda x: F.filter(
            x["extra"],
            lambda e: ~F.exists(x["base"], lambda b: (b["start"] < e["end"]) & (b["end"] > e["start"])),
        ),
    )
    return spans.withColumn("entropy", clear)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest of the base spans and all spans of every document."""
    spans = find_secrets(documents(spark, sf_dir))
    base = F.concat("assign", "access", "hex")
    return spans.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.concat(base, F.col("entropy"))).alias("spans"),
        F.size("entropy").cast("long").alias("n_entropy"),
    )
