"""Operator 2: line dedup with a fixed-depth log-template tree.

Every non-blank line is tokenized at white space. Variable shapes (numbers,
identifiers with digits, addresses, URLs) become ``<*>``. The tree has a fixed
depth: the token count, then the first ``DEPTH`` tokens; its leaves hold the
lines that agree on both. Two lines of a leaf that agree in at least
``MIN_CONSTANT`` of their places are variants of one template (``<*>`` agrees
with ``<*>``); the places where they differ are its variable fields. A template
is a group of lines that are linked so, directly or over other lines, whatever
values its fields take and however often each value occurs. A line without such
a partner is its own template; with fewer than five tokens no place may differ.

A template that occurs in at least two documents is recurring: its lines stay
in the document with the smallest id and are dropped from all others.

The links are found without comparing all lines of a leaf. Lines that may differ
in ``k`` places agree in a whole segment when the places are cut into ``k + 1``.
Lines that share a segment are a bucket. Every line of a bucket is compared with
one pivot line; all links found so far give each line the label of its group, and
a bucket whose lines have one label is done: no further link can change a group.
In a bucket with at most ``OUTSIDE`` lines outside its largest group (``k + 1``, if
that is more) these are compared with all its lines. All lines of any other bucket
but its pivot are cut again by the places that are still open, until the
open places are too few to tell two lines apart. So no two lines that agree are
left in different groups, a template with any number of variants costs one
comparison per variant, and a bucket of unrelated lines falls apart.

"At least two documents" is ``min(id) < max(id)``, which combines map-side, so
a leaf, bucket or template that holds a third of all lines costs one row per
task. The texts are shuffled once, by document id; the lines travel as hashes.
Only the distinct lines of leaves that hold several of them are read again as
tokens.

Defined cases: a null text stays null; blank lines stay; a line repeated inside
one document only stays; rows with a null id are never dropped from and make
nothing recurring; repeated ids are one document; an empty table gives an empty
result; extra columns are kept.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import bind, clustered, connected_components, documents
from farelake.sinks.snapshots import materialize

DEPTH = 3
MIN_CONSTANT = 0.8
#: lines outside a bucket's largest group that are compared with all its lines
OUTSIDE = 128
WILD = "<*>"
#: tokens that hold a digit, an address or a URL are variable
VARIABLE = r"[0-9]|^\S+@\S+\.\S+$|^(?i:https?://|www\.)"
NOT_BLANK = r"[^\x20\t\x0B\f\r]"
BLANKS = "\t\x0b\f\r"
SPACE = r"[\x20\t\x0B\f\r]+"


def tokens_of(line: Column) -> Column:
    """White-space tokens of a line with variable shapes masked."""
    blanks = [line.contains(b) for b in BLANKS]
    plain = F.when(reduce(or_, blanks), F.translate(line, BLANKS, " " * len(BLANKS))).otherwise(line)
    # a single blank is split without the regex engine
    raw = F.array_remove(F.split(plain, " ", -1), "")
    masked = F.transform(raw, lambda t: F.when(t.rlike(VARIABLE), F.lit(WILD)).otherwise(t))
    # most lines have nothing that the pattern could match
    hints = [line.contains(w) for w in ("ww", "WW", "wW", "Ww")]
    return F.when(line.rlike("[0-9@:]") | reduce(or_, hints), masked).otherwise(raw)


def line_hashes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, line_no, n_tokens, leaf, own)`` of every line that is judged.

    ``leaf`` identifies the tree leaf, ``own`` the masked line in its leaf.
    """
    return (
        df.where(F.col(key).isNotNull())
        .select(F.col(key).alias("doc_id"), F.posexplode(F.split(F.col(text).cast("string"), "\n", -1)).alias("line_no", "line"))
        # a filter on the tokens would be pushed below them and cut every line twice
        .where(F.col("line").rlike(NOT_BLANK))
        .select("doc_id", "line_no", tokens_of(F.col("line")).alias("tokens"))
        .select(
            "doc_id",
            "line_no",
            F.size("tokens").alias("n_tokens"),
            F.xxhash64(F.size("tokens"), F.slice("tokens", 1, DEPTH)).alias("leaf"),
            F.xxhash64("tokens").alias("own"),
        )
    )


def open_lines(df: DataFrame, masked: DataFrame, key: str, text: str) -> DataFrame:
    """The distinct lines of leaves with several of them, with their tokens.

    ``masked`` has one row per distinct line, with the place of one example;
    the example is read from its document.
    """
    leaves = materialize(
        masked.groupBy("leaf")
        .agg(F.min("low").alias("l"), F.max("high").alias("h"), F.count("*").alias("kinds"))
        .where("kinds > 1 and l < h")
        .select("leaf"),
        "template-leaves",
    )
    wanted = masked.join(leaves, "leaf").select(
        F.col("at.doc_id").alias("__id"),
        F.struct(F.col("at.line_no").alias("line_no"), "leaf", "own", "n_tokens", "low", "high").alias("w"),
    )
    by_document = wanted.groupBy("__id").agg(F.collect_set("w").alias("wanted"))
    lines = F.split(F.col(text).cast("string"), "\n", -1)
    # of documents that share an id, the one that holds the example line
    found = (
        df.select(F.col(key).alias("__id"), lines.alias("lines"))
        .join(by_document, "__id")
        .select("lines", F.explode("wanted").alias("w"))
        .select("w.*", F.get("lines", F.col("w.line_no")).alias("line"))
        .where(F.col("line").isNotNull())
        .select("leaf", "own", "n_tokens", "low", "high", tokens_of(F.col("line")).alias("tokens"))
        .where(F.xxhash64("tokens") == F.col("own"))
    )
    return found


def most_fields(n: Column) -> Column:
    """Places in which two lines of ``n`` tokens may differ."""
    return n - F.ceil(n * F.lit(MIN_CONSTANT)).cast("int")


def _cut(rows: DataFrame) -> DataFrame:
    """Each line once per segment of its open places: ``(bucket, leaf, own, cuts, parts)``.

    ``cuts`` are the numbers of the segments it was put into the bucket by; the
    places outside of them (and the leading tokens) are open. ``bucket`` names
    the leaf and the contents of these segments.
    """
    parts = most_fields(F.size("tokens")) + 1

    def bounds(places: Column, j: Column) -> tuple[Column, Column]:
        begin = F.floor(j * F.size(places) / parts).cast("int")
        return begin, F.floor((j + 1) * F.size(places) / parts).cast("int") - begin

    def rest(places: Column, j: Column) -> Column:
        begin, length = bounds(places, j)
        return F.concat(F.slice(places, F.lit(1), begin), F.slice(places, begin + length + 1, F.size(places)))

    def segments(places: Column) -> Column:
        def segment(j: Column) -> Column:
            begin, length = bounds(places, j)
            content = F.transform(F.slice(places, begin + 1, length), lambda p: F.get("tokens", p))
            return F.struct(F.xxhash64("bucket", j, content).alias("bucket"), j.alias("j"))

        # an open place per segment at least, else all lines of the bucket agree anyway
        cut = F.transform(F.sequence(F.lit(0), parts - 1), segment)
        return F.when(F.size(places) >= parts, cut).otherwise(F.array().cast("array<struct<bucket:bigint,j:int>>"))

    places = F.aggregate("cuts", F.sequence(F.lit(DEPTH), F.size("tokens") - 1), rest)
    return rows.select("leaf", "own", "cuts", parts.alias("parts"), F.explode(bind(places, segments)).alias("s")).select(
        "s.bucket", "leaf", "own", F.concat("cuts", F.array("s.j")).alias("cuts"), "parts"
    )


def _groups(edges: DataFrame) -> DataFrame:
    """``(leaf, own, label)`` of the lines with a link; the label is the group's smallest line."""
    node = lambda c: F.struct("leaf", F.col(c).alias("own"))
    found = connected_components(edges.select(node("a").alias("a"), node("b").alias("b")))
    return found.select("node.leaf", "node.own", F.col("label.own").alias("label"))


def _joined(groups: DataFrame) -> DataFrame:
    """``(leaf, a, b)``: each line of ``_groups`` with its group's smallest line."""
    return groups.where("own <> label").select("leaf", F.col("label").alias("a"), F.col("own").alias("b"))


def _labelled(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with the label of each line's group; a line without a link is its own."""
    return rows.join(groups, ["leaf", "own"], "left").withColumn("label", F.coalesce("label", "own"))


def line_links(lines: DataFrame) -> DataFrame:
    """``(leaf, a, b)``: pairs that join all lines of ``open_lines`` that are linked (``a``, ``b`` are ``own``).

    A pair is a link, or a line and its group's smallest line; links between lines
    that others join already may be left out. Buckets hold names of lines only; the
    tokens are read once per pair.
    """
    # shuffled once; every later join brings only names of lines to it
    able = clustered(lines.where(most_fields(F.size("tokens")) > 0).select("leaf", "own", "tokens"), "own", "template-able")
    rows = _cut(able.select(F.col("leaf").alias("bucket"), "leaf", "own", F.array().cast("array<int>").alias("cuts"), "tokens"))
    rows = rows.withColumn("label", F.col("own"))
    found: DataFrame | None = None
    while True:
        sizes = materialize(
            rows.groupBy("bucket")
            .agg(F.min(F.struct("own", "label")).alias("pivot"), F.min("label").alias("least"), F.max("label").alias("most"))
            .where("least <> most")
            .select("bucket", "pivot"),
            "template-buckets",
        )
        shared = materialize(rows.join(sizes, "bucket").where("own <> pivot.own"), "template-shared")
        others = shared.where("label <> pivot.label").select("leaf", F.col("pivot.own").alias("a"), F.col("own").alias("b"))
        near = _judged(others, able).where("near").select("leaf", "a", "b")
        groups = materialize(_groups(found.unionByName(near) if found is not None else near), "template-groups")
        members = materialize(_labelled(shared.drop("pivot", "label"), groups), "template-members")
        # every bucket's largest group, and how many lines are outside of it
        mixed = materialize(
            members.groupBy("bucket", "label").agg(F.count("*").alias("n"), F.min("parts").alias("parts"))
            .groupBy("bucket")
            .agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("size"), F.min("parts").alias("parts"))
            .select("bucket", F.col("main.label").alias("main"), (F.col("size") - F.col("main.n")).alias("outside"), (F.col("size") - F.col("main.n") <= F.greatest("parts", F.lit(OUTSIDE))).alias("few"))
            .where("outside > 0"),
            "template-mixed",
        )
        near = _judged(_pairs(members, mixed.where("few")), able).where("near").select("leaf", "a", "b")
        found = _joined(groups).unionByName(near)
        large = mixed.where("not few").select("bucket")
        if not large.limit(1).count():
            return found
        again = _with_tokens(members.join(large, "bucket"), able, "own", "tokens")
        cut = _cut(materialize(again.select("bucket", "leaf", "own", "cuts", "tokens"), "template-again"))
        groups = materialize(_groups(found), "template-groups")
        found = _joined(groups)
        rows = materialize(_labelled(cut, groups), "template-rows")


def _pairs(members: DataFrame, buckets: DataFrame) -> DataFrame:
    """``(leaf, a, b)``: pairs of a bucket's members that are in different groups.

    One of the two is outside the bucket's largest group; only few lines are.
    """
    outside = members.join(buckets.select("bucket", "main"), "bucket").where("label <> main")
    outside = outside.select("bucket", F.col("own").alias("__own"), F.col("label").alias("__label"))
    pairs = members.select("bucket", "leaf", "own", "label").join(outside, "bucket").where("label <> __label")
    return pairs.select("leaf", F.least("own", "__own").alias("a"), F.greatest("own", "__own").alias("b"))


def _judged(pairs: DataFrame, able: DataFrame) -> DataFrame:
    """``(leaf, a, b, near)``: whether the lines of each distinct pair agree in enough places."""
    equal = F.aggregate(F.zip_with("first", "second", lambda x, y: (x == y).cast("int")), F.lit(0), lambda acc, x: acc + x)
    pairs = materialize(pairs.distinct(), "template-pairs")
    # one pivot may be in very many pairs: its tokens are looked up once, and the last join can be split
    firsts = materialize(_with_tokens(pairs.select("leaf", "a").distinct(), able, "a", "first"), "template-firsts")
    both = _with_tokens(pairs, able, "b", "second").join(firsts, ["leaf", "a"])
    return materialize(
        both.select("leaf", "a", "b", (equal >= F.size("first") - most_fields(F.size("first"))).alias("near")),
        "template-judged",
    )


def _with_tokens(rows: DataFrame, able: DataFrame, name: str, tokens: str) -> DataFrame:
    """``rows`` with the tokens of the line that the column ``name`` names."""
    known = able.select(F.col("own").alias("__own"), F.col("leaf").alias("__leaf"), F.col("tokens").alias(tokens))
    # the leaf is compared after the join, which keeps to the buckets of the line's name
    same = (F.col(name) == F.col("__own")) & (F.col("leaf").bitwiseXOR(F.col("__leaf")) == 0)
    return rows.join(known, same).drop("__own", "__leaf")


def generalised(lines: DataFrame) -> DataFrame:
    """``(leaf, own, low, high, template)`` of the lines of ``open_lines`` that share a template with others.

    A template is named after its smallest line.
    """
    named = _groups(line_links(lines)).withColumnRenamed("label", "template")
    return lines.select("leaf", "own", "low", "high").join(named, ["leaf", "own"])


def recurring_lines(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, line_no)``: lines of recurring templates outside their first document."""
    lines = materialize(line_hashes(df, key, text), "template-lines")
    masked = materialize(
        lines.groupBy("leaf", "own", "n_tokens").agg(
            F.min("doc_id").alias("low"),
            F.max("doc_id").alias("high"),
            F.min(F.struct("doc_id", "line_no")).alias("at"),
        ),
        "template-masked",
    )
    opened = materialize(open_lines(df, masked, key, text).dropDuplicates(["leaf", "own"]), "template-open")
    general = materialize(generalised(opened), "template-general")
    # all other lines are their own template; of these only recurring ones matter
    exact = masked.where("low < high").select("leaf", "own", "low", "high", F.col("own").alias("template"))
    classes = materialize(
        exact.join(general, ["leaf", "own"], "left_anti").unionByName(general), "template-classes"
    )
    recurring = (
        classes.groupBy("leaf", "template")
        .agg(F.min("low").alias("first"), F.max("high").alias("last"))
        .where("first < last")
        .select("leaf", "template", "first")
    )
    dropped = materialize(
        classes.join(materialize(recurring, "template-recurring"), ["leaf", "template"]).select(
            "leaf", "own", "first"
        ),
        "template-dropped",
    )
    return (
        lines.join(dropped, ["leaf", "own"])
        .where(F.col("doc_id") != F.col("first"))
        .select("doc_id", "line_no")
    )


def drop_recurring_lines(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` with recurring lines cut out of ``text``.

    Adds ``__lines`` and ``__dropped`` (counts); other columns stay.
    """
    df = clustered(df, key, "templates")
    gone = materialize(
        recurring_lines(df, key, text)
        .groupBy("doc_id")
        .agg(F.collect_set("line_no").alias("__gone"))
        .select(F.col("doc_id").alias("__id"), "__gone"),
        "template-gone",
    )
    name = F.col(f"`{text}`")
    parts = F.split(name.cast("string"), "\n", -1)
    lines = F.transform(parts, lambda s, i: F.struct(i.alias("i"), s.alias("s")))
    kept = F.filter(lines, lambda x: ~F.array_contains(F.col("__gone"), x["i"]))
    left = F.when(
        F.col("__gone").isNotNull(), F.array_join(F.transform(kept, lambda x: x["s"]), "\n")
    ).otherwise(name)
    joined = df.join(gone, F.col(f"`{key}`") == F.col("__id"), "left")
    return joined.select(
        *[left.alias(c) if c == text else F.col(f"`{c}`") for c in df.columns],
        F.when(name.isNull(), 0).otherwise(F.size(parts)).cast("long").alias("__lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("__dropped"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines before and after, and the digest of what is left."""
    cut = drop_recurring_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select(
        "doc_id",
        F.col("__lines").alias("n_lines"),
        F.col("__dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )
