"""Operator 11: ranked lexical search, term-at-a-time and document-at-a-time.

**Index.** Documents are cut into segments of about ``SEGMENT_BYTES`` of text.
A segment is an inverted list per term: the ordinals of its documents in
ascending order of their ids, and the term's occurrences in each; one more row
holds the document ids and lengths. Texts are read once and never shuffled; the
index does not depend on the queries and can be kept.

**Search.** The items' vocabulary selects lists; their document frequencies are
one ``sum`` per term. Then every segment is searched on its own, for all items of
a block (``BLOCK_TERMS`` item terms, which bounds what a task is given, whatever
the number of items; blocks are worked off one after the other). For an item

* its short lists (``SHORT_SHARE`` of the segment's documents or fewer) are
  added up term at a time into accumulators, which from then on are one
  iterator whose bound is its largest sum;
* this iterator and the long lists are walked together, document at a time in
  windows of ``WINDOW`` ordinals. A window whose bounds add up to no more than
  the score of the twentieth document so far is skipped. In a window, iterators
  whose bounds together cannot lift a document into the result only complete
  the scores of documents that the others bring up, and documents that can no
  longer get there are given up on the way.

Equal scores are ordered by ascending id and ordinals ascend by id, so a later
document must score strictly more: skipping never changes the result. The best
``k`` of each segment (per item) are merged by a window function.

Scores are 64-bit integers: ``w * ((10^9 tf) div (1000 tf + 12 m))`` summed over
the item's terms with repeats, ``m = 75 + ((25 n N) div L)``.

Defined cases: a null or empty text has no terms and counts in neither ``N`` nor
``L``; rows with equal ids are documents of their own (a null id comes last);
items with equal ids are one item with all their terms; an item without a known
term has no rows; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from farelake.llm.common import ascii_lower, documents, prepare_python, text_of
from farelake.sinks.snapshots import materialize
from farelake.sources.tables import read_table

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: the same rule on UTF-8 bytes: separators become blanks, A-Z lower case
_BYTES = bytes(
    c if chr(c).isdigit() or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)

TOP = 20
SEGMENT_BYTES = 16 << 20
BLOCK_TERMS = 200_000
SHORT_SHARE = 1 / 64
WINDOW = 512
SCALE = 1_000_000_000


# -- the index -----------------------------------------------------------------------

class _Numbers(dict):
    """Term → number, in order of first sight."""

    def __missing__(self, term: bytes) -> int:
        number = self[term] = len(self)
        return number


class _Segment:
    def __init__(self):
        self.numbers = _Numbers()
        self.ids: list = []
        self.kinds = array("q")  # distinct terms per document
        self.lengths = array("q")
        self.terms = array("i")
        self.tfs = array("i")
        self.bytes = 0

    def add(self, key, text: bytes) -> None:
        words = text.translate(_BYTES).split()
        counts = Counter(words)
        self.ids.append(key)
        self.kinds.append(len(counts))
        self.lengths.append(len(words))
        self.terms.extend(map(self.numbers.__getitem__, counts))
        self.tfs.extend(counts.values())
        self.bytes += len(text)

    def batch(self, number: int, schema: pa.Schema) -> pa.RecordBatch:
        """One row per term, and one (term null) for the documents."""
        rows = len(self.ids)
        order = sorted(range(rows), key=lambda i: (self.ids[i] is None, self.ids[i] if self.ids[i] is not None else 0))
        place = np.empty(rows, np.int32)
        place[order] = np.arange(rows, dtype=np.int32)
        lengths = np.frombuffer(self.lengths, np.int64)[order] if rows else np.empty(0, np.int64)
        terms, tfs = (np.frombuffer(a, np.int32) if len(a) else np.empty(0, np.int32) for a in (self.terms, self.tfs))
        docs = np.repeat(place, np.frombuffer(self.kinds, np.int64)) if rows else np.empty(0, np.int32)
        sort = np.lexsort((docs, terms))
        docs, tfs, terms = docs[sort], tfs[sort], terms[sort]
        kinds = len(self.numbers)
        ends = np.searchsorted(terms, np.arange(kinds + 1)).astype(np.int32)
        lists = lambda v, t: pa.ListArray.from_arrays(
            pa.array(np.concatenate([ends, [ends[-1]]]).astype(np.int32)), pa.array(v, t)
        )
        none = [None] * kinds
        id_type = schema.field("ids").type
        columns = [
            pa.array([number] * (kinds + 1), pa.int64()),
            pa.array([t.decode() for t in self.numbers] + [None], pa.string()),
            pa.array(np.append(np.diff(ends), int((lengths > 0).sum())), pa.int64()),
            pa.array(np.append(np.zeros(kinds, np.int64), lengths.sum()), pa.int64()),
            lists(docs, pa.int32()),
            lists(tfs, pa.int32()),
            pa.array(none + [[self.ids[i] for i in order]], id_type),
            pa.array(none + [lengths.tolist()], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=schema)


def _segments(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, done, segment = TaskContext.get().partitionId(), 0, _Segment()
    for batch in batches:
        keys, texts = batch.column(0), batch.column(1).cast(pa.binary())
        for key, text in zip(keys, texts):
            segment.add(key.as_py(), text.as_py() or b"")
            if segment.bytes >= SEGMENT_BYTES:
                yield segment.batch((task << 32) + done, schema)
                done, segment = done + 1, _Segment()
    if segment.ids:
        yield segment.batch((task << 32) + done, schema)


def build_index(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The written index: ``(segment, term, df, total, docs, tfs, ids, lengths)``."""
    prepare_python(df.sparkSession)
    source = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    id_type = source.schema["id"].dataType
    schema = pa.schema([
        ("segment", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("total", pa.int64()),
        ("docs", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32())),
        ("ids", pa.list_(to_arrow_type(id_type))), ("lengths", pa.list_(pa.int64())),
    ])
    ddl = (
        "segment bigint, term string, df bigint, total bigint, docs array<int>, tfs array<int>, "
        f"ids array<{id_type.simpleString()}>, lengths array<bigint>"
    )
    return materialize(source.mapInArrow(partial(_segments, schema), ddl), "search-index")


# -- one segment ---------------------------------------------------------------------

class Postings:
    """One inverted list: documents, contributions before the weight, bounds per window."""

    def __init__(self, docs: np.ndarray, gains: np.ndarray, edges: np.ndarray):
        self.docs, self.gains = docs, gains
        self.cuts = np.searchsorted(docs, edges)
        self.bounds = np.zeros(len(edges) - 1, np.int64)
        filled = np.flatnonzero(np.diff(self.cuts))
        if len(filled):
            self.bounds[filled] = np.maximum.reduceat(gains, self.cuts[filled])


def accumulate(lists: list[tuple[int, Postings]], edges: np.ndarray) -> Postings:
    """Term at a time: the weighted sum of short lists as one list of weight 1."""
    docs, at = np.unique(np.concatenate([p.docs for _, p in lists]), return_inverse=True)
    sums = np.zeros(len(docs), np.int64)
    np.add.at(sums, at, np.concatenate([w * p.gains for w, p in lists]))
    return Postings(docs, sums, edges)


def top_documents(lists: list[tuple[int, Postings]], rows: int, edges: np.ndarray, k: int = TOP) -> tuple[np.ndarray, np.ndarray]:
    """Ordinals and scores of the ``k`` best documents, by score, then ordinal."""
    short = [(w, p) for w, p in lists if len(p.docs) <= rows * SHORT_SHARE]
    walked = [(w, p) for w, p in lists if len(p.docs) > rows * SHORT_SHARE]
    if short:
        walked.append((1, accumulate(short, edges)))
    best, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    bar = 0
    if not walked:
        return best, scores
    bounds = np.array([w * p.bounds for w, p in walked])
    for window in np.flatnonzero(bounds.sum(axis=0) > 0):
        here = bounds[:, window]
        if here.sum() <= bar:
            continue
        order = np.argsort(here, kind="stable")
        optional = int(np.searchsorted(np.cumsum(here[order]), bar, side="right"))
        base, end = edges[window], edges[window + 1]
        sums = np.zeros(end - base, np.int64)
        for i in order[optional:]:
            w, p = walked[i]
            a, b = p.cuts[window], p.cuts[window + 1]
            sums[p.docs[a:b] - base] += w * p.gains[a:b]
        found = np.flatnonzero(sums)
        sums = sums[found]
        open_ = int(here[order[:optional]].sum())
        for i in order[:optional][::-1]:
            alive = sums + open_ > bar
            found, sums = found[alive], sums[alive]
            if not len(found):
                break
            w, p = walked[i]
            a, b = p.cuts[window], p.cuts[window + 1]
            if a < b:
                at = np.minimum(np.searchsorted(p.docs[a:b], found + base), b - a - 1) + a
                sums = sums + np.where(p.docs[at] == found + base, w * p.gains[at], 0)
            open_ -= int(here[i])
        alive = sums > bar
        if alive.any():
            best = np.concatenate([best, found[alive] + base])
            scores = np.concatenate([scores, sums[alive]])
            keep = np.lexsort((best, -scores))[:k]
            best, scores = best[keep], scores[keep]
            bar = int(scores[-1]) if len(scores) == k else 0
    return best, scores


def _search(items: list, n_docs: int, n_terms: int, k: int, schema: pa.Schema, table: pa.Table) -> pa.Table:
    """The best documents of one segment for every item ``(id, {term: weight})``."""
    terms = table["term"].to_pylist()
    about = terms.index(None)
    lengths = np.asarray(table["lengths"][about].values, np.int64)
    ids = table["ids"][about].values
    rows = len(lengths)
    slots = 75 + (25 * lengths * n_docs) // n_terms
    edges = np.append(np.arange(0, rows, WINDOW), rows)
    postings = {}
    for i, term in enumerate(terms):
        if term is None:
            continue
        docs = np.asarray(table["docs"][i].values, np.int64)
        tfs = np.asarray(table["tfs"][i].values, np.int64)
        postings[term] = Postings(docs, (SCALE * tfs) // (1000 * tfs + 12 * slots[docs]), edges)
    found_items, found_docs, found_scores = [], [], []
    for item, weights in items:
        lists = [(w, postings[t]) for t, w in weights.items() if t in postings]
        best, scores = top_documents(lists, rows, edges, k)
        found_items += [item] * len(best)
        found_docs.append(best)
        found_scores.append(scores)
    every = np.concatenate(found_docs) if found_docs else np.empty(0, np.int64)
    columns = [
        pa.array(found_items, schema.field("item_id").type),
        ids.take(pa.array(every, pa.int64())),
        pa.array(np.concatenate(found_scores) if found_scores else every, pa.int64()),
    ]
    return pa.Table.from_arrays(columns, schema=schema)


def _searcher(items: list, n_docs: int, n_terms: int, k: int, schema: pa.Schema):
    def run(table: pa.Table) -> pa.Table:
        return _search(items, n_docs, n_terms, k, schema, table)

    return run


# -- the search ------------------------------------------------------------------------

def item_terms(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """``(item_id, term, times)`` of the items' terms."""
    words = F.array_remove(F.split(ascii_lower(text_of(f"`{text}`")), SEPARATORS, -1), "")
    return (
        items.select(F.col(f"`{key}`").alias("item_id"), F.explode(words).alias("term"))
        .groupBy("item_id", "term")
        .agg(F.count("*").alias("times"))
    )


def search(index: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text", k: int = TOP) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of every item.

    The driver holds one block of item terms at a time, and two corpus counts.
    """
    spark = index.sparkSession
    prepare_python(spark)
    wanted = materialize(item_terms(items, key, text), "search-items")
    counts = index.where("term is null").agg(F.sum("df").alias("docs"), F.sum("total").alias("terms")).first()
    n_docs, n_terms = counts["docs"] or 0, counts["terms"] or 0
    item_type, id_type = wanted.schema["item_id"].dataType, index.schema["ids"].dataType.elementType
    ddl = f"item_id {item_type.simpleString()}, doc_id {id_type.simpleString()}, score bigint"
    total = wanted.count()
    if not n_terms or not total:
        return spark.createDataFrame([], ddl).select("item_id", F.lit(1).alias("rank"), "doc_id", "score")
    schema = pa.schema([("item_id", to_arrow_type(item_type)), ("doc_id", to_arrow_type(id_type)), ("score", pa.int64())])
    vocabulary = wanted.select("term").distinct()
    lists = materialize(
        index.where("term is not null").join(vocabulary, "term", "left_semi").unionByName(index.where("term is null")),
        "search-lists",
    )
    frequencies = lists.where("term is not null").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1))).cast("long")
    weighted = materialize(
        wanted.join(frequencies, "term").select("item_id", "term", (weight * F.col("times")).alias("weight")).where("weight > 0"),
        "search-weights",
    )
    blocks = -(-total // BLOCK_TERMS)
    parts = []
    for b in range(blocks):
        mine = weighted if blocks == 1 else weighted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        grouped: dict = {}
        for r in mine.collect():
            grouped.setdefault(r["item_id"], {})[r["term"]] = r["weight"]
        held = lists if blocks == 1 else lists.where("term is not null").join(
            mine.select("term").distinct(), "term", "left_semi"
        ).unionByName(lists.where("term is null"))
        run = _searcher(list(grouped.items()), n_docs, n_terms, k, schema)
        parts.append(materialize(held.groupBy("segment").applyInArrow(run, ddl), "search-block"))
    found = reduce(DataFrame.unionByName, parts)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return search(build_index(documents(spark, sf_dir)), read_table(spark, sf_dir, "benchmark"))
