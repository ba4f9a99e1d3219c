"""Operator 8: SimHash near-dedup by tiled exact comparison.

Fingerprints: XXH64 of every word shingle of the whole text; a bit is set when
it is set in more than half of the hashes. Equal fingerprints are reduced to
one before anything is compared.

Tiles: the 64 bits are cut into three bands; a tile holds the fingerprints
with the same three band population counts. Two fingerprints within ``radius``
bits have band counts that differ by at most ``radius`` in total, so a tile
meets only the tiles within that distance, every unordered pair of tiles once;
all other tile pairs are skipped. Oversized tiles are cut by a hash into the
same number of parts everywhere, and each pair of parts is one group, compared
exactly with numpy exclusive-or and bit counts in chunks of bounded size. A
group emits the links of a spanning forest only: as many as it has
fingerprints at most, however dense the group, with no connection lost.

The comparison is exact, hence still quadratic in the number of distinct
fingerprints, with a small constant: for fingerprints that are spread evenly,
about an eighth of all pairs meet.

Defined cases: a null text is empty; a text without words has fingerprint zero
and is linked like any other; fewer words than a shingle form one shingle; a
null ``doc_id`` takes part in linking and carries its component's smallest
non-null id (null when there is none); repeated rows are repeated in the
result; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import connected_components, documents, prepare_python, text_of
from farelake.llm.forest import merge_labels
from farelake.sinks.snapshots import materialize

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
BANDS = ((0, 22), (22, 21), (43, 21))  # first bit, width
TILE_ROWS = 65536
CHUNK_PAIRS = 1 << 21
HASH_CHUNK = 1 << 16


def simhash64(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one text as a signed 64-bit integer."""
    # bytes.lower() and bytes.split() know ASCII letters and white space only
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(shingle_words, len(words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = len(words) - k + 1
    spans = zip(starts[:n].tolist(), ends[k - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, HASH_CHUNK):
        bits = np.unpackbits(hashes[at : at + HASH_CHUNK].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > n, bitorder="little")
    return int(majority.view("<i8")[0])


def fingerprints(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """``(doc_id, fp)``: one signed 64-bit fingerprint per row."""
    prepare_python(df.sparkSession)

    @F.pandas_udf("long")
    def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([simhash64(t, shingle_words) for t in batch], dtype="int64")

    return df.select(F.col(key).alias("doc_id"), fingerprint(text_of(text)).alias("fp"))


def _band_count(band: int) -> Column:
    first, width = BANDS[band]
    mask = F.lit((1 << width) - 1)
    return F.bit_count(F.shiftrightunsigned("fp", first).bitwiseAND(mask))


def _offsets(radius: int) -> list[tuple[int, int, int]]:
    """Differences of band counts within ``radius``; of d and -d only one, without zero."""
    reach = range(-radius, radius + 1)
    return [
        (a, b, c)
        for a in reach
        for b in reach
        for c in reach
        if 0 < abs(a) + abs(b) + abs(c) <= radius and (a, b, c) > (0, 0, 0)
    ]


def forest(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest among all pairs (left, right) within ``radius`` bits.

    An empty ``right`` stands for ``left`` itself. Memory is bounded by
    ``CHUNK_PAIRS`` comparisons at a time; the links of a chunk are merged into
    the labels at once and dropped.
    """
    own = len(right) == 0
    other = left if own else right
    label = np.arange(len(left) if own else len(left) + len(right))
    base = 0 if own else len(left)
    step = max(1, CHUNK_PAIRS // max(1, len(other)))
    for at in range(0, len(left), step):
        near = np.bitwise_count(left[at : at + step, None] ^ other[None, :]) <= radius
        a, b = np.nonzero(near)
        label = merge_labels(label, a + at, b + base)
    linked = np.nonzero(label != np.arange(len(label)))[0]
    values = left if own else np.concatenate([left, right])
    return values[linked], values[label[linked]]


def near_links(distinct: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links ``(a, b)`` that connect exactly the fingerprints reachable within ``radius`` bits.

    ``distinct`` holds each fingerprint ``fp`` once.
    """
    prepare_python(distinct.sparkSession)
    tiles = distinct.select("fp", *[_band_count(i).alias(f"b{i}") for i in range(3)])
    # at most 23 * 22 * 22 tiles, so one row reaches the driver
    largest = tiles.groupBy("b0", "b1", "b2").count().agg(F.max("count").alias("n")).first()["n"]
    parts = -(-(largest or 0) // tile_rows) or 1
    rows = tiles.withColumn("part", F.pmod(F.xxhash64("fp"), F.lit(parts)).cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    cell = ["b0", "b1", "b2", "lp", "rp"]
    home = rows.withColumn("rp", each).select(
        "b0", "b1", "b2", F.col("part").alias("lp"), "rp", F.lit(False).alias("visits"), "fp"
    )
    shifts = F.array(
        *[F.struct(*[F.lit(v).alias(f"d{i}") for i, v in enumerate(d)]) for d in _offsets(radius)]
    )
    away = (
        rows.withColumn("d", F.explode(shifts))
        .withColumn("lp", each)
        .select(
            *[(F.col(f"b{i}") + F.col(f"d.d{i}")).alias(f"b{i}") for i in range(3)],
            "lp",
            F.col("part").alias("rp"),
            F.lit(True).alias("visits"),
            "fp",
        )
    )
    # the other parts of the same tile, each pair of parts once
    beside = (
        rows.withColumn("lp", each)
        .where("lp < part")
        .select("b0", "b1", "b2", "lp", F.col("part").alias("rp"), F.lit(True).alias("visits"), "fp")
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        visits = group["visits"].to_numpy()
        values = group["fp"].to_numpy().view(np.uint64)
        left, right = values[~visits], values[visits]
        found = []
        if len(left) and len(right):
            found.append(forest(left, right, radius))
        if len(left) and group["lp"].iloc[0] == group["rp"].iloc[0]:
            found.append(forest(left, left[:0], radius))
        a = np.concatenate([f[0] for f in found]) if found else values[:0]
        b = np.concatenate([f[1] for f in found]) if found else values[:0]
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return home.union(away).union(beside).groupBy(*cell).applyInPandas(compare, "a long, b long")


def simhash_components(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
) -> DataFrame:
    """``(doc_id, fp, component_id)``: one row per row of ``df``."""
    rows = materialize(fingerprints(df, key, text, shingle_words), "simhash-fp")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    labels = connected_components(near_links(distinct.select("fp"), radius))
    linked = materialize(
        distinct.join(labels.withColumnRenamed("node", "fp"), "fp").select("fp", "first", "label"),
        "simhash-linked",
    )
    smallest = materialize(
        linked.groupBy("label").agg(F.min("first").alias("smallest")), "simhash-smallest"
    )
    of_linked = materialize(
        linked.join(smallest, "label").select("fp", "smallest"), "simhash-of-linked"
    )
    component = materialize(
        distinct.join(of_linked, "fp", "left").select(
            "fp", F.coalesce("smallest", "first").alias("component_id")
        ),
        "simhash-component",
    )
    return rows.join(component, "fp").select("doc_id", "fp", "component_id")


def keep_representatives(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
) -> DataFrame:
    """The rows of ``df`` that stay when one row of each component is kept.

    The row with the smallest id stays; among rows with that id the one with
    the smallest text hash, and of rows equal in both a single one. Rows with
    a null id stay only in components without any other id.
    """
    hashed = df.select(F.col(key).alias("__k"), F.xxhash64(text_of(f"`{text}`")).alias("__h"), text_of(f"`{text}`").alias("__b"))
    groups = simhash_components(
        hashed.select(F.struct("__k", "__h").alias("row"), "__b"), "row", "__b", shingle_words, radius
    )
    # nulls sort first in structs, so ids decide before null ids do
    order = F.struct(F.col("doc_id.__k").isNull().alias("none"), "doc_id.__k", "doc_id.__h")
    kept = materialize(
        groups.groupBy("component_id").agg(F.min(order).alias("o")).select(
            F.col("o.__k").alias("__id"), F.col("o.__h").alias("__tie")
        ),
        "simhash-kept",
    )
    rows = df.withColumn("__h", F.xxhash64(text_of(f"`{text}`")))
    same = F.col(f"`{key}`").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__tie"))
    return rows.join(kept, same, "left_semi").dropDuplicates([key, "__h"]).select(*[F.col(f"`{c}`") for c in df.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash_components(documents(spark, sf_dir))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
