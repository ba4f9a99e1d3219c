"""Operator 1: document fingerprints by SpotSigs.

An anchor is a common word (a fixed list per language); its signature is the
anchor with the chain of the next ``CHAIN`` content words, i.e. words that are
no anchors. The start of the text is an anchor too, so that every text with a
content word has a signature. Where the list leaves a stretch of more than
``STRETCH`` content words without an anchor, or finds none in the whole text
(lists, tables, other languages), the content word with the smallest hash of
every ``CHAIN + 1`` consecutive ones is an anchor, so that each word of the
stretch lies in a signature. The choice depends on the words around only, so an
edit changes the signatures beside it and no others. Scripts without blanks
count each character as a word. A fingerprint is the sorted set of the 24-bit
hashes of the signatures, four base64 characters each; the empty set is the
empty string. Likeness is the Jaccard coefficient of two sets.

``near_duplicates`` groups a corpus exactly: sets are partitioned by their
length so that similar sets lie in the same or the next partition, and meet by
the first of their signatures in a common order, the fewest that similar sets
must share. Every group is compared in blocks of bounded size.

``edited_and_next`` compares every document with an edited copy and with the
next document. The order of all documents is cut into ranges by a narrow pass
over the keys; each range receives the first document of the next one as well,
so one shuffle of the texts is all that is needed and each range is read as a
sorted stream.

Defined cases: a null text is empty; a null key comes first in the order;
equal keys are ordered by the hash of the text; a single document is its own
next one; two empty sets have likeness 1, an empty and a non-empty set 0; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import connected_components, documents, prepare_python, text_of
from farelake.llm.forest import merge_labels
from farelake.sinks.snapshots import materialize

CHAIN = 2
HASH_BITS = 24
#: content words that may follow each other without a listed anchor
STRETCH = 6
THRESHOLD = 0.8
#: sets per block of a group, and signatures per column chunk of a comparison
BLOCK_SETS, CHUNK_COLUMNS = 256, 1 << 14
#: ranges of the document order per shuffle partition, and at most
RANGES_PER_PARTITION, MAX_RANGES = 4, 4096

#: common words: English, French, German, Spanish
ANCHORS = frozenset(
    """
    a an and are as at be by for from in is it of on or that the this to was with
    au avec dans de des du elle en est et la le les par pas pour que qui sur un une
    das dem den der des die ein eine für im in ist mit nicht sich und von zu
    como con de del el en es la las lo los no para por que se un una y
    """.split()
)
#: kana, Han, Thai, Lao, Burmese, Khmer: written without blanks
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORD = re.compile(r"\w+")
SPACED = re.compile(rf"[{UNSPACED}]|[^{UNSPACED}]+")
HAS_UNSPACED = re.compile(f"[{UNSPACED}]")


def words_of(text: str) -> list[str]:
    """Lower-cased words; characters of scripts without blanks one by one."""
    words = WORD.findall(text.lower())
    if text.isascii() or not HAS_UNSPACED.search(text):
        return words
    return [part for word in words for part in SPACED.findall(word)]


def own_anchors(content: list[str], begin: int, end: int, window: int) -> list[int]:
    """Places of the smallest hash in every ``window`` consecutive words of ``content[begin:end]``."""
    keys = [(xxhash.xxh32_intdigest(w, 1), -at) for at, w in enumerate(content[begin:end], begin)]
    window = min(window, len(keys))
    return sorted({-min(keys[k : k + window])[1] for k in range(len(keys) - window + 1)})


def signatures(text: str, anchors: frozenset = ANCHORS, chain: int = CHAIN) -> np.ndarray:
    """Sorted distinct signature hashes of a text (unsigned, ``HASH_BITS`` bits)."""
    content: list[str] = []
    spots: list[tuple[str, int]] = [("", 0)]
    add, spot = content.append, spots.append
    for word in words_of(text):
        if word in anchors:
            spot((word, len(content)))
        else:
            add(word)
    known = len(content)
    shift = 32 - HASH_BITS
    digest = xxhash.xxh32_intdigest
    found = {
        digest(" ".join([anchor, *content[at : at + chain]])) >> shift
        for anchor, at in spots
        if at < known
    }
    least = STRETCH if len(spots) > 1 else chain
    for (_, begin), end in zip(spots, [*(at for _, at in spots[1:]), known], strict=True):
        if end - begin > least:
            for at in own_anchors(content, begin, end, chain + 1):
                found.add(digest(" ".join(content[at : at + chain + 1])) >> shift)
    return np.array(sorted(found), dtype="<u4")


def as_text(found: np.ndarray) -> str:
    """Fingerprint string of a signature set."""
    return base64.b64encode(found.view(np.uint8).reshape(-1, 4)[:, :3].tobytes()).decode("ascii")


def as_set(fingerprint: str) -> np.ndarray:
    """Signature set of a fingerprint string."""
    raw = np.frombuffer(base64.b64decode(fingerprint), dtype=np.uint8).reshape(-1, 3)
    return np.pad(raw, ((0, 0), (0, 1))).copy().view("<u4").ravel()


def pruned_jaccard(a: np.ndarray, b: np.ndarray, floor: float = 0.0) -> float:
    """Jaccard coefficient of two sorted sets; 0 when it is proven to be below ``floor``.

    The lengths alone bound the coefficient by their ratio; pairs that cannot
    reach ``floor`` are not intersected.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < floor * max(len(a), len(b)):
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    likeness = common / (len(a) + len(b) - common)
    return likeness if likeness >= floor else 0.0


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fingerprint)`` of every row."""
    prepare_python(df.sparkSession)

    @F.pandas_udf("string")
    def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([as_text(signatures(t)) for t in batch], dtype="object")

    return df.select(F.col(key).alias("doc_id"), fingerprint(text_of(text)).alias("fingerprint"))


def _order_key(key: str, text: str):
    return F.struct(F.col(key).alias("id"), F.xxhash64(text_of(text)).alias("tie"))


def range_starts(df: DataFrame, key: str, text: str) -> list[tuple]:
    """Smallest order key of each range, ascending; at most ``MAX_RANGES`` of them.

    The keys are range-partitioned without their texts; the driver receives
    one key per range.
    """
    spark = df.sparkSession
    ranges = min(MAX_RANGES, RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = df.select(_order_key(key, text).alias("k")).select("k.id", "k.tie")
    low = (
        keys.repartitionByRange(ranges, "id", "tie")
        .groupBy(F.spark_partition_id().alias("range"))
        .agg(F.min(F.struct("id", "tie")).alias("k"))
        .select("k.id", "k.tie")
        .distinct()
    )
    return sorted(((r["id"], r["tie"]) for r in low.collect()), key=lambda k: (k[0] is not None, k[0] or 0, k[1]))


def edited_and_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its edited copy's and next document's likeness."""
    prepare_python(df.sparkSession)
    id_type = df.schema[key].dataType
    schema = (
        f"doc_id {id_type.simpleString()}, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double"
    )
    starts = range_starts(df, key, text)
    if not starts:
        return df.sparkSession.createDataFrame([], schema)
    literal = F.array(
        *[F.struct(F.lit(i).cast(id_type).alias("id"), F.lit(t).alias("tie")) for i, t in starts]
    )
    rows = df.select(_order_key(key, text).alias("k"), text_of(text).alias("body"))
    # a key belongs to the last range that starts at or before it
    placed = rows.withColumn(
        "range", F.size(F.filter(literal, lambda s: s <= F.col("k"))) - 1
    ).withColumn("first", F.get(literal, F.col("range")) == F.col("k"))
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("lent"))
    lent = F.struct(
        F.pmod(F.col("range") - 1, F.lit(len(starts))).alias("range"), F.lit(True).alias("lent")
    )
    streams = (
        placed.withColumn("to", F.explode(F.when(F.col("first"), F.array(own, lent)).otherwise(F.array(own))))
        .select("to.range", "to.lent", "k.id", "k.tie", "body")
        .repartition("range")
        .sortWithinPartitions("range", "lent", "id", "tie")
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # (range, id, text, signatures) of the last row seen
        for batch in batches:
            out = []
            for part, is_lent, doc, body in zip(
                batch["range"], batch["lent"], batch["id"], batch["body"], strict=True
            ):
                found = None
                if held is not None and held[0] == part:
                    found = signatures(body)
                    out.append(_row(held, body, found))
                if is_lent:
                    held = None
                else:
                    held = (part, doc, body, signatures(body) if found is None else found)
            yield pd.DataFrame(out, columns=COLUMNS).astype({"doc_id": "object"})

    return streams.mapInPandas(compare, schema)


COLUMNS = [
    "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
]


def edited(text: str, donor: str) -> str:
    """``text`` with its last quarter replaced by as many characters of ``donor``."""
    cut = len(text) // 4
    return text[: len(text) - cut] + donor[:cut]


def _row(held: tuple, next_text: str, next_found: np.ndarray) -> tuple:
    _, doc, text, found = held
    changed = edited(text, next_text)
    changed_found = signatures(changed)
    return (
        None if pd.isna(doc) else doc,
        len(text),
        hashlib.sha256(changed.encode("utf-8")).hexdigest(),
        as_text(found),
        as_text(changed_found),
        pruned_jaccard(found, changed_found),
        pruned_jaccard(found, next_found),
    )


def length_partition(size, threshold: float):
    """Partition of a set length (column): sets with likeness ≥ ``threshold`` are at most one apart."""
    return F.floor(F.log(size.cast("double")) / F.lit(-np.log(threshold)) + F.lit(1e-9)).cast("int")


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sorted sets, in column chunks of bounded size."""
    counts = np.zeros((len(left), len(right)), dtype=np.float32)
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    for at in range(0, len(shared), CHUNK_COLUMNS):
        columns = shared[at : at + CHUNK_COLUMNS]
        sides = []
        for sets in (left, right):
            hits = np.zeros((len(sets), len(columns)), dtype=np.float32)
            for row, found in enumerate(sets):
                hits[row, np.isin(columns, found, assume_unique=True)] = 1.0
            sides.append(hits)
        counts += sides[0] @ sides[1].T
    return counts


def near_links(sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links ``(a, b)`` that connect exactly the sets reachable by likeness ≥ ``threshold``.

    ``sets`` has ``rep`` (unique, not null) and a non-empty ``fingerprint``. In
    the common order of the signature hashes, sets that are similar enough
    share one of their first ``size - ceil(threshold * size) + 1`` signatures.
    Sets meet by (length partition, such a signature), at home and in the next
    longer partition. Signatures that no other set has are dropped first; a
    large group is cut into blocks and each pair of blocks is compared on its
    own, which emits a spanning forest of its links, never its pairs.
    """
    prepare_python(sets.sparkSession)

    @F.pandas_udf("array<long>")
    def prefix(prints: pd.Series) -> pd.Series:
        def first(p: str) -> np.ndarray:
            found = as_set(p)
            keep = len(found) - int(np.ceil(threshold * len(found) - 1e-9)) + 1
            return found[:keep].astype(np.int64)

        return pd.Series([first(p) for p in prints])

    size = (F.length("fingerprint") / 4).cast("int")
    home = sets.select(
        "rep", length_partition(size, threshold).alias("part"), F.explode(prefix("fingerprint")).alias("sig")
    ).withColumn("visits", F.lit(False))
    away = home.withColumns({"part": F.col("part") + 1, "visits": F.lit(True)})
    rows = materialize(home.union(away), "spots-prefix")
    group = ["part", "sig"]
    met = (
        rows.groupBy(*group)
        .agg(F.count("*").alias("n"), F.count_if(~F.col("visits")).alias("homes"))
        .where("n > 1 and homes > 0")
        .select(*group, F.ceil(F.col("n") / F.lit(BLOCK_SETS)).cast("int").alias("blocks"))
    )
    placed = (
        rows.join(materialize(met, "spots-met"), group)
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .join(sets, "rep")
    )
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    wide = [*group, "rep", "fingerprint", "left_block", "right_block", "is_left"]
    left = placed.where("not visits").withColumns(
        {"left_block": F.col("block"), "right_block": every, "is_left": F.lit(True)}
    )
    right = placed.withColumns(
        {"left_block": every, "right_block": F.col("block"), "is_left": F.lit(False)}
    )

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        here, there = rows[rows["is_left"]], rows[~rows["is_left"]]
        if here.empty or there.empty:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        a, b = ([as_set(p) for p in side["fingerprint"]] for side in (here, there))
        la, lb = np.array([len(x) for x in a])[:, None], np.array([len(x) for x in b])[None, :]
        common = common_counts(a, b)
        near = common >= threshold * (la + lb - common) - 1e-6
        ids = np.unique(np.concatenate([here["rep"], there["rep"]]))
        i, j = np.nonzero(near & (here["rep"].to_numpy()[:, None] != there["rep"].to_numpy()[None, :]))
        label = merge_labels(
            np.arange(len(ids)), np.searchsorted(ids, here["rep"].to_numpy()[i]), np.searchsorted(ids, there["rep"].to_numpy()[j])
        )
        linked = np.nonzero(label != np.arange(len(ids)))[0]
        return pd.DataFrame({"a": ids[linked], "b": ids[label[linked]]})

    return (
        left.select(*wide)
        .union(right.select(*wide))
        .groupBy(*group, "left_block", "right_block")
        .applyInPandas(compare, "a long, b long")
    )


def near_duplicates(
    df: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``: one row per row of ``df``.

    Documents with equal signature sets are one class, named by its smallest
    id; classes with likeness ≥ ``threshold`` are linked. A document without
    signatures or with a null id is its own component.
    """
    rows = materialize(fingerprints(df, key, text), "spots-prints")
    known = rows.where(F.col("doc_id").isNotNull() & (F.col("fingerprint") != ""))
    classes = materialize(
        known.groupBy("fingerprint").agg(F.min("doc_id").alias("rep")), "spots-classes"
    )
    labels = connected_components(near_links(classes, threshold))
    named = materialize(
        classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
            "fingerprint", F.coalesce("label", "rep").alias("component")
        ),
        "spots-components",
    )
    joined = rows.join(named, "fingerprint", "left")
    own = F.col("doc_id").isNull() | F.col("component").isNull()
    return joined.select(
        "doc_id", "fingerprint", F.when(own, F.col("doc_id")).otherwise(F.col("component")).alias("component_id")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and likenesses of every document and its edited text."""
    return edited_and_next(documents(spark, sf_dir))
