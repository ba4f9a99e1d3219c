"""Operator 7: mixing sources to target weights.

Each source's documents form one stream of words in a fixed order, packed into
blocks of ``BLOCK_WORDS`` words; the last block may be shorter. The mix has one
slot per block to draw, dealt to output shards. Every shard draws a multinomial
over the sources; the draws are then moved, a few slots per shard, so that each
source has exactly its quota of slots. The k-th slot of a source is mapped to a
block index by a keyed pseudorandom permutation of the source's block indexes
(one permutation per pass, so no block is drawn twice in a pass), and slots and
blocks are joined by (source, index).

Targets: sources in the order of their name's code points, null last, have the
weights 3, 1, 2 in turn and share ``SHARE`` of all words; a target above
``MAX_REPEAT`` times its source's size is cut to that and the excess is shared
by weight among the others until none is above.

Positions in a stream come from two levels: hash buckets per source, whose
sizes are summed by a window over a small table, and a window inside each
bucket, so a source with a third of all rows is spread over ``BUCKETS`` tasks.
The driver holds one row per source and the shards x sources table of counts;
sources are a configured mixture, their number must fit the driver.

Defined cases: a null text or one without words has size 0 and is never taken;
a null source is a source of its own, last in the order; repeated rows are
separate documents; an empty table gives an empty result; extra columns are
ignored by ``take_words`` and kept by ``mix_documents``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelake.llm.common import documents, prepare_python, text_of
from farelake.session import ship_package
from farelake.sinks.snapshots import materialize

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_REPEAT = 2.0
BLOCK_WORDS = 64
BUCKETS = 512
SHARDS = 64
SEED = 20
ROUNDS = 6
#: runs of anything but ASCII white space
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_count(text: Column) -> Column:
    """Number of words of a text column."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def targets(sizes: list[int], weights=WEIGHTS, share: float = SHARE, cap: float = MAX_REPEAT) -> list[float]:
    """Words to take from each source: shares by weight, none above ``cap`` times its size."""
    n = len(sizes)
    left = share * sum(sizes)
    weight = [weights[i % len(weights)] for i in range(n)]
    goal = [0.0] * n
    free = [i for i in range(n) if sizes[i] > 0]
    for i in range(n):
        if sizes[i] == 0:
            goal[i] = 0.0
    while free:
        total = sum(weight[i] for i in free)
        over = [i for i in free if left * weight[i] / total > cap * sizes[i]]
        if not over:
            for i in free:
                goal[i] = left * weight[i] / total
            break
        for i in over:
            goal[i] = cap * sizes[i]
        left -= sum(goal[i] for i in over)
        free = [i for i in free if i not in over]
    return goal


def quotas(sizes: list[int], goals: list[float], block: int = BLOCK_WORDS) -> list[int]:
    """Slots per source whose words come nearest to the target."""
    found = []
    for size, goal in zip(sizes, goals, strict=True):
        blocks = -(-size // block)
        if not blocks:
            found.append(0)
            continue
        passes = min(int(goal // size), int(MAX_REPEAT))
        extra = round((goal - passes * size) / (size / blocks))
        found.append(min(passes * blocks + extra, int(MAX_REPEAT) * blocks))
    return found


def shard_counts(quota: list[int], shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """Slots per output shard (row) and source (column); columns sum to ``quota``.

    Multinomial draws per shard; sources drawn too often give slots, in a
    fixed pseudorandom order of shards, to sources drawn too rarely.
    """
    total = sum(quota)
    counts = np.zeros((shards, len(quota)), dtype=np.int64)
    if not total:
        return counts
    rng = np.random.Generator(np.random.PCG64(seed))
    slots = np.full(shards, total // shards)
    slots[: total % shards] += 1
    chance = np.array(quota, dtype=np.float64) / total
    for s in range(shards):
        counts[s] = rng.multinomial(slots[s], chance)
    excess = counts.sum(axis=0) - np.array(quota)
    for give in np.nonzero(excess > 0)[0]:
        for take in np.nonzero(excess < 0)[0]:
            move = int(min(excess[give], -excess[take]))
            if move <= 0:
                continue
            # spread the moves over the shards in proportion to what they hold
            have = counts[:, give]
            part = np.floor(move * have / max(1, have.sum())).astype(np.int64)
            for s in rng.permutation(shards):
                if part.sum() == move:
                    break
                if part[s] < have[s]:
                    add = min(have[s] - part[s], move - part.sum())
                    part[s] += min(add, 1 + (move - part.sum()) // shards)
            while part.sum() < move:
                s = int(np.argmax(have - part))
                part[s] += 1
            counts[:, give] -= part
            counts[:, take] += part
            excess[give] -= move
            excess[take] += move
    return counts


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Pseudorandom permutation of ``0 … size-1`` per key, applied to ``index``.

    A balanced network of keyed rounds on the next even number of bits; values
    that fall outside the range are sent through it again until they are inside.
    """
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    key = key.astype(np.uint64)
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in range(ROUNDS):
            salt = np.uint64((r + 1) * 0xBF58476D1CE4E5B9 % (1 << 64))
            mixed = (right ^ k) * np.uint64(0x9E3779B97F4A7C15) + salt
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0x94D049BB133111EB)
            mixed ^= mixed >> np.uint64(32)
            left, right = right, (left ^ mixed) & m
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def source_table(sized: DataFrame) -> list[dict]:
    """Sources in order, with size, weight order, target, blocks and quota."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    rows = sorted(rows, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in rows]
    goals = targets(sizes)
    return [
        {"rank": i, "source": r["source"], "source_size": s, "target": g, "blocks": -(-s // BLOCK_WORDS), "quota": q}
        for i, (r, s, g, q) in enumerate(zip(rows, sizes, goals, quotas(sizes, goals), strict=True))
    ]


SOURCE_SCHEMA = "rank int, source string, source_size long, target double, blocks long, quota long"


def stream_positions(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Add ``rank`` and ``start``, the position of a document in its source's stream."""
    order = ["tie", "doc_id", "size"]
    rows = materialize(
        sized.join(
            F.broadcast(sources.select("rank", F.col("source").alias("s"), "source_size", "target")),
            F.col("source").eqNullSafe(F.col("s")),
        )
        .drop("s")
        .withColumn("bucket", F.pmod(F.col("tie"), F.lit(BUCKETS)).cast("int")),
        "mixing-rows",
    )
    before = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        rows.groupBy("rank", "bucket")
        .agg(F.sum("size").alias("n"))
        .select("rank", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")),
        "mixing-offsets",
    )
    inside = (
        Window.partitionBy("rank", "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, ["rank", "bucket"])
        .withColumn("start", F.col("offset") + F.col("ahead"))
        .drop("ahead", "offset", "bucket")
    )


def drawn_blocks(spark: SparkSession, sources: list[dict], counts: np.ndarray) -> DataFrame:
    """``(rank, block, shard)``: one row per slot of the mix."""
    ship_package(spark)
    shards = len(counts)
    first = np.zeros_like(counts)
    first[1:] = np.cumsum(counts, axis=0)[:-1]
    tasks = [
        (shard, s["rank"], int(first[shard, s["rank"]]), int(counts[shard, s["rank"]]), int(s["blocks"]),
         xxhash.xxh64_intdigest(repr(s["source"]).encode(), SEED) >> 1)
        for shard in range(shards) for s in sources if counts[shard, s["rank"]]
    ]
    plan = spark.createDataFrame(tasks, "shard int, rank int, first long, slots long, blocks long, key long")
    # a shard's slots of one source are cut into pieces, so no row grows with the mix; the rows are
    # few and small, so their number of partitions is given, else they would be merged into one task
    piece = 1 << 16
    pieces = plan.withColumn(
        "at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(piece).cast("long")))
    ).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard", "rank", "at")

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                slot = np.arange(row.at, min(row.at + piece, row.slots), dtype=np.int64) + row.first
                turn, index = slot // row.blocks, slot % row.blocks
                key = np.uint64(row.key) + turn.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)
                block = permuted(index, np.full(len(slot), row.blocks), key)
                yield pd.DataFrame(
                    {"rank": np.int32(row.rank), "block": block, "shard": np.int32(row.shard)}
                )

    return pieces.mapInPandas(draw, "rank int, block long, shard int")


def take_words(sized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plan the mix of documents ``(doc_id, source, size, tie)``.

    Returns the documents with ``rank``, ``start``, ``source_size`` and
    ``target``, and the pieces ``(rank, start, from_word, to_word, draws, shards)``:
    the words of a document in one block, with how often the mix takes that block
    and the output shards that drew it (bit ``s`` for shard ``s``).
    """
    spark = sized.sparkSession
    sized = materialize(sized, "mixing-sized")
    sources = source_table(sized)
    table = spark.createDataFrame([tuple(s.values()) for s in sources], SOURCE_SCHEMA)
    placed = materialize(stream_positions(sized, table), "mixing-placed")
    draws = drawn_blocks(spark, sources, shard_counts([s["quota"] for s in sources]))
    # a block is drawn once per pass at most; the shards it goes to are bits of one number
    shards = F.bit_or(F.expr("shiftleft(1L, shard)")).alias("shards")
    drawn = materialize(draws.groupBy("rank", "block").agg(F.count("*").alias("draws"), shards), "mixing-drawn")
    width = F.lit(BLOCK_WORDS)
    spans = (
        placed.where("size > 0")
        .withColumn(
            "block",
            F.explode(
                F.sequence(
                    F.floor(F.col("start") / width), F.floor((F.col("start") + F.col("size") - 1) / width)
                )
            ),
        )
        .select(
            "rank",
            "start",
            "block",
            F.greatest(F.col("block") * width - F.col("start"), F.lit(0)).alias("from_word"),
            F.least((F.col("block") + 1) * width - F.col("start"), F.col("size")).alias("to_word"),
        )
    )
    return placed, spans.join(drawn, ["rank", "block"]).drop("block")


def sized_documents(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(doc_id, source, size, tie)`` of every row; ``tie`` fixes the stream order."""
    return df.select(
        F.col(key).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        word_count(text_of(text)).cast("long").alias("size"),
        F.xxhash64(F.col(key), text_of(text)).alias("tie"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, target and taken words of every document, its drawn blocks and the output shards they go to."""
    placed, pieces = take_words(sized_documents(documents(spark, sf_dir)))
    taken = pieces.groupBy("rank", "start").agg(
        F.sum((F.col("to_word") - F.col("from_word")) * F.col("draws")).alias("words"),
        F.sum("draws").alias("draws"),
        F.bit_or("shards").alias("mask"),
    )
    # an empty document shares its start with the next one; it takes nothing
    full = placed.where("size > 0").join(taken, ["rank", "start"], "left")
    columns = ["doc_id", "size", "source_size", "target"]
    bits = F.filter(F.sequence(F.lit(0), F.lit(SHARDS - 1)), lambda s: F.getbit("mask", s) == 1)
    return full.select(
        *columns,
        F.coalesce("words", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("draws", F.lit(0)).cast("long").alias("blocks"),
        F.array_join(F.coalesce(bits, F.array().cast("array<int>")), ",").alias("shards"),
    ).union(
        placed.where("size = 0").select(
            *columns, F.lit(0).cast("long").alias("taken"), F.lit(0).cast("long").alias("blocks"), F.lit("").alias("shards")
        )
    )


def mix_documents(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixed documents with the columns of ``df``.

    A document yields one row per pass that takes words of it (at most
    ``MAX_REPEAT``), its text cut to the taken words with the white space
    between them; a document taken whole keeps its text unchanged.
    """
    prepare_python(df.sparkSession)
    placed, pieces = take_words(sized_documents(df, key, text, source))
    passes = F.explode(F.sequence(F.lit(1).cast("long"), F.col("draws"))).alias("pass")
    plans = (
        pieces.select("rank", "start", "from_word", "to_word", passes)
        .groupBy("rank", "start", "pass")
        .agg(F.array_sort(F.collect_list(F.struct("from_word", "to_word"))).alias("spans"))
        .groupBy("rank", "start")
        .agg(F.array_sort(F.collect_list(F.struct("pass", "spans"))).alias("passes"))
    )
    # rows with the same id and text are interchangeable; they are numbered
    twins = Window.partitionBy("doc_id", "tie").orderBy("start")
    planned = materialize(
        placed.where("size > 0")
        .join(plans, ["rank", "start"])
        .withColumn("twin", F.row_number().over(twins))
        .select(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie"), F.col("twin").alias("__twin"), "passes"),
        "mixing-planned",
    )
    row_twins = Window.partitionBy("__k", "__t").orderBy("__t")
    numbered = (
        df.withColumn("__k", F.col(f"`{key}`"))
        .withColumn("__t", F.xxhash64(F.col(f"`{key}`"), text_of(f"`{text}`")))
        .withColumn("__n", F.row_number().over(row_twins))
    )
    same = (
        F.col("__k").eqNullSafe(F.col("__id")) & (F.col("__t") == F.col("__tie")) & (F.col("__n") == F.col("__twin"))
    )

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series(
            [cut_words(t, [(s["from_word"], s["to_word"]) for s in ss]) for t, ss in zip(texts, spans, strict=True)],
            dtype="object",
        )

    rows = numbered.join(planned, same).withColumn("__p", F.explode("passes"))
    body = cut(F.col(f"`{text}`").cast("string"), F.col("__p.spans"))
    return rows.select(*[body.alias(c) if c == text else F.col(f"`{c}`") for c in df.columns])


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The words of the ascending ``spans`` with the white space that follows them."""
    places = [m.span() for m in WORD.finditer(text)]
    out = []
    for first, last in spans:
        begin = 0 if first == 0 else places[first][0]
        end = len(text) if last >= len(places) else places[last][0]
        out.append(text[begin:end])
    return "".join(out)
