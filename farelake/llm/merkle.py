"""Operator 13: Merkle manifest of a dataset with incremental witnesses.

Every row is a leaf: the SHA-256 of its fields, each as ``-`` (null) or UTF-8
byte count, ``:``, value. Per group the leaves stand in ascending key order;
while several nodes remain, every ``FANOUT`` consecutive ones become their
parent. The group roots, in group order (null first, bytewise), form one more
tree with the manifest's root.

Nodes are appended to aligned blocks of ``BLOCK`` (``FANOUT`` to the power of
``BLOCK_LEVELS``) nodes, one task each. A node that is appended to an open run
gets a partial witness (its left siblings), and extends the witnesses of all
subtrees that already stand in the run by itself on their right. A full run
becomes a node of the next level and is appended there, which goes on
extending the witnesses of everything below it. The block roots are then
appended in the same way, block of blocks after block of blocks, until one
root is left. A witness is kept once per lowest run, not once per leaf: the
siblings of a leaf are the other members of its run.

The texts are read once, in one pass without a shuffle; what moves is one
narrow row per leaf. Positions come from a range sort and one count per range
partition, so a group that holds a third of all rows is many blocks in many
tasks. Block and group tables are 1/4096 of the rows, and one row per group.

Defined cases: a null field is ``-``; an empty text is ``0:``; rows with equal
keys in one group stand in the order of their leaf digests (null keys first);
repeated rows are leaves of their own; a lone leaf is its group's root and has
no siblings there; an empty table gives an empty result; other columns,
whatever their names, are not part of a leaf. A null key is never tampered with.
"""

from __future__ import annotations

import json
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import ascii_lower, documents, prepare_python
from farelake.sinks.snapshots import materialize

FANOUT = 16
BLOCK_LEVELS = 3
BLOCK = FANOUT**BLOCK_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<left:string,right:string>"
STEP_TYPE = pa.struct([("left", pa.string()), ("right", pa.string())])


# -- leaves and folds (built-in functions) -------------------------------------------

def encoded(value: Column) -> Column:
    """``-`` for null, else byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def fold(leaf: Column, steps: Column) -> Column:
    """The root that ``leaf`` and its witness lead to."""
    return F.aggregate(steps, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def siblings_digest(steps: Column) -> Column:
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


# -- positions -------------------------------------------------------------------------

def ranked(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``df`` written in ``order``, with ``__p`` (range partition) and ``__g`` (rank from 0).

    The driver receives one count per range partition.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("__p", F.spark_partition_id())
        .withColumn("__i", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        label,
    )
    before, offsets = 0, [0] * parts
    counts = {r["__p"]: r["n"] for r in placed.groupBy("__p").agg(F.count("*").alias("n")).collect()}
    for p in range(parts):
        offsets[p], before = before, before + counts.get(p, 0)
    starts = F.from_json(F.lit(json.dumps(offsets)), "array<bigint>")
    return placed.withColumn("__g", F.get(starts, F.col("__p")) + F.col("__i")).drop("__i")


def positions(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves with ``tree`` (rank of their group), ``pos`` and ``n``; and one row per group.

    A leaf finds its group's start by (range partition, group), so no join key
    is larger than a range partition.
    """
    placed = ranked(leaves, [F.col(c).asc_nulls_first() for c in ("grp", "key", "leaf", "salt")], "merkle-ranked")
    pieces = materialize(placed.groupBy("__p", "grp").agg(F.min("__g").alias("g"), F.count("*").alias("n")), "merkle-pieces")
    groups = pieces.groupBy("grp").agg(F.min("g").alias("start"), F.sum("n").alias("n"))
    groups = ranked(groups, [F.col("grp").asc_nulls_first()], "merkle-groups").select(
        "grp", "start", "n", F.col("__g").alias("tree")
    )
    found = pieces.select(F.col("__p").alias("p"), F.col("grp").alias("piece")).join(
        groups, F.col("piece").eqNullSafe(F.col("grp"))
    ).select("p", "piece", "start", "n", "tree")
    found = materialize(found, "merkle-starts")
    keyed = placed.join(found, (F.col("__p") == F.col("p")) & F.col("grp").eqNullSafe(F.col("piece"))).select(
        "tree", (F.col("__g") - F.col("start")).alias("pos"), "n", "key", "leaf", "tampered"
    )
    return keyed, groups


# -- appends ---------------------------------------------------------------------------

class _Subtree:
    __slots__ = ("digest", "units", "right")

    def __init__(self, digest: str, units: list[int]):
        self.digest, self.units, self.right = digest, units, []


class WitnessBlock:
    """An aligned block that nodes are appended to.

    ``witnesses[u]`` is the partial witness of unit ``u``: per level a pair of
    the left siblings (one text) and the right siblings so far. A unit is a run
    of the lowest level (``by_runs``) or a single node.
    """

    def __init__(self, levels: int, by_runs: bool):
        self.levels, self.by_runs = levels, by_runs
        self.open: list[list[_Subtree]] = [[] for _ in range(levels)]
        self.witnesses: list[list[tuple[str, list[str]]]] = []
        self.root = ""

    def append(self, digest: str) -> None:
        self.witnesses += [] if self.by_runs else [[]]
        self._push(0, _Subtree(digest, [] if self.by_runs else [len(self.witnesses) - 1]))

    def _push(self, level: int, node: _Subtree) -> None:
        if level == self.levels:
            self.root = node.digest
            return
        run = self.open[level]
        step = ("".join(m.digest for m in run), node.right)
        for unit in node.units:
            self.witnesses[unit].append(step)
        for member in run:
            member.right.append(node.digest)
        run.append(node)
        if len(run) == FANOUT:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        if level == 0 and self.by_runs:
            self.witnesses.append([])
            units = [len(self.witnesses) - 1]
        else:
            units = [u for m in run for u in m.units]
        self._push(level + 1, _Subtree(sha256("".join(m.digest for m in run).encode()).hexdigest(), units))

    def finish(self) -> None:
        """Complete the runs that are still open."""
        for level in range(self.levels):
            if self.open[level]:
                self._complete(level)
        if not self.levels and self.by_runs:
            self.witnesses.append([])

    def paths(self) -> list[list[dict]]:
        return [[{"left": left, "right": "".join(right)} for left, right in w] for w in self.witnesses]


def levels_of(n: int) -> int:
    """Levels inside a block of a tree with ``n`` nodes."""
    levels = 0
    while n > 1 and levels < BLOCK_LEVELS:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def _filled(table: pa.Table, by_runs: bool) -> tuple[pa.Table, WitnessBlock]:
    table = table.sort_by("pos").combine_chunks()
    block = WitnessBlock(levels_of(table["n"][0].as_py()), by_runs)
    for digest in table["leaf"].to_pylist():
        block.append(digest)
    block.finish()
    return table, block


def _append_leaves(table: pa.Table) -> pa.Table:
    """One row per lowest run of a block: its members and its witness inside the block."""
    table, block = _filled(table, True)
    rows, runs = table.num_rows, len(block.witnesses)
    ends = [*range(0, rows, FANOUT), rows]
    members = pa.StructArray.from_arrays(
        [table[c].chunk(0) if rows else table[c] for c in ("key", "leaf", "tampered")],
        names=["key", "leaf", "tampered"],
    )
    same = lambda c: pa.array([table[c][0].as_py()] * runs, pa.int64())
    return pa.table({
        "tree": same("tree"), "n": same("n"), "block": pa.array([table["pos"][0].as_py() // BLOCK] * runs, pa.int64()),
        "run": pa.array(range(runs), pa.int32()),
        "members": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), members),
        "path": pa.array(block.paths(), pa.list_(STEP_TYPE)),
        "root": pa.array([block.root] * runs, pa.string()),
    })


def _append_nodes(table: pa.Table) -> pa.Table:
    """One row per node of a block: its witness inside the block, and the block's root."""
    table, block = _filled(table, False)
    return pa.table({
        "tree": table["tree"], "pos": table["pos"], "n": table["n"],
        "path": pa.array(block.paths(), pa.list_(STEP_TYPE)),
        "root": pa.array([block.root] * table.num_rows, pa.string()),
    })


def climb(nodes: DataFrame) -> DataFrame:
    """``(tree, pos, path, root)`` of nodes ``(tree, pos, n, leaf)``: full witnesses up to the tree's root."""
    block = F.floor(F.col("pos") / BLOCK).cast("bigint")
    part = materialize(
        nodes.select("tree", "pos", "n", "leaf")
        .groupBy("tree", block.alias("block"))
        .applyInArrow(_append_nodes, f"tree bigint, pos bigint, n bigint, path array<{STEP}>, root string"),
        "merkle-nodes",
    )
    if not part.where(F.col("n") > BLOCK).limit(1).count():
        return part.select("tree", "pos", "path", "root")
    upper = climb(
        part.where(F.col("pos") % BLOCK == 0).select(
            "tree", block.alias("pos"), F.ceil(F.col("n") / BLOCK).cast("bigint").alias("n"), F.col("root").alias("leaf")
        )
    ).select("tree", F.col("pos").alias("up"), F.col("path").alias("more"), F.col("root").alias("top"))
    return part.withColumn("up", block).join(upper, ["tree", "up"]).select(
        "tree", "pos", F.concat("path", "more").alias("path"), F.col("top").alias("root")
    )


# -- the manifest ------------------------------------------------------------------------

def leaves_of(df: DataFrame, fields=FIELDS, key: str = "doc_id", group: str = "source", text: str = "text") -> DataFrame:
    """``(key, grp, leaf, tampered, salt)`` of every row; ``tampered`` is null where nothing is changed."""
    name = lambda c: F.col(f"`{c}`")
    hit = (F.crc32(name(key).cast("string")) % 5 == 0) & name(text).isNotNull()
    changed = [ascii_lower(name(c).cast("string")) if c == text else name(c) for c in fields]
    return df.select(
        name(key).alias("key"),
        name(group).cast("string").alias("grp"),
        leaf_digest([name(c) for c in fields]).alias("leaf"),
        F.when(hit, leaf_digest(changed)).alias("tampered"),
        F.monotonically_increasing_id().alias("salt"),
    )


def manifest(df: DataFrame, fields=FIELDS, key: str = "doc_id", group: str = "source", text: str = "text") -> DataFrame:
    """``(key, leaf, tampered, steps, subroot, root)``: every row with its whole witness.

    ``steps`` lists per level the digests left and right of the row's subtree,
    via its group's root up to the root.
    """
    prepare_python(df.sparkSession)
    leaves = materialize(leaves_of(df, fields, key, group, text), "merkle-leaves")
    keyed, groups = positions(leaves)
    key_type = leaves.schema["key"].dataType.simpleString()
    runs = materialize(
        keyed.groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("block")).applyInArrow(
            _append_leaves,
            "tree bigint, n bigint, block bigint, run int, "
            f"members array<struct<key:{key_type},leaf:string,tampered:string>>, path array<{STEP}>, root string",
        ),
        "merkle-runs",
    )
    blocks = runs.where("run = 0").select(
        "tree", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).cast("bigint").alias("n"), F.col("root").alias("leaf")
    )
    inside = materialize(climb(blocks), "merkle-blocks")
    count = groups.count()
    tops = climb(
        inside.where("pos = 0").select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("pos"),
                                       F.lit(count).cast("bigint").alias("n"), F.col("root").alias("leaf"))
    ).select(F.col("pos").alias("tree"), F.col("path").alias("last"), F.col("root").alias("top"))
    upward = materialize(
        inside.join(tops, "tree").select(
            "tree", F.col("pos").alias("block"), F.concat("path", "last").alias("upward"), F.col("root").alias("subroot"), F.col("top").alias("root")
        ),
        "merkle-upward",
    )
    member = runs.drop("root").join(upward, ["tree", "block"]).select("*", F.posexplode("members").alias("at", "m"))
    digests = F.transform("members", lambda m: m["leaf"])
    beside = F.struct(
        F.array_join(F.slice(digests, F.lit(1), F.col("at")), "").alias("left"),
        F.array_join(F.slice(digests, F.col("at") + 2, F.lit(FANOUT)), "").alias("right"),
    )
    lowest = F.when(F.col("n") > 1, F.array(beside)).otherwise(F.array().cast(f"array<{STEP}>"))
    return member.select(
        F.col("m.key").alias("key"), "m.leaf", "m.tampered", F.concat(lowest, F.col("path"), F.col("upward")).alias("steps"), "subroot", "root"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, witness digest and the check of every document."""
    proofs = manifest(documents(spark, sf_dir).select(*FIELDS))
    folded = proofs.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root",
        siblings_digest(F.col("steps")).alias("proof_sha256"),
        fold(F.coalesce("tampered", "leaf"), F.col("steps")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
