"""Operator 13 against a plain recursive Merkle tree."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from brute import LOWER

from farelake.llm import merkle


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row) -> str:
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return sha("".join(parts))


def tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root and, per node, the (left, right) siblings of every level."""
    paths, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, up_below = [], []
        for s in range(0, len(nodes), 16):
            run = nodes[s : s + 16]
            for j in range(len(run)):
                for i in below[s + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(sha("".join(run)))
            up_below.append([i for b in below[s : s + 16] for i in b])
        nodes, below = up, up_below
    return nodes[0] if nodes else "", paths


def expected(rows) -> list[tuple]:
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs, paths = {}, {}
    for s in order:
        groups[s].sort(key=lambda e: e[:3])
        subs[s], paths[s] = tree([e[2] for e in groups[s]])
    root, tops = tree([subs[s] for s in order])
    found = []
    for g, s in enumerate(order):
        for i, (_, _, own, row) in enumerate(groups[s]):
            steps = paths[s][i] + tops[g]
            node = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                node = leaf((*row[:4], row[4].translate(LOWER)))
            for left, right in steps:
                node = sha(left + node + right)
            found.append((row[0], own, subs[s], root, sha("".join(a + b for a, b in steps)), node, node == root))
    return found


def got(frame) -> list[tuple]:
    proofs = merkle.manifest(frame)
    rows = proofs.select(
        "key", "leaf", "subroot", "root", merkle.siblings_digest(proofs.steps).alias("p"),
        merkle.fold(merkle.F.coalesce("tampered", "leaf"), proofs.steps).alias("f"),
    ).collect()
    return [(*r, r["f"] == r["root"]) for r in rows]


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:])))


def test_manifest_matches_plain_tree(docs):
    rows = [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]
    found = got(docs)
    assert ordered(found) == ordered(expected(rows))
    assert any(not r[-1] for r in found) and any(r[-1] for r in found)


@pytest.mark.parametrize("n", [1, 16, 17])
def test_small_groups(spark, n):
    rows = [(i, "s", "en", 1, f"Text {i}") for i in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert ordered(got(frame)) == ordered(expected(rows))


def test_several_blocks(spark):
    """One group of three blocks, repeated keys and rows in it, and 300 groups of one row."""
    rows = [(i // 2, "hot", None, 3, "Same" if i % 3 else f"T{i}") for i in range(2 * merkle.BLOCK + 37)]
    rows += [(i, f"s{i}", "en", None, None if i % 2 else "") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert ordered(got(frame.repartition(7))) == ordered(expected(rows))


def test_no_rows(no_docs):
    assert got(no_docs) == []


@pytest.mark.parametrize("n", [0, 1, 5, 16, 33, 256, 300])
def test_witness_is_complete_after_every_append(n):
    """Partial witnesses grow with each append; after the last one they are whole."""
    nodes = [sha(str(i)) for i in range(n)]
    block = merkle.WitnessBlock(merkle.levels_of(n), by_runs=False)
    for d in nodes:
        block.append(d)
    block.finish()
    root, paths = tree(nodes)
    assert block.root == root
    assert [[(s["left"], s["right"]) for s in p] for p in block.paths()] == paths
