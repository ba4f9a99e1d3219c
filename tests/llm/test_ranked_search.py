"""Operator 11 against exhaustive scoring."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from brute import LOWER

from farelake.llm import ranked_search

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text) -> list[str]:
    return TERMS.findall((text or "").translate(LOWER))


def exhaustive(docs, items, k=20):
    """(item, rank, doc, score) of ``docs`` and ``items``, lists of (id, text)."""
    bags = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(n > 0 for *_, n in bags), sum(n for *_, n in bags)
    df = Counter(w for _, bag, _ in bags for w in bag)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, []).extend(terms(text))
    rows = []
    for item, words in wanted.items():
        scored = []
        for d, bag, n in bags:
            m = 100 - 25 + (25 * n * n_docs) // n_terms if n_terms else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * bag[w]) // (1000 * bag[w] + 12 * m))
                for w in words
                if w in bag
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        scored.sort(key=lambda s: s[:3])
        rows += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(scored[:k])]
    return rows


def found(frame, items, **options):
    index = ranked_search.build_index(frame)
    return [tuple(r) for r in ranked_search.search(index, items, **options).collect()]


def key(row):
    return tuple((x is not None, x if x is not None else 0) for x in row)


ITEMS = [
    (1, "alpha the Of beta, gamma! the the"),
    (2, "42 épée x1 délta zeta"),
    (2, "omega"),
    (None, "la die und"),
    (4, None),
    (5, "unknownword"),
    (6, "This boilerplate line number shared by many documents"),
]


def test_search_matches_exhaustive_scoring(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = found(docs, items)
    want = exhaustive(rows, ITEMS)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_blocks_of_items_and_segments(spark, docs, monkeypatch):
    """Items in several blocks give the same rows."""
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", 5)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert sorted(found(docs, items, k=3), key=key) == sorted(exhaustive(rows, ITEMS, 3), key=key)


def test_nothing_to_search(spark, docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert found(no_docs, items) == []
    assert found(docs, items.where("false")) == []
    assert ranked_search.search(ranked_search.build_index(no_docs), items).columns == ["item_id", "rank", "doc_id", "score"]


@pytest.mark.parametrize("seed", range(6))
def test_skipping_equals_plain_sums(seed):
    """Windows, accumulators and early exits never change the best documents."""
    r = random.Random(seed)
    rows = r.choice([1, 700, 5000])
    edges = np.append(np.arange(0, rows, ranked_search.WINDOW), rows)
    lists, sums = [], np.zeros(rows, np.int64)
    for _ in range(r.randint(1, 25)):
        share = r.choice([0.001, 0.01, 0.2, 0.7])
        docs = np.flatnonzero(np.random.default_rng(r.randint(0, 10**6)).random(rows) < share)
        gains = np.array([r.choice([1, 5, 5, 900]) for _ in docs], np.int64)
        weight = r.choice([1, 3, 40])
        lists.append((weight, ranked_search.Postings(docs, gains, edges)))
        sums[docs] += weight * gains
    best, scores = ranked_search.top_documents(lists, rows, edges, 20)
    order = [i for i in np.lexsort((np.arange(rows), -sums)) if sums[i] > 0][:20]
    assert best.tolist() == order and scores.tolist() == sums[order].tolist()
