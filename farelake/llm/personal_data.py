"""Operator 12: personal data with a skip-chain conditional random field.

Four base patterns (email, ip, card, phone) are matched leftmost and
non-overlapping, each in one linear pass. The field then labels tokens:

* **Nodes** are the white-space tokens that hold a digit or ``@``; every other
  token can only be ``O`` and is part of its neighbours' unary potentials.
* **Chain edges** join nodes that stand side by side, **skip edges** join each
  node to the previous one of the same normal form (the digits, if there are
  ``MIN_LINK`` or more, else the lower-cased address), however far away. A form
  that occurs n times has n - 1 edges, so a text costs time linear in its length.
* **Inference** is loopy belief propagation: ``ROUNDS`` synchronous rounds of
  damped sum-product messages over all nodes of a batch of texts at once
  (numpy); a text's result does not depend on the batch.
* **Added spans** are runs of adjacent tokens with the same entity label
  (marginal of at least ``THRESHOLD``) that touch no base span. Their kinds are
  ``skip_`` and the label.

The weights are trained here, on labels taken from the base spans (distant
supervision): features and chain by pseudo-likelihood (a token's label given its
features and its neighbours' labels), skip edges as a piece of their own, by how
often linked tokens agree. The sample is at most ``TRAIN_DOCS`` distinct texts drawn by hash, each of at
most ``TRAIN_CHARS`` characters and ``TRAIN_TOKENS`` nodes, and is all the driver
sees. All texts are then scanned whole, in one pass without a shuffle.

Defined cases: a null or empty text has no spans; equal texts have equal spans;
a corpus without any base span has nothing to learn from and gets no added ones;
repeated rows and null ids are reported per row; an empty table gives an empty
result; extra columns are ignored. Positions are code points, end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from farelake.llm.common import documents, prepare_python

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, *(f"skip_{k}" for k in BASE))
#: label 0 is O
LABELS = 1 + len(BASE)

TRAIN_DOCS = 4_000
TRAIN_CHARS = 100_000
TRAIN_TOKENS = 200
DRAWS = 1 << 30
BUCKETS = 1 << 14
MIN_LINK = 4
ROUNDS = 20
DAMPING = 0.3
CHUNK = 1 << 16
THRESHOLD = 0.5

# -- base spans ------------------------------------------------------------------------

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# a digit run that fails at its first digit fails at all of them
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the address pattern: the longest run before each ``@`` that a domain follows."""
    done = at = 0
    while (at := text.find("@", max(at, done))) >= 0:
        # neither side of an address holds another @
        run = text[max(done, text.rfind("@", done, at) + 1) : at]
        size = len(run) - len(run.rstrip(LOCAL))
        m = DOMAIN.match(text, at) if size else None
        if m:
            yield at - size, m.end()
            done = m.end()
        at += 1


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return (doubled + sum(int(c) for c in digits[-1::-2])) % 10 == 0


def small_parts(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns, in order."""
    spans = [(a, 0, b) for a, b in emails(text)]
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if small_parts(m[0])]
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    if "+" in text:
        spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(spans)


# -- nodes, features and edges -----------------------------------------------------------

DIGITS = re.compile(r"[0-9]+")
LETTERS = re.compile(r"[^\W0-9_]+")
EDGE = re.compile(r"^[^\w+(]+|[^\w)]+$")
CONTEXT = 32
WIDTH = 9


@dataclass
class Graph:
    """Nodes of one text: places, feature buckets and edges between node numbers."""

    starts: np.ndarray
    ends: np.ndarray
    features: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def node_places(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the tokens with a digit or ``@``; whether each follows the one before it directly."""
    codes = np.frombuffer(text.encode("ascii"), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    blanks = np.flatnonzero((codes == 32) | ((codes >= 9) & (codes <= 13)))
    hits = np.flatnonzero(((codes >= 48) & (codes <= 57)) | (codes == 64))
    gap = np.unique(np.searchsorted(blanks, hits))
    walls = np.concatenate([[-1], blanks, [len(codes)]])
    starts, ends = walls[gap] + 1, walls[gap + 1]
    between = gap[1:] - gap[:-1]  # blanks from one node's end to the next one's start
    follows = np.concatenate([[False], starts[1:] - ends[:-1] == between]) if len(gap) else np.zeros(0, bool)
    return starts, ends, follows


def shape_of(token: str) -> str:
    return LETTERS.sub("a", DIGITS.sub(lambda m: f"#{min(len(m[0]), 20)}", token))


def _features(token: str, before: str, after: str) -> list[int]:
    core = EDGE.sub("", token)
    shape = shape_of(core)
    digits = NOT_DIGIT.sub("", core)
    many = 14 <= len(digits) <= 19
    named = [
        "bias", f"shape {shape}", f"form {DIGITS.sub('#', shape)}", f"digits {min(len(digits), 24)}",
        f"luhn {luhn(digits) if many else '-'}", f"parts {small_parts(core) if IP.fullmatch(core) else '-'}",
        f"at {'@' in core}", f"before {EDGE.sub('', before).lower()}", f"after {EDGE.sub('', after).lower()}",
    ]
    return [crc32(n.encode("utf-8", "surrogatepass")) % BUCKETS for n in named]


def normal_form(token: str) -> str:
    digits = NOT_DIGIT.sub("", token)
    if "@" in token:
        return EDGE.sub("", token).lower()
    return digits if len(digits) >= MIN_LINK else ""


def graph_of(text: str) -> Graph:
    starts, ends, follows = node_places(text)
    features, skip, last = [], [], {}
    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        token = text[a:b]
        before, after = text[max(0, a - CONTEXT) : a].split(), text[b : b + CONTEXT].split()
        features.append(_features(token, before[-1] if before else "", after[0] if after else ""))
        form = normal_form(token)
        if form:
            if form in last:
                skip.append((last[form], i))
            last[form] = i
    right = np.flatnonzero(follows)
    return Graph(
        starts, ends, np.array(features, np.int64).reshape(-1, WIDTH),
        np.stack([right - 1, right], axis=1), np.array(skip, np.int64).reshape(-1, 2),
    )


def labels_of(graph: Graph, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Label of every node: that of the last base span that touches it, else O."""
    labels = np.zeros(len(graph.starts), np.int64)
    for start, kind, end in spans:
        first = np.searchsorted(graph.ends, start, side="right")
        labels[first : np.searchsorted(graph.starts, end)] = kind + 1
    return labels


# -- the field -------------------------------------------------------------------------

@dataclass
class Field:
    """Weights: per feature bucket and label, per ordered pair of side-by-side labels, per pair of linked labels."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def potentials(field: Field, features: np.ndarray, chain: np.ndarray) -> np.ndarray:
    """Unary potentials; a side without a neighbouring node has a neighbour O."""
    unary = field.unary[features].sum(axis=1)
    left, right = np.ones(len(features), bool), np.ones(len(features), bool)
    left[chain[:, 1]] = False
    right[chain[:, 0]] = False
    return unary + np.outer(left, field.chain[0]) + np.outer(right, field.chain[:, 0])


def marginals(unary: np.ndarray, edges: np.ndarray, pairs: np.ndarray, rounds: int = ROUNDS, damping: float = DAMPING) -> np.ndarray:
    """Loopy sum-product: node marginals after ``rounds`` synchronous rounds.

    ``pairs[e]`` is the log potential of edge ``e`` by the labels of its two ends.
    """
    n, labels = unary.shape
    source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    both = np.concatenate([pairs, pairs.transpose(0, 2, 1)])
    half = len(edges)
    back = np.concatenate([np.arange(half, 2 * half), np.arange(half)])
    sent = np.zeros((2 * half, labels))

    def beliefs() -> np.ndarray:
        inward = [np.bincount(target, weights=sent[:, k], minlength=n) for k in range(labels)]
        return unary + np.stack(inward, axis=1) if half else unary

    for _ in range(rounds if half else 0):
        total, new = beliefs(), np.empty_like(sent)
        for a in range(0, 2 * half, CHUNK):
            part = slice(a, a + CHUNK)
            out = _log_sum((total[source[part]] - sent[back[part]])[:, :, None] + both[part], axis=1)
            new[part] = out - _log_sum(out, axis=1)[:, None]
        sent = damping * sent + (1 - damping) * new
    total = beliefs()
    return np.exp(total - _log_sum(total, axis=1)[:, None])


def joined(graphs: list[Graph]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, chain and skip edges of several texts as one graph."""
    shift = np.cumsum([0] + [len(g.starts) for g in graphs])
    return (
        np.concatenate([g.features for g in graphs]),
        np.concatenate([g.chain + s for g, s in zip(graphs, shift)]),
        np.concatenate([g.skip + s for g, s in zip(graphs, shift)]),
    )


def label_probabilities(field: Field, graphs: list[Graph]) -> list[np.ndarray]:
    """Marginals of the nodes of every text."""
    graphs_with = [g for g in graphs if len(g.starts)]
    if not graphs_with:
        return [np.zeros((0, LABELS)) for _ in graphs]
    features, chain, skip = joined(graphs_with)
    pairs = np.concatenate([np.broadcast_to(m, (len(e), *m.shape)) for m, e in ((field.chain, chain), (field.skip, skip))])
    found = marginals(potentials(field, features, chain), np.concatenate([chain, skip]), pairs)
    cuts = np.cumsum([len(g.starts) for g in graphs])[:-1]
    return np.split(found, cuts)


def agreement(labels: np.ndarray, skip: np.ndarray, smooth: float = 0.5) -> np.ndarray:
    """Log ratio of linked label pairs to independent ones, over the links of the sample."""
    pairs = np.full((LABELS, LABELS), smooth)
    np.add.at(pairs, (labels[skip[:, 0]], labels[skip[:, 1]]), 0.5)
    np.add.at(pairs, (labels[skip[:, 1]], labels[skip[:, 0]]), 0.5)
    pairs /= pairs.sum()
    one = pairs.sum(axis=0)
    return np.log(pairs) - np.log(one)[:, None] - np.log(one)[None, :]


def fit(features: np.ndarray, labels: np.ndarray, chain: np.ndarray, skip: np.ndarray, rounds: int = 200, ridge: float = 0.1) -> Field:
    """Pseudo-likelihood weights of features and side-by-side labels (softmax, by Adam); skip weights by ``agreement``."""
    n, width = features.shape
    left, right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    left[chain[:, 1]], right[chain[:, 0]] = labels[chain[:, 0]], labels[chain[:, 1]]
    one = np.eye(LABELS)
    flat = features.ravel()
    weights = [np.zeros((BUCKETS, LABELS)), np.zeros((LABELS, LABELS))]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, rounds + 1):
        unary, chained = weights
        logits = unary[features].sum(axis=1) + chained[left] + chained.T[right]
        wrong = (np.exp(logits - _log_sum(logits, axis=1)[:, None]) - one[labels]) / n
        spread = np.repeat(wrong, width, axis=0)
        g_unary = np.stack([np.bincount(flat, weights=spread[:, k], minlength=BUCKETS) for k in range(LABELS)], axis=1)
        g_chain = one[left].T @ wrong + (one[right].T @ wrong).T
        for i, g in enumerate((g_unary, g_chain)):
            g = g + ridge * weights[i] / n
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            weights[i] = weights[i] - 0.05 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Field(*weights, agreement(labels, skip))


# -- training sample and scan --------------------------------------------------------------

def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: dict[str, list] = {"h": [], "features": [], "labels": [], "chain": [], "skip": []}
        for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            graph = graph_of(text)
            if not 0 < len(graph.starts) <= TRAIN_TOKENS:
                continue
            for name, values in zip(rows, (h, graph.features, labels_of(graph, base_spans(text)), graph.chain, graph.skip)):
                rows[name].append(values if name == "h" else values.ravel().tolist())
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[c], pa.int64() if c == "h" else longs) for c in rows], names=list(rows)
        )


def train(df: DataFrame, text: str = "text", docs: int = TRAIN_DOCS) -> Field | None:
    """The field fitted on at most ``docs`` distinct texts; None where nothing can be learnt."""
    prepare_python(df.sparkSession)
    body = F.col(f"`{text}`").cast("string")
    usable = df.select(body.alias("body")).where((F.char_length("body") <= TRAIN_CHARS) & F.col("body").rlike("[0-9@]"))
    rows = usable.count()
    # twice the wanted share, so that repeated texts leave enough distinct ones
    share = min(1.0, 2 * docs / rows) if rows else 1.0
    hashed = usable.select(F.xxhash64("body").alias("h"), "body")
    drawn = hashed.where(F.pmod("h", F.lit(DRAWS)) < int(share * DRAWS)).dropDuplicates(["h"])
    found = (
        drawn.mapInArrow(_examples, "h bigint, features array<bigint>, labels array<bigint>, chain array<bigint>, skip array<bigint>")
        .orderBy("h")
        .limit(docs)
        .collect()
    )
    graphs, labels = [], []
    for r in found:
        n = len(r["labels"])
        edges = [np.array(r[c], np.int64).reshape(-1, 2) for c in ("chain", "skip")]
        graphs.append(Graph(np.zeros(n), np.zeros(n), np.array(r["features"], np.int64).reshape(-1, WIDTH), *edges))
        labels.append(np.array(r["labels"], np.int64))
    if not any(part.any() for part in labels):
        return None
    features, chain, skip = joined(graphs)
    return fit(features, np.concatenate(labels), chain, skip)


def added_spans(text: str, graph: Graph, shares: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs of side-by-side nodes with one entity label that touch no base span."""
    label = np.where(shares.max(axis=1) >= THRESHOLD, shares.argmax(axis=1), 0)
    side = np.zeros(len(label), bool)
    side[graph.chain[:, 1]] = True
    goes_on = side & (label == np.concatenate([[0], label[:-1]]))
    heads = np.flatnonzero((label > 0) & ~goes_on)
    found = []
    for i in heads.tolist():
        j = i
        while j + 1 < len(label) and goes_on[j + 1]:
            j += 1
        run = text[graph.starts[i] : graph.ends[j]]
        core = EDGE.sub("", run)
        start = int(graph.starts[i]) + (run.find(core) if core else 0)
        if core:
            found.append((start, len(BASE) + int(label[i]) - 1, start + len(core)))
    covered = np.array([(a, b) for a, _, b in base], np.int64).reshape(-1, 2)
    starts, reach = covered[:, 0], np.maximum.accumulate(covered[:, 1]) if len(covered) else covered[:, 1]

    def free(a: int, b: int) -> bool:
        before = int(np.searchsorted(starts, b)) - 1
        return before < 0 or reach[before] <= a

    return [s for s in found if free(s[0], s[2])]


def _scanner(field: Field | None, schema: pa.Schema):
    def spans_of(texts: list[str]) -> Iterator[list[dict]]:
        base = [base_spans(t) for t in texts]
        extra: list[list] = [[] for _ in texts]
        if field is not None:
            graphs = [graph_of(t) for t in texts]
            shares = label_probabilities(field, graphs)
            extra = [added_spans(*x) if len(x[1].starts) else [] for x in zip(texts, graphs, shares, base)]
        for b, e in zip(base, extra):
            yield [{"start": s, "kind": k, "end": t} for s, k, t in sorted(b + e)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(spans_of(texts)), schema.field("spans").type)], schema=schema
            )

    return run


def scan(df: DataFrame, field: Field | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, spans)``: base and added spans ``(start, kind, end)`` of every row, in order.

    ``kind`` is an index of ``KINDS``.
    """
    prepare_python(df.sparkSession)
    source = df.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    id_type = source.schema["doc_id"].dataType
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    schema = pa.schema([("doc_id", to_arrow_type(id_type)), ("spans", pa.list_(span))])
    ddl = f"doc_id {id_type.simpleString()}, spans array<struct<start:int,kind:int,end:int>>"
    return source.mapInArrow(_scanner(field, schema), ddl)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest of the base spans and all spans of every document."""
    docs = documents(spark, sf_dir)
    found = scan(docs, train(docs))
    names = F.array(*[F.lit(k) for k in KINDS])
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))

    def count_of(kind: int):
        # one parameter only: F.filter would bind a second one to the place in the array
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def listed(spans):
        part = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
        return F.array_join(F.transform(spans, part), ",")

    return found.select(
        "doc_id",
        *[count_of(i).alias(f"n_{k}") for i, k in enumerate(BASE)],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(base)).cast("long").alias("n_added"),
    )
