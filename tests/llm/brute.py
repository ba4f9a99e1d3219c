"""Brute-force versions of the operators, in plain Python, for small inputs."""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def components(n: int, links) -> list[int]:
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def simhash(text: str, k: int = 3) -> int:
    words = WORDS.findall(text.translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(docs, radius: int = 3) -> list[tuple]:
    """``(doc_id, fp, component)`` sorted; ids may be null."""
    prints = [simhash(t or "") for _, t in docs]
    links = [
        (a, b)
        for a in range(len(docs))
        for b in range(a)
        if (prints[a] ^ prints[b]).bit_count() <= radius
    ]
    group = components(len(docs), links)
    low: dict = {}
    for (i, _), g in zip(docs, group, strict=True):
        if i is not None:
            low[g] = min(low.get(g, i), i)
    return [(i, f, low.get(g)) for (i, _), f, g in zip(docs, prints, group, strict=True)]


def secrets(text: str) -> list[tuple]:
    """Base spans ``(start, rank, end)``, sorted."""
    either = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    names = "|".join(either(w) for w in ("password", "passwd", "secret", "token")) + "|" + either("api") + "_?" + either("key")
    assign = re.compile(rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def entropy(part: str) -> float:
    return -sum(part.count(c) / len(part) * math.log2(part.count(c) / len(part)) for c in set(part))


def random_run(value: str) -> bool:
    """Whether a candidate run is reported, window by window."""
    allow = re.compile(
        "example|sample|dummy|placeholder|changeme|0123456789|123456789|abcdefgh|qwerty|000000|xxxxxx"
        "|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$", re.I,
    )
    if len(value) < 16 or not (re.search("[A-Za-z][0-9]|[0-9][A-Za-z]", value)):
        return False
    text = "/".join(" " * len(s) if allow.search(s) else s for s in re.split("[/=]", value))
    size = min(20, len(text))
    for i in range(len(text) - size + 1):
        part = text[i : i + size]
        if " " in part or not re.search("[0-9]", part) or not re.search("[A-Za-z]", part):
            continue
        if re.fullmatch("[0-9a-fA-F]+", part):
            low, high = 2.60, 2.82
        elif re.fullmatch("[0-9a-z]+|[0-9A-Z]+", part):
            low, high = 3.07, 3.34
        else:
            low, high = 3.32, 3.58
        if entropy(part) >= low + (size - 16) * (high - low) / 4:
            return True
    return False


def license_words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))


def line_tokens(line: str) -> tuple:
    variable = re.compile(r"[0-9]|^\S+@\S+\.\S+$|^(?:[hH][tT][tT][pP][sS]?://|[wW][wW][wW]\.)")
    return tuple("<*>" if variable.search(x) else x for x in re.split(r"[\x20\t\x0B\f\r]+", line) if x)


def dropped_lines(docs, depth: int = 3, share: float = 0.8) -> dict:
    """Line numbers dropped per doc id: all lines of a leaf compared with each other."""
    lines = []
    for i, t in docs:
        for n, line in enumerate((t or "").split("\n") if t is not None and i is not None else []):
            if tokens := line_tokens(line):
                lines.append((i, n, tokens))
    kinds = sorted({tokens for *_, tokens in lines})
    number = {t: k for k, t in enumerate(kinds)}
    leaves = defaultdict(list)
    for t in kinds:
        leaves[len(t), t[:depth]].append(t)
    links = [
        (number[a], number[b])
        for leaf in leaves.values()
        for x, a in enumerate(leaf)
        for b in leaf[:x]
        if sum(p == q for p, q in zip(a, b)) >= math.ceil(len(a) * share)
    ]
    group = components(len(kinds), links)
    holders = defaultdict(set)
    for i, _, t in lines:
        holders[group[number[t]]].add(i)
    gone = defaultdict(set)
    for i, n, t in lines:
        if i != min(holders[group[number[t]]]):
            gone[i].add(n)
    return gone



def vector_links(rows, least: float = 0.93):
    """``{vec_id: (n_links, component)}`` for ``(vec_id, vector, label)``."""
    unit = {}
    for k, (i, v, label) in enumerate(rows):
        ok = i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
        if ok and any(v):
            a = np.array(v, dtype=np.float64)
            unit[k] = a / np.linalg.norm(a)
    links = [
        (a, b)
        for a in unit
        for b in unit
        if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least
    ]
    group = components(len(rows), links)
    low: dict = {}
    for k, g in enumerate(group):
        if rows[k][0] is not None:
            low[g] = min(low.get(g, rows[k][0]), rows[k][0])
    count = defaultdict(int)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return sorted((rows[k][0], count[k], low.get(group[k])) for k in range(len(rows)) if rows[k][0] is not None)
