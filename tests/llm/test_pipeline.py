"""The pipeline, stage by stage, against brute-force versions on a small table."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline
from farelake.llm import mixing, pieces, quality, queries
from farelake.llm.common import documents
from farelake.sources.tables import read_table


@pytest.fixture(scope="module")
def stages(spark, small_dir, tmp_path_factory):
    """Input and output rows of every stage, each written and read again."""
    docs = documents(spark, small_dir)
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, seen[-1], small_dir).write.parquet(path)
        seen.append(spark.read.parquet(path))
    return seen


def rows(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def test_columns(stages):
    for frame in stages[1:-1]:
        assert frame.columns == stages[0].columns
    for frame in stages[2:-1]:
        assert all(r["n_chars"] == len(r["text"]) for r in frame.collect())


def test_quality_stage_keeps_whole_rows(spark, small_dir, stages):
    scored = quality.score_documents(stages[0], read_table(spark, small_dir, "labels"))
    kept = {r["doc_id"] for r in scored.where("keep").collect()}
    assert sorted(rows(stages[1])) == sorted(r for r in rows(stages[0]) if r[0] in kept)
    good = {r["doc_id"]: r["quality"] for r in read_table(spark, small_dir, "labels").collect()}
    right = [(i in kept) == (q == 1) for i, q in good.items()]
    assert sum(right) / len(right) > 0.95


def test_line_stage(stages):
    before = rows(stages[1])
    gone = brute.dropped_lines(before)
    want = [(i, "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i])) for i, t in before]
    assert sorted(rows(stages[2])) == sorted(want)


def test_simhash_stage_keeps_one_of_each_group(stages):
    before = rows(stages[2])
    firsts = {c for _, _, c in brute.simhash_components(before)}
    assert sorted(rows(stages[3])) == sorted(r for r in before if r[0] in firsts)


def test_mixing_stage_meets_the_targets(stages):
    before, after = stages[3].collect(), stages[4].collect()
    count = lambda t: len(brute.WORDS.findall(t))
    sizes, taken, per_row = Counter(), Counter(), Counter()
    for r in before:
        sizes[r["source"]] += count(r["text"])
    for r in after:
        taken[r["source"]] += count(r["text"])
        per_row[r["doc_id"]] += count(r["text"])
    order = sorted(sizes)
    goals = mixing.targets([sizes[s] for s in order])
    for s, goal in zip(order, goals, strict=True):
        assert abs(taken[s] - goal) <= mixing.BLOCK_WORDS + 1
    text = {r["doc_id"]: r["text"] for r in before}
    assert all(per_row[i] <= 2 * count(text[i]) for i in per_row)
    # a row holds words of its document, in order, none twice
    for r in after:
        words = iter(brute.WORDS.findall(text[r["doc_id"]]))
        assert all(w in words for w in brute.WORDS.findall(r["text"]))


def test_encoding_stage_equals_the_library(stages):
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model_path())
    want = defaultdict(int)
    for i, t in rows(stages[4]):
        ids = model.encode(t, add_bos=True, add_eos=True)
        digest = hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        want[i, len(ids), digest, hashlib.sha256(model.decode(ids).encode()).hexdigest()] += 1
    got = Counter(tuple(r) for r in stages[5].collect())
    assert got == want


def test_run_equals_the_stages(spark, small_dir, stages):
    got = corpus_pipeline.run(spark, small_dir)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, stages[5].collect()))


def test_entry_registers_the_subpackage():
    names = entry.queries()
    assert set(queries.queries()) <= set(names) and names["pipeline"] is corpus_pipeline.run
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{i}" for i in range(1, 14)]
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_awkward_rows(spark, docs, small_dir, tmp_path, empty):
    """Nulls in every column, empty, very long and repeated texts, clashing extra columns; an empty table."""
    seen = docs.where("false") if empty else docs
    for name, stage in corpus_pipeline.STAGES:
        before = seen
        out = stage(spark, before, small_dir)
        out.write.parquet(f"{tmp_path}/{name}")
        seen = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "encode_pieces":
            assert seen.columns == docs.columns
        if empty:
            assert seen.count() == 0
        elif name == "simhash_dedup":
            # repeated rows, null and empty texts: one of each group
            texts = [t for _, t in rows(seen) if not (t or "").split()]
            assert len(texts) <= 1 and 0 < seen.count() < before.count()
        elif name == "line_dedup":
            nulls = "text is null or doc_id is null"
            assert seen.count() == before.count() and seen.where(nulls).count() == before.where(nulls).count()
        elif name == "encode_pieces":
            assert seen.count() == before.count() and seen.where("n_tokens < 2").count() == 0
