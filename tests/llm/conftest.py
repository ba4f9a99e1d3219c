from __future__ import annotations

import random

import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"

#: columns whose names clash with names the operators use inside
CLASHES = ["fp", "n", "rep", "label2", "leaf", "own", "tie", "rank", "bucket", "words", "p", "row", "component_id", "keep", "place"]


def fixture_texts() -> list:
    """Texts with nulls, empties, repeats, near copies, non-ASCII and very long ones."""
    r = random.Random(7)
    vocab = ["alpha", "the", "of", "Beta", "gamma", "delta-x", "die", "und", "épée", "la", "x1", "42", "zeta", "omega!"]
    body = lambda k: " ".join(r.choice(vocab) + str(r.randint(0, 30)) * (r.random() < 0.3) for _ in range(k))
    texts = [None, "", " ", "\n\n", "one", "one two", "  \U0001f600 ", "A B C D E F G H"]
    shared = "This boilerplate line number 17 is shared by many documents"
    for i in range(30):
        texts.append(body(r.randint(1, 60)) + ("\n" + shared.replace("17", str(i)) if i % 3 else ""))
    base = body(300)
    texts += [base, base, base + " tail", base.replace("alpha", "alphb", 1)]
    texts += [body(20000), "word" * 5000, "a\tb\r\nc d\x0be f\x00g  h   i"]
    return texts


@pytest.fixture(scope="session")
def docs(spark):
    """The fixture documents: null and repeated ids, null sources, clashing extra columns."""
    texts = fixture_texts()
    rows = []
    for i, t in enumerate(texts):
        rows.append((i * 3, t, ["en", None, "de"][i % 3], [None, "src0", "src0", "src1"][i % 4], len(t) if t else None))
    rows.append((None, texts[20], "en", "src0", 5))
    rows.append(rows[25])
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(rows, schema)
    for c in CLASHES:
        frame = frame.selectExpr("*", f"cast(7 as int) as `{c}`")
    return frame.repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")


@pytest.fixture(scope="session")
def duck_small():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.fixture(scope="session")
def small_documents(duck_small):
    return duck_small.execute("select doc_id, coalesce(text, ''), source from documents order by doc_id").fetchall()
