"""The registered queries against their SQL twins."""

from __future__ import annotations

import duckdb
import pytest

from farelake.llm import licenses, oracles, queries
from tools.oracle_check import canon


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_twin(spark, small_dir, duck_small, name):
    frame = queries.queries()[name](spark, small_dir)
    cur = duck_small.execute(queries.oracle_sql()[name])
    columns, want = canon([d[0] for d in cur.description], cur.fetchall())
    assert (columns, want) == canon(frame.columns, frame.collect())


def test_license_twin_where_a_third_is_licensed(spark, tmp_path):
    """Template words that are common in the corpus; verbatim texts score 1."""
    notices = [body for _, body, _ in licenses.TEMPLATES]
    texts = [None, "", "free software without any notice"]
    texts += [f"File number {i} by somebody\n{notices[i % len(notices)]}" for i in range(40)]
    texts += [" and ".join(notices[j] for j in range(i % 7)) + " or all rights" for i in range(20)]
    texts += [f"Words of no notice at all {i}" for i in range(30)]
    rows = [(i, t, "en", "src0", len(t) if t else None) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = licenses.query(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    cur = con.execute(oracles.LICENSES)
    rows = got.collect()
    assert canon([d[0] for d in cur.description], cur.fetchall()) == canon(got.columns, rows)
    score = {r["doc_id"]: r["score"] for r in rows}
    assert all(score[3 + i] == 1.0 for i in range(40))
