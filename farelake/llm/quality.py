"""Operator 5: quality classifier with hierarchical empirical Bayes.

Document evidence: a logistic model over surface features of the whole text
(length, distinct words, adjacent repeats, upper-case and exclaimed words,
word length, symbols), fitted on a bounded sample of labelled documents. Its
log odds minus the log odds of the training prior are the document's evidence.

Site evidence: every document of the corpus contributes its probability to its
path (within a host) and its host. Grouped sums give each host a Beta
posterior that shrinks toward the global rate, and each path one that shrinks
toward its host; the prior strengths come from the spread between hosts and
between paths (method of moments), so a sparse site says little and a large,
uniform one says more. A document's own share is taken out of its sites before
they judge it. The result is ``logit(path posterior) + evidence``.

Only the bounded training sample and two rows of sums reach the driver; sites
are joined as a table of any size.

Defined cases: a null text is empty; null hosts or paths are sites of their
own; labels that are null are ignored, conflicting labels of one document are
averaged and an average of 0.5 or more is good; without both classes in the
sample the evidence is zero and everything is kept; repeated rows are judged
alike; an empty table gives an empty result; extra columns are ignored by
``score_documents`` and kept by ``keep_good``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import documents, prepare_python, text_of
from farelake.sinks.snapshots import materialize
from farelake.sources.tables import read_table

#: labelled documents used for fitting, at most
TRAIN_ROWS = 10_000
#: a document is rejected below this probability
KEEP_FROM = 0.5
RIDGE = 1.0
FEATURES = 9
EVIDENCE_LIMIT = 12.0


def features(text: str) -> list[float]:
    """Surface features of a text, each of moderate size."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * FEATURES
    distinct = len(set(words))
    repeats = sum(map(eq, words, words[1:]))
    upper = sum(map(str.isupper, words))
    shouted = sum([w.endswith("!") for w in words])
    long_run = 0
    run = 1
    if repeats:
        for same in map(eq, words, words[1:]):
            run = run + 1 if same else 1
            long_run = max(long_run, run)
    letters = sum(map(len, words)) / n
    spread = math.log1p(distinct) / math.log1p(n)
    return [
        math.log1p(n) / 5.0,
        distinct / n,
        spread,
        repeats / n,
        upper / n,
        shouted / n,
        min(long_run, 50) / 50.0,
        min(letters, 40.0) / 10.0,
        sum(map(str.isalpha, words)) / n,
    ]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> dict | None:
    """Ridge logistic regression by Newton steps; None without both classes."""
    if len(y) == 0 or y.min() == y.max():
        return None
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + penalty * w
        curvature = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(curvature, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    rate = float(y.mean())
    return {
        "mean": mean,
        "scale": scale,
        "weights": w,
        "prior": math.log(rate / (1.0 - rate)),
    }


def train(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "quality", rows: int = TRAIN_ROWS,
) -> dict | None:
    """Fit on the ``rows`` labelled documents with the smallest key hashes."""
    prepare_python(df.sparkSession)
    chosen = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("id"))
        .agg((F.avg(label) >= 0.5).cast("int").alias("good"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(rows)
    )

    @F.pandas_udf("array<double>")
    def vector(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    # both sides are bounded: `rows` labels, and as many documents again
    sample = (
        df.select(F.col(key).alias("id"), text_of(text).alias("body"))
        .join(F.broadcast(chosen), "id")
        .select("id", "good", vector("body").alias("x"))
        .orderBy(F.xxhash64("id"), "id", "x")
        .limit(rows)
        .collect()
    )
    x = np.array([r["x"] for r in sample], dtype=np.float64).reshape(-1, FEATURES)
    return fit_logistic(x, np.array([r["good"] for r in sample], dtype=np.float64))


def evidence_column(model: dict | None, text: str = "text"):
    """Column with a document's log odds beyond the training prior."""
    if model is None:
        return F.lit(0.0)
    weights, mean, scale = model["weights"], model["mean"], model["scale"]
    offset, prior = float(weights[0]), model["prior"]

    @F.pandas_udf("double")
    def evidence(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            x = np.array([features(t) for t in batch], dtype=np.float64).reshape(-1, FEATURES)
            odds = offset + ((x - mean) / scale) @ weights[1:] - prior
            yield pd.Series(np.clip(odds, -EVIDENCE_LIMIT, EVIDENCE_LIMIT))

    # else the optimizer repeats the call where its value is used twice
    return evidence.asNondeterministic()(text_of(text))


def _sigmoid(x):
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def _strength(groups: DataFrame, n: str, s: str, center) -> float:
    """Prior strength (pseudo-documents) from the spread of group rates around ``center``."""
    rate = F.col(s) / F.col(n)
    row = groups.agg(
        F.sum(F.col(n) * F.pow(rate - center, 2)).alias("spread"),
        F.sum(F.col(n) * center * (F.lit(1.0) - center)).alias("chance"),
    ).first()
    if not row["spread"] or not row["chance"]:
        return 1e6
    return float(min(max(row["chance"] / row["spread"] - 1.0, 1.0), 1e6))


def site_posteriors(scored: DataFrame) -> tuple[DataFrame, dict]:
    """Per (host, path): counts, sums and the shrunk host rate; and the strengths.

    ``scored`` has ``host``, ``path`` and the document probability ``p``.
    """
    paths = materialize(
        scored.groupBy("host", "path").agg(F.count("*").alias("n_path"), F.sum("p").alias("s_path")),
        "quality-paths",
    )
    hosts = materialize(
        paths.groupBy("host").agg(F.sum("n_path").alias("n_host"), F.sum("s_path").alias("s_host")),
        "quality-hosts",
    )
    total = hosts.agg(F.sum("n_host").alias("n"), F.sum("s_host").alias("s")).first()
    rate = min(max((total["s"] or 0.0) / (total["n"] or 1), 1e-6), 1 - 1e-6)
    host_strength = _strength(hosts, "n_host", "s_host", F.lit(rate))
    sites = materialize(
        paths.withColumnRenamed("host", "h")
        .join(hosts, F.col("h").eqNullSafe(F.col("host")))
        .drop("h")
        .withColumn(
            "host_rate",
            (F.col("s_host") + F.lit(host_strength * rate)) / (F.col("n_host") + F.lit(host_strength)),
        ),
        "quality-sites",
    )
    path_strength = _strength(sites, "n_path", "s_path", F.col("host_rate"))
    return sites, {"rate": rate, "host": host_strength, "path": path_strength}


def _posterior(sites: dict):
    """Site posterior of a document without its own share."""
    p = F.col("p")
    host = (F.col("s_host") - p + F.lit(sites["host"] * sites["rate"])) / (
        F.col("n_host") - 1 + F.lit(sites["host"])
    )
    path = (F.col("s_path") - p + F.lit(sites["path"]) * host) / (
        F.col("n_path") - 1 + F.lit(sites["path"])
    )
    return host, F.least(F.greatest(path, F.lit(1e-6)), F.lit(1 - 1e-6))


def score_documents(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    path: str = "lang",
    label: str = "quality",
    model: dict | None = None,
) -> DataFrame:
    """``(doc_id, evidence, host_posterior, path_posterior, score, keep)`` per row."""
    prepare_python(df.sparkSession)
    model = model or train(df, labels, key, text, label)
    scored = materialize(
        df.select(
            F.col(key).alias("doc_id"),
            F.col(host).cast("string").alias("doc_host"),
            F.col(path).cast("string").alias("doc_path"),
            evidence_column(model, text).alias("evidence"),
        ).withColumn("p", _sigmoid(F.col("evidence") + F.lit(model["prior"] if model else 0.0))),
        "quality-scored",
    )
    return _judge(scored, *site_posteriors(scored.selectExpr("doc_host as host", "doc_path as path", "p")))


def _judge(scored: DataFrame, sites: DataFrame, strengths: dict) -> DataFrame:
    host_posterior, path_posterior = _posterior(strengths)
    same = F.col("doc_host").eqNullSafe(F.col("host")) & F.col("doc_path").eqNullSafe(F.col("path"))
    joined = scored.join(sites, same)
    logit = F.log(F.col("path_posterior") / (F.lit(1.0) - F.col("path_posterior")))
    return (
        joined.withColumn("host_posterior", host_posterior)
        .withColumn("path_posterior", path_posterior)
        .withColumn("score", _sigmoid(logit + F.col("evidence")))
        .withColumn("keep", F.col("score") >= F.lit(KEEP_FROM))
        .select("doc_id", "evidence", "host_posterior", "path_posterior", "score", "keep")
    )


def keep_good(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    path: str = "lang",
    label: str = "quality",
) -> DataFrame:
    """The rows of ``df`` that the classifier keeps, with all their columns.

    The decision is taken per row from its own text and its site's posterior,
    so the texts are not shuffled unless the site table is too large for a
    broadcast join.
    """
    prepare_python(df.sparkSession)
    model = train(df, labels, key, text, label)
    prior = F.lit(model["prior"] if model else 0.0)
    sites, strengths = site_posteriors(
        df.select(
            F.col(host).cast("string").alias("host"),
            F.col(path).cast("string").alias("path"),
            _sigmoid(evidence_column(model, text) + prior).alias("p"),
        )
    )
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    scored = row.select(
        "row",
        F.col(f"row.{host}").cast("string").alias("doc_host"),
        F.col(f"row.{path}").cast("string").alias("doc_path"),
        evidence_column(model, f"row.{text}").alias("evidence"),
    ).withColumn("p", _sigmoid(F.col("evidence") + prior))
    _, path_posterior = _posterior(strengths)
    same = F.col("doc_host").eqNullSafe(F.col("host")) & F.col("doc_path").eqNullSafe(F.col("path"))
    logit = F.log(F.col("rate") / (F.lit(1.0) - F.col("rate")))
    return (
        scored.join(sites, same)
        .withColumn("rate", path_posterior)
        .where(_sigmoid(logit + F.col("evidence")) >= F.lit(KEEP_FROM))
        .select("row.*")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence, site posteriors, score and decision of every document."""
    return score_documents(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))
