"""Operator 3: embedding near-dedup by an exact metric range join.

Vectors of one label are compared by cosine. On unit vectors a cosine of at
least ``c`` is a Euclidean distance of at most ``r = sqrt(2 - 2c)``, a metric:

* equal vectors of a label are reduced to one class with a count;
* a bounded hash sample of the classes serves as pivots; every class is at
  home in the cell of its nearest pivot;
* a class also visits cell j when it can be within ``r`` of a member: by the
  triangle inequality its distances to pivot j and to its own pivot differ by
  at most ``2r``, it lies within ``r`` of the plane halfway between both
  pivots, and it is within ``r`` of the ball that holds the members of cell j;
* cells join independently. A cell is cut into blocks, and each pair of a
  home block and a block of all its members is one group of bounded size,
  compared in double precision.

All neighbours of a class are in its home cell, so link counts add up exactly
once. Groups emit counts and the links of a spanning forest, never all pairs.
Pivots (at most ``MAX_PIVOTS`` vectors) are all that the driver holds; they
only steer the partitioning, the result is exact for any pivots.

Defined cases: a vector that is null, empty, zero or has null or non-finite
components, a null label or a null ``vec_id`` links with nothing (no links,
its own component); vectors of different lengths are not comparable; repeated
rows are separate vectors; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import connected_components
from farelake.llm.forest import merge_labels
from farelake.session import ship_package
from farelake.sinks.snapshots import materialize
from farelake.sources.tables import read_table

MIN_COSINE = 0.93
CELL_ROWS = 2048
BLOCK_ROWS = 4096
CHUNK_ROWS = 512
MAX_PIVOTS = 4096
MAX_CELLS = 64  # per label
SLACK = 1e-9
GROUP = ["label", "dim"]


def _units(vectors) -> np.ndarray:
    """Rows scaled to length one in double precision."""
    m = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: finite components, not all zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def choose_pivots(classes: DataFrame) -> dict[tuple, np.ndarray]:
    """At most about ``MAX_PIVOTS`` unit vectors, keyed by (label, dim)."""
    sizes = classes.groupBy(*GROUP).agg(F.count("*").alias("size"))
    total = sizes.agg(F.sum("size").alias("n")).first()["n"] or 0
    share = F.floor(F.col("size") * F.lit(MAX_PIVOTS) / F.lit(max(total, 1)))
    wanted = F.least(F.floor(F.col("size") / F.lit(CELL_ROWS)), share, F.lit(MAX_CELLS))
    # only groups with a share of two pivots pass: at most MAX_PIVOTS / 2 rows
    plan = sizes.withColumn("k", wanted).where("k >= 2")
    sample = (
        classes.join(F.broadcast(plan), GROUP)
        .where(F.pmod(F.xxhash64("rep"), F.col("size")) < F.col("k"))
        .select(*GROUP, "rep", "vector")
        .collect()
    )
    found: dict[tuple, list] = {}
    for row in sorted(sample, key=lambda r: r["rep"]):
        found.setdefault((row["label"], row["dim"]), []).append(row["vector"])
    return {k: _units(v) for k, v in found.items()}


def assign_cells(classes: DataFrame, pivots: dict, radius: float) -> DataFrame:
    """One row per class and cell: ``home`` in its own, a visitor elsewhere."""
    shared = classes.sparkSession.sparkContext.broadcast(pivots)
    schema = classes.select("label", "dim", "rep", "n", "vector").schema
    schema = schema.add("cell", "integer").add("home", "boolean").add("far", "double")

    def cells(batches):
        for batch in batches:
            parts = [place(g) for _, g in batch.groupby(["label", "dim"], sort=False)]
            if parts:
                yield pd.concat(parts)

    def place(group: pd.DataFrame) -> pd.DataFrame:
        centers = shared.value.get((group["label"].iloc[0], group["dim"].iloc[0]))
        if centers is None or len(centers) < 2:
            return group.assign(cell=0, home=True, far=0.0)
        units = _units(group["vector"])
        square = np.maximum(2.0 - 2.0 * (units @ centers.T), 0.0)
        distance = np.sqrt(square)
        own = square.argmin(axis=1)
        row = np.arange(len(group))
        between = np.sqrt(np.maximum(2.0 - 2.0 * (centers @ centers.T), 0.0))[own]
        triangle = distance - distance[row, own][:, None] <= 2 * radius + SLACK
        plane = square - square[row, own][:, None] <= 2 * between * (radius + SLACK) + SLACK
        visit = triangle & plane
        visit[row, own] = True
        at, cell = np.nonzero(visit)
        out = group.iloc[at].copy()
        out["cell"], out["home"], out["far"] = cell.astype("int32"), cell == own[at], distance[at, cell]
        return out

    return classes.select("label", "dim", "rep", "n", "vector").mapInPandas(cells, schema)


def range_join(classes: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """``(a, b, n)``: forest links (``b`` set) and per class partial link counts (``n`` set)."""
    ship_package(classes.sparkSession)
    radius = float(np.sqrt(max(0.0, 2.0 - 2.0 * min_cosine)))
    placed = materialize(assign_cells(classes, choose_pivots(classes), radius), "metric-cells")
    cell = [*GROUP, "cell"]
    ball = materialize(
        placed.groupBy(*cell).agg(
            F.max(F.when(F.col("home"), F.col("far"))).alias("ball"),
            F.sum(F.col("home").cast("long")).alias("n_home"),
            F.count("*").alias("n_all"),
        ),
        "metric-balls",
    )
    blocks = lambda n: F.greatest(F.ceil(F.col(n) / F.lit(BLOCK_ROWS)), F.lit(1)).cast("int")
    rows = (
        placed.join(ball, cell)
        .where(F.col("home") | (F.col("far") <= F.col("ball") + F.lit(radius + SLACK)))
        .withColumn("n_a", blocks("n_home"))
        .withColumn("n_b", blocks("n_all"))
    )
    spread = F.xxhash64("rep")
    wide = ["label", "dim", "cell", "rep", "n", "vector"]
    inner = rows.where("home").select(
        *wide,
        F.pmod(spread, F.col("n_a")).cast("int").alias("a"),
        F.explode(F.sequence(F.lit(0), F.col("n_b") - 1)).alias("b"),
        F.lit(True).alias("inner"),
    )
    outer = rows.select(
        *wide,
        F.explode(F.sequence(F.lit(0), F.col("n_a") - 1)).alias("a"),
        F.pmod(spread, F.col("n_b")).cast("int").alias("b"),
        F.lit(False).alias("inner"),
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        inside = group["inner"].to_numpy()
        left, right = group[inside], group[~inside]
        if left.empty or right.empty:
            return pd.DataFrame({"a": [], "b": [], "n": []}, dtype="Int64")
        lrep, rrep = left["rep"].to_numpy(), right["rep"].to_numpy()
        lunit, runit = _units(left["vector"]), _units(right["vector"]).T
        weight = right["n"].to_numpy().astype(np.float64)
        counts = np.zeros(len(left))
        # labels over ranks of the ids in this group; links are merged chunk by chunk
        ids = np.unique(np.concatenate([lrep, rrep]))
        at_left, at_right = np.searchsorted(ids, lrep), np.searchsorted(ids, rrep)
        label = np.arange(len(ids))
        for at in range(0, len(left), CHUNK_ROWS):
            part = slice(at, at + CHUNK_ROWS)
            near = lunit[part] @ runit >= min_cosine
            near &= lrep[part, None] != rrep[None, :]
            counts[part] = near @ weight
            i, j = np.nonzero(near)
            label = merge_labels(label, at_left[part][i], at_right[j])
        some = np.nonzero(counts)[0]
        linked = np.nonzero(label != np.arange(len(ids)))[0]
        return pd.DataFrame(
            {
                "a": pd.array(np.concatenate([ids[linked], lrep[some]]), dtype="Int64"),
                "b": pd.array([*ids[label[linked]], *[None] * len(some)], dtype="Int64"),
                "n": pd.array([*[None] * len(linked), *counts[some].astype(np.int64)], dtype="Int64"),
            }
        )

    return (
        inner.union(outer)
        .groupBy(*cell, "a", "b")
        .applyInPandas(compare, "a long, b long, n long")
    )


def near_vectors(
    df: DataFrame,
    min_cosine: float = MIN_COSINE,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``: one row per row of ``df``."""
    rows = df.select(F.col(key).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"))
    rows = rows.withColumn("ok", F.coalesce(ok, F.lit(False)))
    good = rows.where("ok").withColumn("dim", F.size("vector"))
    classes = materialize(
        good.groupBy(*GROUP, "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")),
        "metric-classes",
    )
    found = materialize(range_join(classes, min_cosine), "metric-found")
    labels = materialize(connected_components(found.where("b is not null").select("a", "b")), "metric-labels")
    counts = materialize(
        found.where("n is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links")),
        "metric-counts",
    )
    known = materialize(
        classes.join(counts, "rep", "left")
        .join(labels.withColumnsRenamed({"node": "rep", "label": "smallest"}), "rep", "left")
        .select(
            *GROUP,
            "vector",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
            F.coalesce("smallest", "rep").alias("component_id"),
        ),
        "metric-known",
    )
    joined = good.join(known, [*GROUP, "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not ok").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return joined.union(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and keep decision of every embedding."""
    return near_vectors(read_table(spark, sf_dir, "embeddings"))
