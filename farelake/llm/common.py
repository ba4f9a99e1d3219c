"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.session import scratch_path, ship_package
from farelake.sinks.snapshots import materialize
from farelake.sources.tables import read_table

BATCH_BYTES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table."""
    return read_table(spark, sf_dir, "documents")


def text_of(column: str = "text") -> Column:
    """The text, with null read as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, UPPER, UPPER.lower())


def prepare_python(spark: SparkSession) -> None:
    """Before a Python function sees texts: ship the package, bound its batches.

    Batches are bounded by bytes, since a fixed number of rows says nothing
    about the size of texts; a bound that the session sets itself stays.
    """
    ship_package(spark)
    if BATCH_BYTES_KEY not in spark.conf.getAll:
        spark.conf.set(BATCH_BYTES_KEY, str(BATCH_BYTES))


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    An expression used inside a higher-order function may be inlined by the
    optimizer into the lambda and then run once per element; a one-element
    array binds it to a lambda variable instead.
    """
    return F.transform(F.array(value), body)[0]


def occurrences(words: Column, phrase: list[str]) -> Column:
    """Start positions (from 0) where ``phrase`` stands consecutively in ``words``."""
    def starts(ws: Column) -> Column:
        def here(i: Column) -> Column:
            match = F.get(ws, i) == phrase[0]
            for k, word in enumerate(phrase[1:], 1):
                match = match & F.coalesce(F.get(ws, i + k) == word, F.lit(False))
            return match

        return F.when(
            F.size(ws) > 0, F.filter(F.sequence(F.lit(0), F.size(ws) - 1), here)
        ).otherwise(F.array().cast("array<int>"))

    return bind(words, starts)


def clustered(df: DataFrame, key: str, label: str) -> DataFrame:
    """``df`` written to the shared folder in buckets of ``key``, and read back.

    One shuffle; later joins on ``key`` read the buckets and move only their
    other side, so wide rows (texts) travel once however often they are joined.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, f"{label}-buckets")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    column = F.col(f"`{key}`")
    (
        df.repartition(buckets, column)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(name)
    )
    found = spark.table(name)
    # only the folder is needed from here on; the catalog entry goes, the files stay
    spark.sql(f"DROP TABLE {name}")
    return found


def _fold(edges: DataFrame, label: str) -> DataFrame:
    return materialize(edges.where("a <> b").distinct(), label)


def _settled(edges: DataFrame) -> bool:
    """Whether every ``a`` has one ``b``, and no ``b`` is an ``a`` of another edge."""
    roles = edges.select(F.col("a").alias("node"), F.lit(1).alias("ups"), F.lit(0).alias("downs")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    roles = roles.groupBy("node").agg(F.sum("ups").alias("ups"), F.max("downs").alias("downs"))
    return not roles.where("ups > 1 or ups = 1 and downs = 1").limit(1).count()


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph: ``(node, label)``, label = smallest node.

    ``edges`` has the columns ``a`` and ``b`` (same orderable type, no nulls;
    repeats, loops and either direction are fine). Only nodes with an edge to
    another node appear. Alternating large-star and small-star steps: each
    step is one ``min`` per node (combined map-side) and one equi-join; its
    result is written to the shared folder, which cuts the lineage, and the
    per-node minimum is written before the join so that both join inputs are
    plain scans and a node with very many links can be split. It ends as soon
    as all nodes are linked to their smallest one only; nothing more is written
    to confirm that. The driver sees one yes or no per round.
    """
    edges = _fold(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "cc-edges")
    while not _settled(edges):
        # large star: link every larger neighbour to the smallest one
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialize(
            both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "cc-min"
        )
        edges = _fold(
            both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")),
            "cc-edges",
        )
        # small star: link the node and its smaller neighbours to the smallest
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = materialize(down.groupBy("a").agg(F.min("b").alias("m")), "cc-min")
        edges = _fold(
            down.join(low, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select("a", F.col("m").alias("b"))),
            "cc-edges",
        )
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
