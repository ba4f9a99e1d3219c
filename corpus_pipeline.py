"""The training-data pipeline: five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it works on
all rows that its predecessor kept. All but the last return the columns of
``documents``. ``run`` writes every stage to the shared folder and reads it
back, which cuts the lineage, so a lost executor costs one stage's tasks.

Every stage takes rows with nulls in any column, empty and very long texts,
repeated rows and further columns (kept by all stages but the last), and gives
an empty result for an empty table. Its docstring says what becomes of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm import mixing, pieces, quality, simhash, templates
from farelake.llm.common import documents
from farelake.sinks.snapshots import materialize
from farelake.sources.tables import read_table


def _recount(df: DataFrame, columns: list[str]) -> DataFrame:
    """``n_chars`` set to the length of the text, where the column exists."""
    if "n_chars" in columns:
        df = df.withColumn("n_chars", F.char_length("text").cast("long"))
    return df.select(*columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that the classifier rejects go.

    A null text is judged like an empty one; repeated rows are judged alike; null
    sources and languages are sites of their own; without labels all rows stay.
    """
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: lines of recurring templates stay in their first document only.

    A null text stays null and blank lines stay; rows with a null id lose nothing;
    rows with one id are one document. A text may become empty; its row stays.
    """
    return _recount(templates.drop_recurring_lines(docs), docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one document of each group of linked fingerprints stays.

    Null and empty texts have fingerprint zero and are a group like any other; of
    repeated rows one stays.
    """
    return simhash.keep_representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents cut and repeated to the target weights of their sources.

    A document without words is never taken; a null source is a source of its own;
    repeated rows are separate documents.
    """
    return _recount(mixing.mix_documents(docs), docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: ids and decoded text digests of every remaining row.

    A null or empty text has the begin and end ids only; repeated rows repeat.
    """
    return pieces.encode_documents(docs, with_outputs=False)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("mix_sources", mix_sources),
    ("encode_pieces", encode_pieces),
]

#: the classifier, the templates, the permutations and the tokenizer have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
