"""Q1–Q6, A5: data-quality rules, the rule report and the publish gate.

All rules of a ruleset are evaluated in **one** aggregate over the batch
(one pass, partial aggregation on the executors, a single row to the driver),
then turned into one report row per rule. A NULL value counts as a violation
of a value rule. A rule whose column is missing reports ``Error``. A batch that is
written anyway is judged by its write (``observed``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from farelake.constants import ERROR, FAILED, PASSED
from farelake.functions.columns import run_id


@dataclass(frozen=True)
class Rule:
    """One rule: ``kind`` is ``in`` / ``max`` / ``min`` / ``complete``."""

    text: str
    column: str
    kind: str
    arg: object = None

    def satisfied(self, col: Column) -> Column:
        if self.kind == "in":
            return col.isin(*self.arg)
        if self.kind == "max":
            return col <= F.lit(self.arg)
        if self.kind == "min":
            return col >= F.lit(self.arg)
        if self.kind == "complete":
            return col.isNotNull()
        raise ValueError(f"unknown rule kind {self.kind}")

    def violation(self, col: Column) -> Column:
        return ~F.coalesce(self.satisfied(col), F.lit(False))


# The processed-batch ruleset, with its rule texts.
PROCESSED_RULES: tuple[Rule, ...] = (
    Rule('ColumnValues "vendorid" in [1, 2, 6, 7]', "vendorid", "in", (1, 2, 6, 7)),
    Rule('ColumnValues "payment_type" <= 6', "payment_type", "max", 6),
    Rule('IsComplete "pulocationid"', "pulocationid", "complete"),
    Rule('IsComplete "dolocationid"', "dolocationid", "complete"),
    Rule('ColumnValues "total_amount" >= 0', "total_amount", "min", 0),
    Rule('ColumnValues "fare_amount" >= 0', "fare_amount", "min", 0),
)


def _resolve(df: DataFrame, name: str) -> str | None:
    lowered = {c.lower(): c for c in df.columns}
    return lowered.get(name.lower())


def rule_counts(batch: DataFrame, rules: tuple[Rule, ...] = PROCESSED_RULES) -> list[Column]:
    """The aggregates of a ruleset: evaluated rows, and violations per rule with a column."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, rule in enumerate(rules):
        column = _resolve(batch, rule.column)
        if column is not None:
            aggs.append(F.count_if(rule.violation(F.col(column))).alias(f"_f{i}"))
    return aggs


def dq_report(batch: DataFrame, rules: tuple[Rule, ...] = PROCESSED_RULES) -> DataFrame:
    """Q4: ``Rule, Outcome, FailureReason, failed_rows, evaluated_rows``."""
    return report_rows(batch.agg(*rule_counts(batch, rules)), rules)


def report_rows(counts: DataFrame, rules: tuple[Rule, ...] = PROCESSED_RULES) -> DataFrame:
    """One report row per rule from the one row of counts; a rule without a count is ``Error``."""
    rows = []
    for i, rule in enumerate(rules):
        if f"_f{i}" not in counts.columns:
            rows.append(
                F.struct(
                    F.lit(rule.text).alias("Rule"),
                    F.lit(ERROR).alias("Outcome"),
                    F.lit(f"Column not found: {rule.column}").alias("FailureReason"),
                    F.lit(None).cast("bigint").alias("failed_rows"),
                    F.col("_n").alias("evaluated_rows"),
                )
            )
            continue
        failed = F.col(f"_f{i}")
        rows.append(
            F.struct(
                F.lit(rule.text).alias("Rule"),
                F.when(failed > 0, F.lit(FAILED)).otherwise(F.lit(PASSED)).alias("Outcome"),
                F.when(
                    failed > 0,
                    F.concat(failed.cast("string"), F.lit(" of "), F.col("_n").cast("string"), F.lit(" rows failed")),
                ).alias("FailureReason"),
                failed.alias("failed_rows"),
                F.col("_n").alias("evaluated_rows"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))


def gate_decision(report: DataFrame, block_on_error: bool = True) -> DataFrame:
    """Q5: one row ``decision, failed_rules, error_rules, batch_rows``.

    ``PUBLISH`` only when no rule failed (and, by default, none errored);
    otherwise ``QUARANTINE``: the batch is all-or-nothing.
    """
    failed = F.count_if(F.col("Outcome") == FAILED)
    errored = F.count_if(F.col("Outcome") == ERROR)
    blocking = failed + errored if block_on_error else failed
    return report.agg(
        F.when(blocking == 0, F.lit("PUBLISH")).otherwise(F.lit("QUARANTINE")).alias("decision"),
        failed.alias("failed_rules"),
        errored.alias("error_rules"),
        F.max("evaluated_rows").alias("batch_rows"),
    )


def quarantine_rows(batch: DataFrame, as_of: str) -> DataFrame:
    """K2: the batch tagged with the run id ``yyyyMMdd_HHmm`` of ``as_of``."""
    return batch.withColumn("quarantine_run_id", run_id(as_of))


class DataQualityError(RuntimeError):
    """The batch failed the DQ gate and was quarantined."""


@dataclass
class GateOutcome:
    decision: str
    report: list
    rows: int


def _outcome(report: list, block_on_error: bool) -> GateOutcome:
    blocking = {FAILED, ERROR} if block_on_error else {FAILED}
    failed = [r for r in report if r["Outcome"] in blocking]
    rows = report[0]["evaluated_rows"] if report else 0
    return GateOutcome("QUARANTINE" if failed else "PUBLISH", report, rows)


def evaluate_gate(batch: DataFrame, rules: tuple[Rule, ...] = PROCESSED_RULES, block_on_error: bool = True) -> GateOutcome:
    """Run the ruleset once and bring the (tiny) report to the driver."""
    return _outcome(dq_report(batch, rules).collect(), block_on_error)


def observed(
    batch: DataFrame, rules: tuple[Rule, ...] = PROCESSED_RULES, block_on_error: bool = True
) -> tuple[DataFrame, Callable[[], GateOutcome]]:
    """Q5 in one pass: ``batch`` whose next write counts the rules, and the outcome to ask for after it.

    The counts come from the writing tasks themselves (an ``Observation``), so
    neither the source nor the written files are read a second time.
    """
    watch = Observation()
    counts = rule_counts(batch, rules)
    watched = batch.observe(watch, *counts)

    def outcome() -> GateOutcome:
        found = watch.get
        return _outcome(counted_report(batch.sparkSession, found, rules).collect(), block_on_error)

    return watched, outcome


def counted_report(spark: SparkSession, counts: dict[str, int], rules: tuple[Rule, ...] = PROCESSED_RULES) -> DataFrame:
    """The report of counts that an ``Observation`` collected."""
    row = spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()])
    return report_rows(row, rules)


def result_rows(spark: SparkSession, outcome: GateOutcome) -> DataFrame:
    """Q6: the report rows of one gate with its decision."""
    return spark.createDataFrame(
        [(*tuple(r), outcome.decision) for r in outcome.report],
        "Rule string, Outcome string, FailureReason string, failed_rows bigint, evaluated_rows bigint, decision string",
    )
