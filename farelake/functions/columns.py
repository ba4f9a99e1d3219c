"""Column-level helpers built only from ``pyspark.sql.functions``.

Everything here stays JVM-side and inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ts_literal(value: str, dtype: T.DataType | None = None) -> Column:
    """A timestamp literal typed like the column it is compared with.

    ``TIMESTAMP_NTZ`` (the default) is zone-free; for a zoned column the
    string is read in the session time zone, as Spark SQL does.
    """
    target = dtype if dtype is not None else T.TimestampNTZType()
    return F.lit(value).cast(target)


def ts_literal_like(df: DataFrame, column: str, value: str) -> Column:
    return ts_literal(value, df.schema[column].dataType)


def to_int(column: Column) -> Column:
    """Integer cast that yields NULL instead of failing on bad input.

    Under ANSI mode a plain ``cast`` raises on overflow or on a malformed
    string; one bad row must not kill a job over the whole landing.
    """
    return column.try_cast(T.IntegerType())


def numeric(df: DataFrame, name: str) -> Column:
    """A column as a number: strings are parsed (NULL when malformed), numbers stay."""
    column = F.col(name)
    return column.try_cast("double") if isinstance(df.schema[name].dataType, T.StringType) else column


def defaulted(df: DataFrame, name: str, default: int, target: str | None = None) -> Column:
    """``default`` for NULL, else the value as a number (cast to ``target``).

    A malformed string or an overflow gives NULL: it is not a missing value,
    so it does not become the default.
    """
    value = numeric(df, name)
    if target is None and not isinstance(df.schema[name].dataType, T.StringType):
        return F.coalesce(value, F.lit(default))
    value = value.try_cast(target) if target else value
    return F.when(F.col(name).isNull(), F.lit(default)).otherwise(value)


def normalize_flag(column: Column) -> Column:
    """``TRIM(UPPER(x))``: 'Y' → 'Y', 'N' → 'N', anything else or NULL → 'U'."""
    cleaned = F.trim(F.upper(column))
    return F.when(cleaned == "Y", "Y").when(cleaned == "N", "N").otherwise("U")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def guarded_denominator(column: Column) -> Column:
    """NULL when the denominator is not positive, so the ratio is skipped by ``avg``."""
    return F.when(column <= 0, F.lit(None)).otherwise(column)


def run_id(as_of: str) -> Column:
    """Run id ``yyyyMMdd_HHmm`` of one run clock."""
    return F.date_format(ts_literal(as_of), "yyyyMMdd_HHmm")
