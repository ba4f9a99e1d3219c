"""The standardizing projection of raw trips.

One narrow projection + filter; Catalyst pushes ``VendorID IN (...)`` into
the Parquet scan and the whole step stays in one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.config import TripRules
from farelake.constants import TRIP_COLUMNS, ZERO_DEFAULT_COLUMNS
from farelake.functions.columns import defaulted, normalize_flag, numeric, to_int


def standardize_trips(raw: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """Standardize raw trips into the 20 processed columns, in order.

    * NULL amounts/counts/distance → 0 (P2);
    * ``RatecodeID`` NULL → ``rules.unknown_ratecode`` (P3);
    * ``passenger_count``, ``RatecodeID``, ``payment_type`` → INT, NULL on a
      bad value (P4; ``payment_type`` keeps NULL). Columns that landed as
      strings are read as numbers; a malformed string is NULL, not the default;
    * ``store_and_fwd_flag`` → 'Y' / 'N' / 'U' (P5);
    * only the known vendors are kept (F1).
    """
    exprs = {}
    for name in TRIP_COLUMNS:
        col = F.col(name)
        if name == "passenger_count":
            exprs[name] = defaulted(raw, name, 0, "int")
        elif name == "RatecodeID":
            exprs[name] = defaulted(raw, name, rules.unknown_ratecode, "int")
        elif name == "payment_type":
            exprs[name] = to_int(numeric(raw, name))
        elif name == "store_and_fwd_flag":
            exprs[name] = normalize_flag(col)
        elif name in ZERO_DEFAULT_COLUMNS:
            exprs[name] = defaulted(raw, name, 0)
        else:
            exprs[name] = col
    return raw.filter(F.col("VendorID").isin(*rules.vendor_ids)).select(
        *[expr.alias(name) for name, expr in exprs.items()]
    )
