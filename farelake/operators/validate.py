"""Trip and fare validation.

Both steps are row filters; chained after standardization they collapse into
a single ``Filter`` over a single scan. The clock bound (``as_of``) is a
parameter, never ``current_timestamp()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.config import DEFAULT_AS_OF, TripRules
from farelake.constants import NON_NEGATIVE_AMOUNTS
from farelake.functions.columns import all_of, ts_literal_like


def valid_trips(
    standardized: DataFrame, as_of: str = DEFAULT_AS_OF, rules: TripRules = TripRules()
) -> DataFrame:
    """Keep trips that end after they start, start between the lower bound
    and ``as_of`` (both inclusive), and use known zone ids (NULL rejected)."""
    pickup = F.col("tpep_pickup_datetime")
    lo = ts_literal_like(standardized, "tpep_pickup_datetime", rules.min_pickup)
    hi = ts_literal_like(standardized, "tpep_pickup_datetime", as_of)
    return standardized.filter(
        all_of(
            [
                pickup < F.col("tpep_dropoff_datetime"),
                pickup.between(lo, hi),
                F.col("PULocationID").between(rules.min_location, rules.max_location),
                F.col("DOLocationID").between(rules.min_location, rules.max_location),
            ]
        )
    )


def valid_fares(validated: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """Keep trips whose amounts are non-negative, whose distance is positive
    when a fare was charged, with at least one passenger and a payment type in
    range. ``airport_fee`` is deliberately not checked."""
    fare = F.col("fare_amount")
    cbd = F.col("cbd_congestion_fee")
    conditions = [F.col(c) >= 0 for c in NON_NEGATIVE_AMOUNTS]
    conditions += [
        F.when(fare > 0, F.col("trip_distance") > 0).otherwise(F.lit(True)),
        F.col("passenger_count") > 0,
        F.col("payment_type").between(rules.min_payment, rules.max_payment),
        (cbd >= 0) | cbd.isNull(),
    ]
    return validated.filter(all_of(conditions))


def processed_trips(
    raw: DataFrame, as_of: str = DEFAULT_AS_OF, rules: TripRules = TripRules()
) -> DataFrame:
    """Standardize → valid trips → valid fares, as one lazy plan."""
    from farelake.operators.standardize import standardize_trips

    return valid_fares(valid_trips(standardize_trips(raw, rules), as_of, rules), rules)
