"""Fixed values.

These values must equal the specification of the trip pipeline for results
to match: dictionary rows, audit labels, route names, status names, rule
texts and warehouse column contracts. They are stated plainly, in their
natural order, in one place.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Vendor dictionary (vendorid, vendor_name)
# ---------------------------------------------------------------------------
VENDORS: list[tuple[int, str]] = [
    (1, "Creative Mobile Technologies, LLC"),
    (2, "Curb Mobility, LLC"),
    (6, "Myle Technologies Inc"),
    (7, "Helix"),
]

# ---------------------------------------------------------------------------
# Rate-code dictionary (ratecodeid, ratecode_desc)
# ---------------------------------------------------------------------------
RATECODES: list[tuple[int, str]] = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
]

# ---------------------------------------------------------------------------
# Audit labels, matching routes and steward statuses
# ---------------------------------------------------------------------------
SYSTEM_AUTO_APPROVED = "SYSTEM_AUTO_APPROVED"
STEWARD_REVIEW = "STEWARD_REVIEW"
MANUAL_RESOLUTION = "MANUAL_RESOLUTION"
STEWARD_APPROVED = "STEWARD_APPROVED"

PENDING_REVIEW = "PENDING_REVIEW"
APPROVED = "APPROVED"
PROCESSED = "PROCESSED"

# ---------------------------------------------------------------------------
# DQ outcomes
# ---------------------------------------------------------------------------
PASSED = "Passed"
FAILED = "Failed"
ERROR = "Error"

# ---------------------------------------------------------------------------
# The 20 raw/processed trip columns, in order
# ---------------------------------------------------------------------------
TRIP_COLUMNS: list[str] = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "store_and_fwd_flag",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
    "cbd_congestion_fee",
]

# Columns whose NULL becomes 0 in standardization.
ZERO_DEFAULT_COLUMNS: list[str] = [
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
    "cbd_congestion_fee",
]

# Amounts that must be non-negative in fare validation (airport_fee is not).
NON_NEGATIVE_AMOUNTS: list[str] = [
    "fare_amount",
    "total_amount",
    "tip_amount",
    "extra",
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
]

# ---------------------------------------------------------------------------
# Curated fact columns, in order
# ---------------------------------------------------------------------------
TRIP_DETAIL_COLUMNS: list[str] = [
    "vendorid",
    "vendor_name",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "pulocationid",
    "pickup_zone",
    "pickup_borough",
    "dolocationid",
    "dropoff_zone",
    "dropoff_borough",
    "passenger_count",
    "trip_distance",
    "ratecodeid",
    "ratecode_desc",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
    "cbd_congestion_fee",
]

AUDIT_COLUMNS: list[str] = [
    "updated_by",
    "approved_by",
    "effective_from",
    "effective_to",
    "is_current_flag",
    "version",
]
