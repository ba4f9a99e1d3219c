"""Run parameters: the clock and the bounds of every rule.

Nothing in the library reads the wall clock. A run passes one ``as_of``
timestamp (``'YYYY-MM-DD HH:MM:SS'``) and every audit column, time bound and
run id is derived from it, so a re-run is reproducible and all steps of one
run agree on "now".
"""

from __future__ import annotations

from dataclasses import dataclass

DEFAULT_AS_OF = "2026-01-01 00:00:00"
DEFAULT_JOB = "farelake"


@dataclass(frozen=True)
class TripRules:
    """Bounds applied by standardization and validation.

    The defaults are the values the trip pipeline is specified with.
    """

    vendor_ids: tuple[int, ...] = (1, 2, 6, 7)
    min_pickup: str = "2000-01-01 00:00:00"
    min_location: int = 1
    max_location: int = 263
    min_payment: int = 0
    max_payment: int = 6
    unknown_ratecode: int = 99


@dataclass(frozen=True)
class MatchRules:
    """Confidence bands of vendor-name matching (scores are 0..100)."""

    auto_above: float = 95.0  # strictly greater → SYSTEM_AUTO_APPROVED
    review_low: float = 80.0  # review_low..auto_above inclusive → STEWARD_REVIEW
