"""farelake: a Spark-native trip-records lakehouse.

Raw trip files are standardized, validated and gated by data-quality rules,
mastered dimensions are built (golden records, fuzzy matching with a steward
queue, type-2 history), trips are joined to them into a curated fact table,
marts are aggregated from it and everything is exported as typed, laid-out
tables. Every stage is a ``DataFrame -> DataFrame`` function on public Spark
APIs; the clock and all bounds are parameters.
"""

from farelake.config import DEFAULT_AS_OF, TripRules
from farelake.session import build_session, shared_dir

__all__ = ["DEFAULT_AS_OF", "TripRules", "build_session", "shared_dir"]
