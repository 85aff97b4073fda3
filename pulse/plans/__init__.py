"""Named queries over the driver's tables (Spark side) and their SQL oracle."""

from pulse.plans.catalog import QUERIES, flagship
from pulse.plans import streams as _streams  # noqa: F401  (registers the stream queries)
from pulse.plans.oracle import ORACLE_SQL

__all__ = ["QUERIES", "ORACLE_SQL", "flagship"]
