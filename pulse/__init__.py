"""Real-time commerce analytics on Spark DataFrames and Structured Streaming.

Sub-packages:
  functions  column expressions (date/hour split, masking, keyword match, bands)
  sources    topic/change-feed readers and writers, date-partitioned tables,
             views that present the driver's tables as log / order / detail records
  operators  parsing, dedup, first-order flags, KPI metrics, joins, reports
  streaming  micro-batch jobs, idempotent upsert sinks, keyed state
  plans      the named queries (Spark side) and their SQL oracle
"""

from pulse.session import configure, get_session, shared_dir

__all__ = ["configure", "get_session", "shared_dir"]
