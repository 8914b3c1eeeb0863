"""pitchlake: football event analytics written as Spark DataFrame / SQL plans.

Layers:
  sources/    landed feed tables -> Bronze (partitioned Parquet), scans, lake I/O
  functions/  pure Column -> Column helpers (parsing, coercion, labels)
  operators/  Silver projections, Gold tactical metrics, skew-safe running totals
  plans/      serving tables (leaderboards, averages, momentum, shot map), pipeline runs
  streaming/  the stateless Silver step as a Structured Streaming query
"""

from pitchlake.config import Thresholds

__all__ = ["Thresholds"]
