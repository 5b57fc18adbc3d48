"""carelake: claims, appeals and assistant-trace analytics as Spark jobs.

Subpackages
-----------
sources    driver tables, the six domain tables derived from them, sinks
functions  Column-expression helpers (keyed derivation, scalars, fixed values)
operators  dashboard, audits, lookups, measures, responses, evaluation
plans      session settings, the query registry and the DuckDB oracle text
streaming  Structured Streaming variants (live trace scoring)
"""

__all__ = ["sources", "functions", "operators", "plans", "streaming"]
