"""hebdo — weekly event-count surveillance analytics on Spark DataFrames.

Layout:
  functions/  column-expression helpers (calendar arithmetic, cleaning casts)
  sources/    readers, analogue views over the base tables, sinks
  operators/  DataFrame -> DataFrame operators (aggregates, star schema,
              joins, weekly series, statistics, forecasting, reports)
  plans/      named queries over the base tables and their SQL oracles
  streaming/  incremental weekly refresh with Structured Streaming
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming"]
