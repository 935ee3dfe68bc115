"""rillet: real-time commerce analytics as plain Spark DataFrame functions.

Layers:
  sources/    table readers, test-data adapters, day-partitioned keyed tables
  functions/  column-expression helpers (time, json, text)
  operators/  DataFrame -> DataFrame operators (routing, dedup, joins, aggregates, mutations)
  plans/      composed queries (daily actives, order wide table, dashboard reads)
  streaming/  Structured Streaming jobs that reuse the same operators
"""

__version__ = "0.1.0"
