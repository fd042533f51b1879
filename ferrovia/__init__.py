"""ferrovia — transit feed analytics expressed as Spark DataFrame operators.

Layers:
  sources/    feed scans (CSV, realtime JSON), Parquet lake IO, spines
  functions/  column expressions (classifiers, bands, exact decimal metrics)
  operators/  DataFrame -> DataFrame building blocks (quality, flattening,
              dimensions, facts, Gold aggregates, views, merges)
  plans/      batch jobs wiring the operators together, and transit-shaped
              views over the benchmark tables
  streaming/  Structured Streaming entry points (file source + foreachBatch)
"""

from ferrovia.session import get_session, scratch_dir  # noqa: F401
