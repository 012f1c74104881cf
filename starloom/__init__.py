"""starloom: a warehouse-loading and reconciliation library built on Spark DataFrames.

Layers:
  sources/    scans: watermark extracts, business-date windows, CSV datasets, inline VALUES
  functions/  column expressions: normalisation, row hashes, date keys, keyword flags
  operators/  DataFrame -> DataFrame building blocks: validation, lookups, loads, SCD, snapshots
  plans/      user-level jobs: staging, the two marts, audit, quality checks, reports,
              and the bindings of every operator onto the driver's tables
  streaming/  Structured Streaming runner for micro-batch incremental staging loads
"""

__version__ = "0.1.0"
