"""tidepool: lakehouse analytics written as plain PySpark DataFrame / SQL jobs.

Sub-packages:
  sources    - table scans, sinks, schema contracts (A)
  operators  - relational building blocks: filters, joins, aggregates,
               windows, set ops, upserts and change feeds, layout,
               quality checks, policies, profiling (B-G, I, K, M, N)
  functions  - scalar / nested / JSON column helpers and SQL functions (H, P)
  plans      - the analytics queries, the medallion pipeline and the
               registry of named queries with their SQL oracles (J, L)
  streaming  - Structured Streaming ingest, upsert and windowed gold (O)
"""

__version__ = "0.1.0"
