"""tidewater: warehouse analytics and load patterns as Spark DataFrame jobs.

Sub-packages:
  sources    - reading the warehouse tables, verified loads, change batches, publishing
  functions  - small column helpers (money, safe division, calendar names)
  operators  - reusable DataFrame -> DataFrame operators (joins, ranking,
               rewrites, contracts, dedup, upsert, SCD2, data quality)
  plans      - the registered queries, each paired with an ANSI-SQL oracle
  streaming  - Structured Streaming twins of the incremental loads
"""

__all__ = ["session"]
