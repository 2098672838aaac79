"""tessera: relational, JSON and change-data operators as Spark DataFrame functions.

Modules (every function takes and returns DataFrames or Columns, lazily):

- ``tessera.sources.tables`` / ``tessera.sources.versioned``: scans, series,
  split-to-rows, sinks (insert-select, JSON, clustered write), versioned tables
- ``tessera.functions.text`` / ``tessera.functions.jsonfn``: column functions
- ``tessera.operators.relational``: predicates, joins (skew-safe left join), paging
- ``tessera.operators.reshape``: string_agg, exact percentiles, grouping sets, pivot
- ``tessera.operators.ordering``: distributed row numbers, running sums, lag/lead/ffill
- ``tessera.operators.jsonops``: nested documents, OPENJSON-style shredding
- ``tessera.operators.changes`` / ``history`` / ``edits``: change data, temporal
  tables, rewrites and merges
- ``tessera.operators.quality`` / ``search`` / ``hierarchy`` / ``compression``
- ``tessera.streaming.current_state``: a change log kept as a current-state table
- ``tessera.session``: session defaults, the shared checkpoint folder, sizing
"""

__version__ = "0.1.0"
