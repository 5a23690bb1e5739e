"""rainrisk: a Spark-native rainfall monitoring and flood-alert engine.

Layers (each a plain function from DataFrame/Column to DataFrame/Column):

* ``sources``   – raw wide daily tables, landed HTML pages, the 15-minute
  JSON feed, the gazetteer, backfill planning and the table sinks.
* ``functions`` – scalar Column builders (name cleaning, lenient parsing,
  alert bands, climate season, weekday names).
* ``operators`` – joins, windows and aggregations: station → municipality
  matching, rainfall features, the risk grid, data-quality checks.
* ``plans``     – composite bronze → silver → gold plans and the query
  catalogue with its DuckDB oracles.
* ``streaming`` – the 15-minute feed as a Structured Streaming job.
"""

__version__ = "0.1.0"
