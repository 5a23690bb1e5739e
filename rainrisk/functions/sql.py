"""The name cleaner as SQL functions, for ``spark.sql`` users (D-u4).

The reference's cleaner is a SQL macro. Spark 4 SQL functions with a SQL
body are inlined by the analyzer, so they run as ordinary expressions (no
Python, no UDF boundary). The bodies use the same fixed values as the
Column builders in ``functions.text``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from rainrisk.functions.text import ACCENTED_CAPITALS, PLAIN_CAPITALS


def register_sql_functions(spark: SparkSession) -> None:
    """Define ``upper_trim(x)`` and ``clean_string(x)`` as temporary SQL functions."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION upper_trim(x STRING) RETURNS STRING "
              "RETURN upper(trim(translate(x, 'ß', 'ẞ')))")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION clean_string(x STRING) RETURNS STRING "
              f"RETURN translate(upper_trim(x), '{ACCENTED_CAPITALS}', '{PLAIN_CAPITALS}')")
