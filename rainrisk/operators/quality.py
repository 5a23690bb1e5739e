"""Data-quality checks as ordinary queries.

Each check reports how many rows (or groups) fail; zero means pass. Not-null
and accepted-value checks of one table share a single scan (one aggregate
with a counter per check). Uniqueness is a grouped count, combined map-side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainrisk.functions.parse import year_in_text

REPORT_COLUMNS = ["table_name", "check_name", "column_name", "failing_rows"]


def _report(df: DataFrame, table: str, checks: list[tuple[str, str, F.Column]]) -> DataFrame:
    """checks: (check_name, column_name, failing-row predicate) → one row each."""
    counts = df.agg(*[F.count_if(pred).alias(f"c{i}") for i, (_, _, pred) in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("check_name"),
                              F.lit(col).alias("column_name"),
                              F.col(f"c{i}").cast("bigint").alias("failing_rows"))
                     for i, (name, col, _) in enumerate(checks)])
    return counts.select(F.inline(rows))


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Q1."""
    return _report(df, table, [("not_null", c, F.col(c).isNull()) for c in columns])


def accepted_values(df: DataFrame, table: str, rules: dict[str, list]) -> DataFrame:
    """Q3: values outside the list fail; NULL passes (as the generic test)."""
    return _report(df, table, [("accepted_values", c, F.col(c).isNotNull() & ~F.col(c).isin(*v))
                               for c, v in rules.items()])


def duplicate_groups(df: DataFrame, columns: list[str]) -> DataFrame:
    """A5: key groups that occur more than once."""
    return df.groupBy(*columns).count().where(F.col("count") > 1)


def unique_combination(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Q2: number of key groups with more than one row."""
    failing = duplicate_groups(df, columns).agg(F.count(F.lit(1)).alias("n"))
    return failing.select(F.lit(table).alias("table_name"),
                          F.lit("unique_combination").alias("check_name"),
                          F.lit(",".join(columns)).alias("column_name"),
                          F.col("n").cast("bigint").alias("failing_rows"))


def union_reports(*reports: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), reports)


# ---- raw file integrity ---------------------------------------------------------
STATUS_OK = "ok"
STATUS_NO_NAME_YEAR = "no_year_in_name"
STATUS_NO_VALUES = "no_valid_values"
STATUS_INCONSISTENT = "inconsistent"
STATUS_UNREADABLE = "unreadable_or_empty"
STATUS_SUPERSEDED = "superseded"  # another file of its unit was written later


class MissingYearColumn(ValueError):
    """Q4: the raw data has no column to read its year from."""


def unit_integrity(raw: DataFrame, unit_cols: list[str], expected: F.Column,
                   year_col: str | None = None, month_year_col: str = "Mês/Ano") -> DataFrame:
    """Q4 per raw unit (a file, or a region-year directory).

    The year a unit claims (``expected``, from its name or directory) must
    be the single year its rows hold: the ``year_col`` column when the raw
    data has one, else the years written in ``Mês/Ano``. Per unit only the
    row count, the min/max year and the count of years found are kept, so a
    unit of any size is one small aggregate row.
    """
    if year_col and year_col in raw.columns:
        yr = F.col(year_col).try_cast("bigint")
    elif month_year_col in raw.columns:
        yr = year_in_text(F.col(month_year_col))
    else:
        raise MissingYearColumn(f"neither {year_col!r} nor {month_year_col!r} present")
    per = (raw.select(*unit_cols, expected.cast("bigint").alias("_exp"), yr.alias("_y"))
           .groupBy(*unit_cols)
           .agg(F.count(F.lit(1)).alias("n_rows"), F.first("_exp", True).alias("expected_year"),
                F.min("_y").alias("year_min"), F.max("_y").alias("year_max"),
                F.count("_y").alias("_n_years")))
    status = (F.when(F.col("expected_year").isNull(), STATUS_NO_NAME_YEAR)
              .when(F.col("_n_years") == 0, STATUS_NO_VALUES)
              .when((F.col("year_min") != F.col("year_max"))
                    | (F.col("year_min") != F.col("expected_year")), STATUS_INCONSISTENT)
              .otherwise(STATUS_OK))
    return per.select(*unit_cols, "expected_year", "n_rows", "year_min", "year_max",
                      status.alias("status"))


def integrity_summary(units: DataFrame) -> DataFrame:
    """Q5/A4: units per status, plus totals (ok / all)."""
    return units.groupBy("status").agg(F.count(F.lit(1)).alias("n_units"))


def assert_integrity(units: DataFrame) -> None:
    """Fail the run when any unit is not ok (what the runbook asks for); a file
    that a later one replaces is no failure."""
    bad = units.where(~F.col("status").isin(STATUS_OK, STATUS_SUPERSEDED))
    n = bad.count()
    if n:
        raise ValueError(f"raw integrity failed for {n} units, e.g. {bad.limit(3).collect()}")
