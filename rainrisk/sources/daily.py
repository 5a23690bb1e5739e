"""Raw wide daily tables → bronze daily fact.

A raw table has one row per (station, month) and one text column per day
``01``..``31``. Landed raw data is Parquet partitioned by
``mesorregiao_id`` / ``ano_ref`` (one directory per region and year, the unit
the source publishes), so "load one year" is partition pruning, not a loop
over files. Files named the legacy way ``<Region>_<yyyy>.parquet`` are read
too: their expected year comes from the file name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainrisk.functions.parse import (  # noqa: F401 - year_in_file_name re-exported
    day_of_month_start,
    parse_decimal_comma,
    pt_month_start,
    year_in_file_name,
    year_in_text,
)
from rainrisk.sources.sinks import rebalanced

# --- fixed values (must equal the reference's raw layout) --------------------
COL_CODE, COL_NAME, COL_MONTH_YEAR = "Código", "Posto", "Mês/Ano"
MANDATORY = [COL_CODE, COL_NAME, COL_MONTH_YEAR]
DAY_COLUMNS = [f"{d:02d}" for d in range(1, 32)]
REGION, YEAR_TAG = "mesorregiao_id", "ano_ref"
# -----------------------------------------------------------------------------

EXPECTED_YEAR = "_expected_year"
BRONZE_COLUMNS = ["codigo_posto", "nome_posto", "data", "precipitacao", "mesorregiao_id"]


class MissingColumns(ValueError):
    """Raised when a raw table lacks a mandatory column."""


def land_raw_wide(wide: DataFrame, path: str) -> None:
    """Write raw wide rows, one directory per (region, year).

    Dynamic partition overwrite replaces only the directories present in
    ``wide``; a (region, year) with no new rows is left untouched.
    """
    (rebalanced(wide, REGION, YEAR_TAG).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(REGION, YEAR_TAG).parquet(path))


def read_raw_wide(spark: SparkSession, path: str, year: int | None = None,
                  legacy_glob: bool = False) -> DataFrame:
    """One scan over all raw files (or one year), with the expected year.

    Hive layout: the year is the ``ano_ref`` directory, pruned when ``year``
    is given. Legacy layout (``legacy_glob=True``): flat files
    ``<Region>_<yyyy>.parquet`` selected by a file-name glob; the expected
    year is read from each file's name.
    """
    if legacy_glob:
        glob = f"*_{year}.parquet" if year is not None else "*.parquet"
        df = (spark.read.option("pathGlobFilter", glob)
              .option("recursiveFileLookup", "false").parquet(path))
        return df.withColumn(EXPECTED_YEAR, year_in_file_name(F.col("_metadata.file_name")))
    df = spark.read.parquet(path)
    if year is not None:
        df = df.where(F.col(YEAR_TAG) == year)
    return df.withColumn(EXPECTED_YEAR, F.col(YEAR_TAG).cast("bigint"))


def normalise_header(wide: DataFrame) -> DataFrame:
    """Trim header names, require the mandatory ones, and take the
    second-last column as the region when it is not named."""
    wide = wide.toDF(*[c.strip() for c in wide.columns])
    missing = [c for c in MANDATORY if c not in wide.columns]
    if missing:
        raise MissingColumns(f"mandatory columns missing: {missing}")
    if REGION not in wide.columns:
        data_cols = [c for c in wide.columns if c != EXPECTED_YEAR]
        wide = wide.withColumnRenamed(data_cols[-2], REGION)
    return wide


def guard_page_year(wide: DataFrame, page_cols=(REGION, YEAR_TAG),
                    expected: str = YEAR_TAG) -> DataFrame:
    """Year guard of one extracted page.

    The year of each row is read from ``Mês/Ano`` (``/yyyy``). A page where no
    year can be read, or where the expected year does not occur, is dropped
    whole; otherwise only rows of the expected year stay. The per-page flags
    are an aggregate (combined map-side) joined back on the page key, so a
    page that holds a third of all rows is still spread over many tasks.
    """
    yr = year_in_text(F.col(COL_MONTH_YEAR))
    tagged = wide.withColumn("_row_year", yr)
    keys = list(page_cols)
    flags = (tagged.groupBy(*[F.col(k).alias(f"_page_{k}") for k in keys])
             .agg(F.max((F.col("_row_year") == F.col(expected).cast("bigint"))
                        .cast("int")).alias("_has_expected")))
    # null-safe: a page whose region is unknown is still one page
    on = [tagged[k].eqNullSafe(flags[f"_page_{k}"]) for k in keys]
    return (tagged.join(flags, on, "left").drop(*[f"_page_{k}" for k in keys])
            .where((F.col("_has_expected") == 1)
                   & (F.col("_row_year") == F.col(expected).cast("bigint")))
            .drop("_row_year", "_has_expected"))


def unpivot_days(wide: DataFrame, ids: list[str], days: list[str],
                 name: str = "dia", value: str = "chuva") -> DataFrame:
    """Day columns → (dia, day number, cell) rows, empty cells kept.

    Written as ``posexplode(array(...))`` (a Generate) rather than
    ``DataFrame.unpivot`` (an Expand): with 31 value columns Spark 4.1's
    Expand code generation emits a method that does not compile and the
    stage silently falls back to the interpreted path; structs in the array
    make one that is too long for the JVM to compile. The day number is looked
    up by position, so nothing is parsed per cell for it.
    """
    long = wide.select(*ids, F.posexplode(F.array(*[F.col(d).cast("string") for d in days])).alias("_day_at", value))

    def day(values: list):
        return F.get(F.array(*[F.lit(x) for x in values]), F.col("_day_at"))

    return long.select(*ids, day(days).alias(name), day([int(d) for d in days]).alias("_day_no"), value)


def shape_daily(wide: DataFrame, absent: str | None = None) -> DataFrame:
    """Raw wide rows → bronze long rows.

    Unpivots the day columns that exist (empty cells kept, as NULL rain),
    parses rain text and the ``'jan/2025'`` + day date, drops impossible
    dates, and keeps only rows of the expected year when one is known. Cells
    that hold ``absent`` come from a file without that day's column: no rows.
    """
    wide = normalise_header(wide)
    days = [c for c in DAY_COLUMNS if c in wide.columns]
    ids = [COL_CODE, COL_NAME, REGION]
    if EXPECTED_YEAR not in wide.columns and YEAR_TAG in wide.columns:
        wide = wide.withColumn(EXPECTED_YEAR, F.col(YEAR_TAG).cast("bigint"))
    if EXPECTED_YEAR in wide.columns:
        ids.append(EXPECTED_YEAR)
    # month and year are the same for the 31 cells of a row: parse them once
    wide = wide.withColumn("_first", pt_month_start(F.col(COL_MONTH_YEAR)))
    long = unpivot_days(wide, ids + ["_first"], days)
    if absent is not None:
        long = long.where(F.col("chuva").isNull() | (F.col("chuva") != absent))
    data = day_of_month_start(F.col("_first"), F.col("_day_no"))
    out = long.select(
        F.col(COL_CODE).cast("bigint").alias("codigo_posto"),
        F.col(COL_NAME).cast("string").alias("nome_posto"),
        data.alias("data"),
        parse_decimal_comma(F.col("chuva")).alias("precipitacao"),
        F.col(REGION).alias("mesorregiao_id"),
        *([F.col(EXPECTED_YEAR)] if EXPECTED_YEAR in ids else []))
    out = out.where(F.col("data").isNotNull())
    if EXPECTED_YEAR in ids:
        out = out.where(F.col(EXPECTED_YEAR).isNull()
                        | (F.year("data") == F.col(EXPECTED_YEAR)))
    return out.select(*BRONZE_COLUMNS)


def numeric_code_rows(df: DataFrame, code_col: str = COL_CODE) -> DataFrame:
    """Drop rows whose station code is not a number (footer rows). Codes
    follow the page's number format: ``1.234`` is 1234."""
    from rainrisk.functions.parse import parse_html_number
    code = parse_html_number(F.col(code_col)).try_cast("bigint")
    return df.where(code.isNotNull()).withColumn(code_col, code)


# ---- bronze sinks -------------------------------------------------------------
PARTITION_COLS = ["ano", "mesorregiao_id"]


def bronze_schema() -> str:
    return ("codigo_posto bigint, nome_posto string, data date, precipitacao double, "
            "ano int, mesorregiao_id int")


def replace_bronze_partitions(long: DataFrame, path: str) -> None:
    """S9 + S10 (with D1): create on first write, then replace only the
    (year, region) partitions that receive rows; others stay as they are.

    A partition that gets no new rows is not touched, so an empty or
    rejected file can never wipe a year. Each partition is replaced as a
    whole by the commit protocol, not by a separate delete and insert.
    Rows are dealt out by partition first (AQE sizes the shares by bytes):
    one file for a small (year, region), several writers for a hot one.
    """
    (rebalanced(long.withColumn("ano", F.year("data")), *PARTITION_COLS)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*PARTITION_COLS).parquet(path))


def read_bronze(spark: SparkSession, path: str, year: int | None = None,
                before_year: int | None = None, from_year: int | None = None,
                years: list[int] | None = None) -> DataFrame:
    """Bronze rows; ``year`` / ``before_year`` / ``from_year`` / ``years`` become partition
    filters on ``ano`` (directories outside them are not listed or read)."""
    df = spark.read.schema(bronze_schema()).parquet(path)
    if year is not None:
        df = df.where(F.col("ano") == year)
    if before_year is not None:
        df = df.where(F.col("ano") < before_year)
    if from_year is not None:
        df = df.where(F.col("ano") >= from_year)
    if years is not None:
        df = df.where(F.col("ano").isin(years))
    return df.select(*BRONZE_COLUMNS)


def empty_like(df: DataFrame) -> DataFrame:
    """The frame's schema with no rows (``LIMIT 0``)."""
    return df.limit(0)


def read_raw_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Raw tables kept as CSV with a header row (all text unless a schema
    is given), with the file each row came from for per-file checks."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", False)
    df = reader.csv(path)
    return df.withColumn("_file", F.col("_metadata.file_name"))
