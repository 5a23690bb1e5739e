"""End-to-end flows (E1 daily load, E3 silver → gold), each a few Spark jobs
that hand over through written tables in shared storage.

Written tables are the lineage cuts: silver is written once and gold reads
it back, so a lost executor late in the gold job recomputes from silver's
files, not from the raw pages.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rainrisk.operators import grid, match, quality
from rainrisk.plans import medallion
from rainrisk.session import scratch_path
from rainrisk.sources import daily, sinks
from rainrisk.sources.backfill import backfill_plan
from rainrisk.sources.raw_files import RawFiles


def pages_to_fetch(spark: SparkSession, bronze_path: str, as_of: dt.date) -> DataFrame:
    """E1 plan step (S14/S15): (region, year) pages still missing."""
    sinks.ensure_table(spark, bronze_path, daily.bronze_schema(), daily.PARTITION_COLS)
    # the landed (region, year) units are the partition values: reading only
    # partition columns touches no data pages
    units = (spark.read.schema(daily.bronze_schema()).parquet(bronze_path)
             .where(F.col("mesorregiao_id").isNotNull())
             .select("mesorregiao_id", "ano").distinct())
    return backfill_plan(units, as_of)


def daily_load(spark: SparkSession, raw_path: str, bronze_path: str,
               year: int | None = None, raise_on_failure: bool = True) -> DataFrame:
    """E1 load step: validate the landed raw pages (Q4), shape them
    and replace the (year, region) partitions they cover (S10/S17).

    Returns the per-unit integrity report.
    """
    raw = daily.read_raw_wide(spark, raw_path, year=year)
    units = quality.unit_integrity(raw, [daily.REGION, daily.YEAR_TAG],
                                   raw[daily.YEAR_TAG])
    if raise_on_failure:
        quality.assert_integrity(units)
    long = daily.shape_daily(daily.guard_page_year(daily.normalise_header(raw)))
    sinks.ensure_table(spark, bronze_path, daily.bronze_schema(), daily.PARTITION_COLS)
    daily.replace_bronze_partitions(long, bronze_path)
    return units


def bucket_bronze(spark: SparkSession, bronze_path: str, table: str, table_path: str,
                  buckets: int) -> DataFrame:
    """Store bronze bucketed by station and sorted by date: silver's mapping
    join and windows then read it without shuffling the fact at all."""
    return sinks.save_bucketed(daily.read_bronze(spark, bronze_path), table, table_path,
                               "codigo_posto", buckets, sort_by=["codigo_posto", "data"])


def build_silver_gold(spark: SparkSession, bronze_path: str, municipalities: DataFrame,
                      silver_path: str, gold_path: str,
                      bronze: DataFrame | None = None) -> DataFrame:
    """Rebuild silver (partitioned by year) and gold from it; returns the
    served alerts (read from the written gold table). ``bronze`` may be the
    bucketed table from ``bucket_bronze`` instead of the plain path."""
    bronze = bronze if bronze is not None else daily.read_bronze(spark, bronze_path)
    silver = medallion.silver_rainfall(bronze, municipalities)
    sinks.rebuild_table(silver, silver_path, partition_by=["ano"])
    gold = grid.gold_grid_risk(spark.read.parquet(silver_path))
    sinks.rebuild_table(gold, gold_path)
    return grid.alerts(spark.read.parquet(gold_path))


def _fingerprint() -> Column:
    """Of a listing's files."""
    return F.coalesce(F.sum(F.xxhash64("path", "length", "written").cast("decimal(38,0)")), F.lit(0)).cast("string")


def _version(spark: SparkSession, path: str, year: int) -> str:
    """A fingerprint of a table's files of the years before ``year``."""
    return sinks.partition_files(spark, path).where(F.col("ano") < year).agg(_fingerprint()).first()[0]


def station_years(spark: SparkSession, bronze_path: str, state_path: str) -> tuple[DataFrame, DataFrame]:
    """What matching and gold need of every (station, year), kept between
    runs: (codigo_posto, ano, data, precipitacao), the latest reading, and
    (codigo_posto, nome_posto, ano), the names.

    Each year is kept under the fingerprint of its bronze files; only years
    whose files changed are read and rewritten. A maximum of maxima is the
    maximum, so gold from these rows is gold from all readings. The fingerprints
    are written last: a run that stops before does the same years again.
    """
    base = f"{state_path.rstrip('/')}/station-years"
    now = sinks.partition_files(spark, bronze_path).where("ano is not null").groupBy("ano").agg(_fingerprint().alias("version"))
    now = {r["ano"]: r["version"] for r in now.collect()}  # years on record
    known = {}
    if sinks.path_exists(spark, f"{base}/_VERSIONS"):
        known = {r["ano"]: r["version"] for r in spark.read.schema("ano int, version string").parquet(f"{base}/_VERSIONS").collect()}
    stale = sorted(y for y, v in now.items() if known.get(y) != v)
    if stale:
        rows = daily.read_bronze(spark, bronze_path, years=stale).withColumn("ano", F.year("data"))
        latest = rows.groupBy("codigo_posto", "ano").agg(F.max(F.struct("data", "precipitacao")).alias("s")) \
            .select("codigo_posto", "s.data", "s.precipitacao", "ano")
        names = rows.select("codigo_posto", "nome_posto", "ano").distinct()
        for name, df in (("latest", latest), ("names", names)):
            (sinks.rebalanced(df, "ano").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("ano").parquet(f"{base}/{name}"))
        spark.createDataFrame(sorted(now.items()), "ano int, version string") \
            .write.mode("overwrite").parquet(f"{base}/_VERSIONS")
    years = F.col("ano").isin(sorted(now))  # a year that bronze no longer has does not count
    latest = spark.read.schema("codigo_posto bigint, data date, precipitacao double, ano int").parquet(f"{base}/latest")
    names = spark.read.schema("codigo_posto bigint, nome_posto string, ano int").parquet(f"{base}/names")
    return latest.where(years), names.where(years)


def year_start_state(spark: SparkSession, bronze_path: str, state_path: str,
                     year: int) -> tuple[DataFrame, DataFrame]:
    """Each station's state at the start of ``year`` (carry number and last
    readings), computed from the earlier years and stored: while the current
    year is reloaded day after day, this state does not change. The state is
    kept under a fingerprint of the earlier years' files; when any of them is
    reloaded it is computed anew.
    """
    from rainrisk.operators import features

    base = f"{state_path.rstrip('/')}/ano={year}"
    version = _version(spark, bronze_path, year)
    known = sinks.path_exists(spark, f"{base}/_READY") and sinks.path_exists(spark, f"{base}/stations") and \
        spark.read.schema("version string").parquet(f"{base}/_READY").where(F.col("version") == version).count() > 0
    if not known:
        history = daily.read_bronze(spark, bronze_path, before_year=year)
        features.station_state(history).write.mode("overwrite").parquet(f"{base}/stations")
        spark.createDataFrame([(version,)], "version string").write.mode("overwrite").parquet(f"{base}/_READY")
    return features.carried(spark.read.parquet(f"{base}/stations"))


def first_stale_year(spark: SparkSession, bronze_path: str, silver_path: str, year: int) -> int:
    """The earliest year whose bronze files were written after its silver
    files (or that silver lacks), at most ``year``. Listings only."""
    b = sinks.partition_files(spark, bronze_path).groupBy("ano").agg(F.max("written").alias("b"))
    s = sinks.partition_files(spark, silver_path).groupBy(F.col("ano").alias("sa")).agg(F.min("written").alias("s"))
    stale = b.join(s, F.col("ano") == F.col("sa"), "left").where(F.col("s").isNull() | (F.col("b") >= F.col("s")))
    first = stale.agg(F.min("ano")).first()[0]
    return year if first is None else min(year, first)


MAPPING = ["municipio_inferido", "latitude", "longitude", "tipo_match"]


def _changed_matches(was: DataFrame, now: DataFrame) -> DataFrame:
    """Rows of ``now`` (codes as ``_c``, matches as ``_…``) that ``was`` has otherwise, or not at all."""
    now = now.select(F.col("codigo_posto").alias("_c"), *[F.col(c).alias(f"_{c}") for c in MAPPING])
    same = F.lit(True)
    for c in MAPPING:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    joined = now.join(was.withColumn("_known", F.lit(True)), F.col("codigo_posto") == F.col("_c"), "left")
    return joined.where(F.col("_known").isNull() | ~same).select(now.columns).distinct()


def _rematch(spark: SparkSession, silver_path: str, changed: DataFrame, years: list[int]) -> None:
    """Carry changed matches into silver's ``years``: features are kept, other years not read."""
    path = scratch_path(spark, "rematch")
    silver = spark.read.parquet(silver_path).where(F.col("ano").isin(years))
    rows = silver.join(changed, F.col("codigo_posto") == F.col("_c"), "left")
    hit = F.col("_c").isNotNull()
    rows.select(*[F.when(hit, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in MAPPING else F.col(c)
                  for c in silver.columns]).write.parquet(f"{path}/silver")
    (sinks.rebalanced(spark.read.parquet(f"{path}/silver"), "ano").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("ano").parquet(silver_path))


def _silver_version(spark: SparkSession, silver_path: str) -> str:
    return sinks.partition_files(spark, silver_path).agg(_fingerprint()).first()[0]


def _kept_mapping(spark: SparkSession, state_path: str, silver_path: str) -> DataFrame | None:
    """The station mapping that silver was last refreshed with; None where
    there is none or something else has written silver since."""
    base = f"{state_path.rstrip('/')}/mapping"
    if not sinks.path_exists(spark, f"{base}/_VERSION"):
        return None
    kept = spark.read.schema("silver string, mapping string").parquet(f"{base}/_VERSION").first()
    return spark.read.parquet(f"{base}/{kept['mapping']}") if kept["silver"] == _silver_version(spark, silver_path) else None


def _keep_mapping(spark: SparkSession, state_path: str, silver_path: str, mapping: DataFrame) -> None:
    """A new version of the mapping; the pointer to it moves last."""
    base, version = f"{state_path.rstrip('/')}/mapping", f"v-{uuid.uuid4().hex[:12]}"
    mapping.write.parquet(f"{base}/{version}")
    spark.createDataFrame([(_silver_version(spark, silver_path), version)], "silver string, mapping string") \
        .write.mode("overwrite").parquet(f"{base}/_VERSION")


def refresh_silver_year(spark: SparkSession, bronze_path: str, municipalities: DataFrame,
                        silver_path: str, gold_path: str, year: int,
                        state_path: str | None = None) -> DataFrame:
    """Daily E3 after a load: silver equal to the full rebuild, at the cost of
    what changed.

    Silver is recomputed from the earliest year whose bronze is newer than
    its silver (normally ``year`` alone; a reload of an earlier year moves
    every year from there on, since dry spells and means carry over), from
    each station's state at that year's start. A new spelling can change a
    station's match; changed matches are carried into the earlier years that
    hold the station. With ``state_path`` the year-start state, the names and
    latest readings per station and year (``station_years``) and the mapping
    itself are kept there: matches are compared with the kept mapping, the years
    of a changed station come from the kept (station, year) rows and gold from
    the kept latest readings, so a run reads only the years that changed
    (where something else wrote silver since, its earlier years are compared
    once). Without ``state_path`` all of that is read from bronze and silver."""
    first = first_stale_year(spark, bronze_path, silver_path, year)
    new_rows = daily.read_bronze(spark, bronze_path, from_year=first)  # ano >= first: pruned
    kept = None
    if state_path:
        kept = _kept_mapping(spark, state_path, silver_path)
        state = year_start_state(spark, bronze_path, state_path, first)
        latest, names = station_years(spark, bronze_path, state_path)
    else:  # history read with a partition filter (ano < first)
        from rainrisk.operators import features
        state = features.carry_state(daily.read_bronze(spark, bronze_path, before_year=first))
        names = latest = daily.read_bronze(spark, bronze_path).withColumn("ano", F.year("data"))
    path = scratch_path(spark, "refresh")
    match.station_municipality_map(names.select("codigo_posto", "nome_posto"), municipalities).write.parquet(f"{path}/mapping")
    mapping = spark.read.parquet(f"{path}/mapping")
    earlier = F.col("ano") < first
    was = kept if kept is not None else spark.read.parquet(silver_path).where(earlier).select("codigo_posto", *MAPPING).distinct()
    _changed_matches(was, mapping).write.parquet(f"{path}/changed")
    changed = spark.read.parquet(f"{path}/changed")
    fresh = medallion.silver_rainfall_year(names, municipalities, first, state=state, year_rows=new_rows, mapping=mapping)
    (sinks.rebalanced(fresh, "ano").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("ano").parquet(silver_path))
    years = [r[0] for r in latest.where(earlier).join(changed, F.col("codigo_posto") == F.col("_c"), "left_semi")
             .select("ano").distinct().collect()]  # years on record
    if years:
        _rematch(spark, silver_path, changed, years)
    if state_path:
        _keep_mapping(spark, state_path, silver_path, mapping)
    gold = grid.gold_from_readings(latest, mapping)
    sinks.rebuild_table(gold, gold_path)
    return grid.alerts(spark.read.parquet(gold_path))


def daily_load_files(spark: SparkSession, raw_dir: str, bronze_path: str,
                     year: int | None = None, raise_on_failure: bool = True) -> DataFrame:
    """E1 load for raw files named ``<Region>_<yyyy>.parquet``.

    Every file is judged first (readable to the end, mandatory columns, a
    year in its name, the years inside); with ``raise_on_failure`` the run
    stops there if any file is not ok. Otherwise the accepted files' rows of
    their own year replace their (year, region) partitions. Returns one
    report row per file.
    """
    files = RawFiles(spark, raw_dir, f"*_{year}.parquet" if year is not None else "*.parquet")
    path = scratch_path(spark, "raw-report")  # judged once; the load reads the verdicts
    files.report().write.parquet(path)
    report = spark.read.parquet(path)
    if raise_on_failure:
        quality.assert_integrity(report)
    sinks.ensure_table(spark, bronze_path, daily.bronze_schema(), daily.PARTITION_COLS)
    daily.replace_bronze_partitions(files.rows(report), bronze_path)
    return report.select("_file", "status")
