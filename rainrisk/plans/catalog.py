"""The query catalogue: name → callable(spark, sf_dir) → DataFrame.

Every query reads the driver's tables through ``sources.bindings`` and runs
over whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainrisk.functions import domain
from rainrisk.operators import features, grid, match
from rainrisk.plans import medallion
from rainrisk.sources import bindings as B

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _bronze(spark, d):
    return B.daily_readings(spark, d)


def _mun(spark, d):
    return B.municipalities(spark, d)


# ---- matching ----------------------------------------------------------------
@query
def station_municipality_map(spark, d):
    return match.station_municipality_map(_bronze(spark, d), _mun(spark, d))


@query
def match_exact(spark, d):
    return match.tier_matches(_bronze(spark, d), _mun(spark, d), 1)


@query
def match_prefix(spark, d):
    return match.tier_matches(_bronze(spark, d), _mun(spark, d), 2)


@query
def match_contains(spark, d):
    return match.tier_matches(_bronze(spark, d), _mun(spark, d), 3)


@query
def match_remaining(spark, d):
    return match.unmatched_stations(_bronze(spark, d), _mun(spark, d))


# ---- domain rules and features ----------------------------------------------
@query
def alert_level(spark, d):
    b = _bronze(spark, d)
    return b.select("codigo_posto", "data", "precipitacao",
                    domain.alert_band(F.col("precipitacao")).alias("alerta_chuva"))


@query
def climate_period(spark, d):
    b = _bronze(spark, d)
    return b.select("codigo_posto", "data", "mesorregiao_id",
                    domain.climate_period(F.col("mesorregiao_id"), F.col("data"))
                    .alias("periodo_clima"))


@query
def weekday_name(spark, d):
    b = _bronze(spark, d)
    return b.select("codigo_posto", "data", domain.weekday_name(F.col("data")).alias("dia_semana"))


@query
def rain_islands(spark, d):
    b = _bronze(spark, d).select("codigo_posto", "data", "precipitacao")
    return features.with_islands(b)


@query
def dry_spell(spark, d):
    b = _bronze(spark, d).select("codigo_posto", "data", "precipitacao")
    return features.with_dry_spell(features.with_islands(b)).drop("island_id")


@query
def moving_mean_7(spark, d):
    b = _bronze(spark, d).select("codigo_posto", "data", "precipitacao")
    return features.with_moving_mean(b)


# ---- silver / gold -----------------------------------------------------------
@query
def silver_rainfall(spark, d):
    return medallion.silver_rainfall(_bronze(spark, d), _mun(spark, d))


@query
def silver_rainfall_split(spark, d):
    """Silver with the windows split per (station, year) (hot-station form)."""
    return medallion.silver_rainfall(_bronze(spark, d), _mun(spark, d), split_by_year=True)


@query
def silver_rainfall_latest_year(spark, d):
    """Incremental silver: the latest year recomputed from carried-in state."""
    bronze = _bronze(spark, d)
    latest = bronze.select(F.max(F.year("data"))).scalar()
    return medallion.silver_rainfall_year(bronze, _mun(spark, d), latest)


@query
def latest_per_municipality(spark, d):
    bronze, mun = _bronze(spark, d), _mun(spark, d)
    mapping = match.station_municipality_map(bronze, mun)
    return grid.latest_from_readings(bronze, mapping, stations=B.table(spark, d, "supplier"))


@query
def gold_grid_risk(spark, d):
    return medallion.gold_grid_risk(_bronze(spark, d), _mun(spark, d))


@query
def alerts(spark, d):
    return grid.alerts(medallion.gold_grid_risk(_bronze(spark, d), _mun(spark, d)))


# ---- bronze shaping ------------------------------------------------------------
def _landed_wide(spark, d, mis_tag_mod=None):
    from rainrisk.session import scratch_path
    from rainrisk.sources import daily
    raw = scratch_path(spark, "raw-daily")
    daily.land_raw_wide(B.daily_wide(_bronze(spark, d), mis_tag_mod), raw)
    return daily.read_raw_wide(spark, raw)


@query
def bronze_daily_long(spark, d):
    from rainrisk.sources import daily
    return daily.shape_daily(_landed_wide(spark, d))


@query
def bronze_year_guard(spark, d):
    from rainrisk.sources import daily
    wide = daily.normalise_header(_landed_wide(spark, d, mis_tag_mod=7))
    return daily.shape_daily(daily.guard_page_year(wide))


@query
def bronze_replace_year(spark, d):
    from rainrisk.session import scratch_path
    from rainrisk.sources import daily
    path = scratch_path(spark, "bronze")
    wide = B.daily_wide(_bronze(spark, d))
    daily.replace_bronze_partitions(daily.shape_daily(wide), path)
    # the year is a partition value, and the pages of it alone are built again:
    # a filter on the shaped rows would pivot and parse all years a second time
    first_year = spark.read.schema(daily.bronze_schema()).parquet(path).agg(F.min("ano")).first()[0]
    again = wide.where((F.col(daily.YEAR_TAG) == first_year) & (F.col(daily.COL_CODE) % 2 == 0))
    daily.replace_bronze_partitions(daily.shape_daily(again), path)
    return daily.read_bronze(spark, path)


def _raw_files(spark, d):
    from rainrisk.plans.raw_fixture import write_raw_files
    from rainrisk.session import scratch_path
    from rainrisk.sources.raw_files import RawFiles
    folder = scratch_path(spark, "raw-files")
    write_raw_files(spark, _bronze(spark, d), folder)
    return RawFiles(spark, f"{folder}/raw"), f"{folder}/raw"


@query
def raw_files_load(spark, d):
    """Irregular flat files loaded: bronze of the accepted ones."""
    from rainrisk.plans import flows
    from rainrisk.session import scratch_path
    from rainrisk.sources import daily
    _, folder = _raw_files(spark, d)
    bronze = scratch_path(spark, "bronze")
    flows.daily_load_files(spark, folder, bronze, raise_on_failure=False)
    return daily.read_bronze(spark, bronze)


@query
def dq_raw_files(spark, d):
    """Every flat file's verdict, by file name."""
    files, _ = _raw_files(spark, d)
    name = F.regexp_extract("_file", r"([^/]+)$", 1)
    return files.report().select(name.alias("arquivo"), "status", "n_rows", "year_min", "year_max")


@query
def silver_after_reload(spark, d):
    """Build, reload an earlier year and a spelling, refresh: equal to a full build."""
    from rainrisk.plans import flows
    from rainrisk.session import scratch_path
    from rainrisk.sources import daily
    readings = _bronze(spark, d)
    bronze, silver, gold = (scratch_path(spark, x) for x in ("bronze", "silver", "gold"))
    first, last = B.reading_dates(spark, d).agg(F.min(F.year("data")), F.max(F.year("data"))).first()
    year, odd = F.year("data"), F.col("codigo_posto") % 4 == 0
    # what is true in the end: some stations had no usable name before the last year
    true = readings.withColumn("nome_posto", F.when(odd & (year < last), "Sem nome").otherwise(F.col("nome_posto")))
    before = true.withColumns({"nome_posto": F.when(odd, "Sem nome").otherwise(F.col("nome_posto")),
                               "precipitacao": F.when(year == first + 2, 0.0).otherwise(F.col("precipitacao"))})
    daily.replace_bronze_partitions(before, bronze)
    flows.build_silver_gold(spark, bronze, _mun(spark, d), silver, gold)
    daily.replace_bronze_partitions(true.where((year == first + 2) | (year == last)), bronze)
    flows.refresh_silver_year(spark, bronze, _mun(spark, d), silver, gold, last, state_path=scratch_path(spark, "state"))
    return spark.read.parquet(silver).select(*medallion.SILVER_COLUMNS).withColumn("ano", F.col("ano").cast("bigint"))


@query
def table_rebuild_view(spark, d):
    """An empty table made, rebuilt by year, read
    through a view of its namespace, with its rows per file."""
    from rainrisk.session import scratch_path
    from rainrisk.sources import daily, sinks
    path = scratch_path(spark, "table")
    readings = _bronze(spark, d).withColumn("ano", F.year("data"))
    sinks.ensure_table(spark, path, daily.empty_like(readings).schema, ["ano"])
    assert spark.read.schema(readings.schema).parquet(path).count() == 0
    sinks.rebuild_table(readings, path, partition_by=["ano"])
    back = spark.read.parquet(path)
    # The namespace is made once and may be asked for again; the table in it is the written one
    for _ in range(2):
        sinks.ensure_namespace(spark, "bronze", location=scratch_path(spark, "bronze-ns"))
    named = "bronze.leituras_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE TABLE {named} USING parquet LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {named}")
    sinks.register_view(spark.table(named), "leituras_reconstruidas")
    per_file = sinks.rows_per_file(back).withColumn("ano", F.regexp_extract("file_path", "/ano=([0-9]+)/", 1).cast("int"))
    files = per_file.groupBy("ano").agg(F.sum("n_rows").alias("n_rows"))
    rows = spark.sql("SELECT ano, count(DISTINCT codigo_posto) AS n_stations, sum(precipitacao) AS chuva, "
                     "max(data) AS ultima FROM leituras_reconstruidas GROUP BY ano")
    return rows.join(files, "ano").select(F.col("ano").cast("bigint").alias("ano"), "n_rows", "n_stations", "chuva", "ultima")


@query
def sql_clean_name(spark, d):
    """D-u4: the name cleaner called from SQL text."""
    from rainrisk.functions.sql import register_sql_functions
    register_sql_functions(spark)
    return spark.sql("SELECT codigo_posto, clean_string(nome_posto) AS limpo, upper_trim(nome_posto) AS maiusculo FROM {s}",
                     s=B.stations(spark, d))


@query
def dimension_write(spark, d):
    """The dimension replaced behind its unique-key check, read back."""
    from rainrisk.session import scratch_path
    from rainrisk.sources.gazetteer import geocode, write_dimension
    path = scratch_path(spark, "dim")
    names = _mun(spark, d).select("codigo_ibge", "municipio")
    write_dimension(names.limit(0).withColumns({"latitude": F.lit(0.0), "longitude": F.lit(0.0)}), path)
    write_dimension(geocode(names, B.gazetteer(spark, d)), path)
    return spark.read.parquet(path)


@query
def feed_ingest_days(spark, d):
    """The ingestion stamp and its partition keys."""
    from rainrisk.sources import feed
    payload = feed.payload_from_feed(B.feed_rows(spark, d))
    stamp = F.make_timestamp(F.lit(2025), F.lit(3), F.lit(7), F.lit(23), F.lit(59), F.lit(59), F.lit("UTC"))
    rows = feed.with_ingest_partitions(feed.typed_feed(payload, ingest_ts=stamp))
    return rows.groupBy("ano", "mes", "dia").agg(F.count("ingestao_ts").alias("n_rows"))


# ---- feed ------------------------------------------------------------------------
@query
def json_flatten(spark, d):
    from rainrisk.sources import feed
    payload = feed.payload_from_feed(B.feed_rows(spark, d))
    rows = feed.typed_feed(payload, ingest_ts=F.lit(None).cast("timestamp"), extra_nested=["k"])
    return rows.drop("ingestao_ts").withColumn("dc_k", F.col("dc_k").try_cast("bigint"))


@query
def silver_station_latest(spark, d):
    from rainrisk.functions.text import upper_trim
    from rainrisk.operators.stations import latest_per_station
    f = B.feed_rows(spark, d).withColumn("municipio_nome", upper_trim(F.col("cidade")))
    latest = latest_per_station(f, carry=["municipio_nome", "chuva"])
    return latest.select("codigo_gmmc", "municipio_nome", "nome_estacao", "data_hora", "chuva")


@query
def silver_stations(spark, d):
    from rainrisk.operators.stations import latest_per_station, station_table
    from rainrisk.sources import feed
    payload = feed.payload_from_feed(B.feed_rows(spark, d))
    rows = feed.typed_feed(payload)
    return station_table(latest_per_station(rows), _mun(spark, d))


@query
def feed_stream_latest(spark, d):
    from rainrisk.session import scratch_path
    from rainrisk.sources import feed
    from rainrisk.streaming import feed_stream as S
    base = scratch_path(spark, "feed")
    payload = feed.payload_from_feed(B.feed_rows(spark, d))
    # land the payload as four separate arrivals of array files
    for part in range(4):
        feed.write_array_files(payload.where(F.abs(F.xxhash64("Codigo_gmmc", "Data-hora")) % 4 == 3 - part),
                               f"{base}/payload/arrival={part}")
    S.run_available_now(S.land_feed(spark, f"{base}/payload/*/*/*.txt", f"{base}/landed",
                                    f"{base}/cp-land", json_array=True))
    S.run_available_now(S.latest_snapshot_stream(spark, f"{base}/landed", f"{base}/latest",
                                                 f"{base}/cp-latest"))
    return spark.read.parquet(f"{base}/latest").select(
        "codigo_gmmc", "municipio_nome", "nome_estacao", "data_hora", "chuva")


@query
def feed_rejects(spark, d):
    """What lands and what goes to the side, per station, of a feed
    with cut-off files, an error page, bad and missing timestamps and broken
    nested texts (stations by number modulo 17)."""
    from rainrisk.session import scratch_path
    from rainrisk.sources import feed
    from rainrisk.streaming import feed_stream as S
    base = scratch_path(spark, "feed-rejects")
    code = F.substring("Codigo_gmmc", 2, 20).cast("bigint") % 17
    payload = feed.payload_from_feed(B.feed_rows(spark, d)).withColumns({
        "Data-hora": F.when(code == 3, "ontem").when(code != 5, F.col("Data-hora")),
        "Dados_completos": F.when(code == 7, F.substring("Dados_completos", 1, 5)).otherwise(F.col("Dados_completos"))})
    feed.write_array_files(payload.where(code != 9), f"{base}/payload/kind=arrays")
    one = payload.where(code == 9).groupBy("Codigo_gmmc").agg(F.array_join(F.collect_list(F.to_json(F.struct(*feed.TOP_FIELDS))), ",").alias("j"))
    cut = one.select(F.concat(F.lit("["), F.expr("left(j, length(j) - 9)")).alias("value"), F.col("Codigo_gmmc").alias("file"))
    cut.write.partitionBy("file").text(f"{base}/payload/kind=cut")       # one file per station
    page = spark.range(1).select(F.lit("<html>503</html>").alias("value"), F.lit("page").alias("file"))
    page.write.partitionBy("file").text(f"{base}/payload/kind=page")
    S.run_available_now(S.land_feed(spark, f"{base}/payload/*/*/*.txt", f"{base}/landed", f"{base}/cp", f"{base}/side"))
    landed = feed.read_landed(spark, f"{base}/landed").select("codigo_gmmc", F.lit("ok").alias("motivo"))
    named = F.nullif(F.regexp_extract("registro", '"Codigo_gmmc":"([^"]*)"', 1), F.lit(""))
    side = S.read_rejects(spark, f"{base}/side").select(named.alias("codigo_gmmc"), "motivo")
    return landed.unionByName(side).groupBy("codigo_gmmc", "motivo").agg(F.count(F.lit(1)).alias("n"))


@query
def raw_partition_roundtrip(spark, d):
    from rainrisk.session import scratch_path
    from rainrisk.sources.sinks import rebalanced
    path = scratch_path(spark, "feed-raw")
    rows = B.feed_rows(spark, d)
    ts = F.col("data_hora")
    days = rows.withColumns({"ano": F.year(ts).cast("string"),
                             "mes": F.lpad(F.month(ts).cast("string"), 2, "0"),
                             "dia": F.lpad(F.dayofmonth(ts).cast("string"), 2, "0")})
    (rebalanced(days, "ano", "mes", "dia").write.mode("overwrite").partitionBy("ano", "mes", "dia").parquet(path))
    back = (spark.read.schema("data_hora timestamp_ntz, codigo_gmmc string, cidade string, "
                              "nome_estacao string, chuva double, props string, "
                              "ano string, mes string, dia string")
            .option("basePath", path).parquet(path))
    return (back.groupBy(*[F.col(c).cast("bigint").alias(c) for c in ("ano", "mes", "dia")])
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_distinct("codigo_gmmc").alias("n_stations"),
                 F.min("data_hora").alias("first_reading"),
                 F.max("data_hora").alias("last_reading")))


# ---- re-aimed sources ------------------------------------------------------------
@query
def html_table_rows(spark, d):
    from rainrisk.functions.parse import parse_html_number, pt_month_number, pt_year
    from rainrisk.sources import daily
    from rainrisk.sources.html_table import table_rows
    pages = B.daily_pages(_bronze(spark, d))
    cols = [daily.COL_CODE, daily.COL_NAME, daily.COL_MONTH_YEAR, *daily.DAY_COLUMNS]
    rows = daily.numeric_code_rows(table_rows(pages, columns=cols, keep=["page_id"]))
    rows = rows.select("page_id", *cols[:2], *daily.DAY_COLUMNS,
                       pt_year(F.col(daily.COL_MONTH_YEAR)).alias("ano"),
                       pt_month_number(F.col(daily.COL_MONTH_YEAR)).cast("bigint").alias("mes"))
    long = daily.unpivot_days(rows, ["page_id", *cols[:2], "ano", "mes"], daily.DAY_COLUMNS,
                              value="cell")
    return long.select(
        F.col(daily.COL_CODE).alias("codigo_posto"),
        F.col(daily.COL_NAME).alias("nome_posto"), "ano", "mes",
        F.col("_day_no").cast("bigint").alias("dia"),
        parse_html_number(F.col("cell")).alias("chuva"))


# fixed "today" of the registered backfill query (its oracle uses the same date)
QUERY_AS_OF = dt.date(2026, 6, 30)


@query
def backfill_plan(spark, d):
    from rainrisk.sources.backfill import backfill_plan as plan, landed_units
    return plan(landed_units(_bronze(spark, d)), QUERY_AS_OF)


@query
def clean_string(spark, d):
    from rainrisk.functions.text import clean_string as clean
    docs = B.table(spark, d, "documents")
    return docs.select("doc_id", clean(F.col("text")).alias("texto_limpo"))


@query
def gazetteer_lookup(spark, d):
    from rainrisk.sources.gazetteer import geocode
    names = _mun(spark, d).select("codigo_ibge", "municipio")
    return geocode(names, B.gazetteer(spark, d))


# ---- data quality ------------------------------------------------------------------
BRONZE_TABLE = "bronze.monitoramento_pluviometrico"
SILVER_TABLE = "silver.monitoramento_pluviometrico"


@query
def dq_not_null(spark, d):
    from rainrisk.operators import quality as Q
    bronze = _bronze(spark, d)
    silver = medallion.silver_rainfall(bronze, _mun(spark, d))
    return Q.union_reports(
        Q.not_null(bronze, BRONZE_TABLE, ["codigo_posto", "data"]),
        Q.not_null(silver, SILVER_TABLE, ["codigo_posto", "data", "ano", "mes", "dia",
                                          "periodo_clima", "alerta_chuva"]))


@query
def dq_unique(spark, d):
    from rainrisk.operators import quality as Q
    bronze = _bronze(spark, d)
    silver = medallion.silver_rainfall(bronze, _mun(spark, d))
    return Q.union_reports(
        Q.unique_combination(bronze, BRONZE_TABLE, ["codigo_posto", "data"]),
        Q.unique_combination(silver, SILVER_TABLE, ["codigo_posto", "data"]))


@query
def dq_accepted(spark, d):
    from rainrisk.functions import domain as D
    from rainrisk.operators import quality as Q
    bronze = _bronze(spark, d)
    silver = medallion.silver_rainfall(bronze, _mun(spark, d))
    return Q.union_reports(
        Q.accepted_values(bronze, BRONZE_TABLE,
                          {"mesorregiao_id": sorted(c for c, _ in D.MESOREGIONS)}),
        Q.accepted_values(silver, SILVER_TABLE, {
            "periodo_clima": [D.SEASON_WET, D.SEASON_DRY, D.SEASON_UNKNOWN],
            "alerta_chuva": [D.BAND_NORMAL, D.BAND_POTENTIAL, D.BAND_DANGER, D.BAND_GREAT]}))


@query
def dq_file_integrity(spark, d):
    from rainrisk.operators import quality as Q
    raw = _landed_wide(spark, d, mis_tag_mod=7)
    return Q.unit_integrity(raw, ["mesorregiao_id", "ano_ref"], F.col("ano_ref"))


@query
def dq_file_summary(spark, d):
    """Q5/A4: raw units per integrity status."""
    from rainrisk.operators import quality as Q
    raw = _landed_wide(spark, d, mis_tag_mod=7)
    return Q.integrity_summary(Q.unit_integrity(raw, ["mesorregiao_id", "ano_ref"],
                                                F.col("ano_ref")))


@query
def raw_csv_integrity(spark, d):
    """S5 + Q4: the raw wide pages kept as CSV (header row, all text), checked
    per (region, year) directory like the Parquet landing."""
    from rainrisk.operators import quality as Q
    from rainrisk.session import scratch_path
    from rainrisk.sources import daily
    from rainrisk.sources.sinks import rebalanced
    path = scratch_path(spark, "raw-csv")
    (rebalanced(B.daily_wide(_bronze(spark, d), 7), "mesorregiao_id", "ano_ref")
     .write.mode("overwrite").option("header", True)
     .partitionBy("mesorregiao_id", "ano_ref").csv(path))
    raw = daily.read_raw_csv(spark, path)
    return Q.unit_integrity(raw, ["mesorregiao_id", "ano_ref"], F.col("ano_ref"))
