"""Bindings of the domain tables to the driver's generated tables.

The generated data is TPC-H shaped; these four views give it the shapes the
domain needs (see FIXTURES.md §2 for the definitions and measured counts):

* ``municipalities``  – nation → gazetteer of municipalities
* ``stations``        – supplier × nation → stations with four name shapes
* ``daily_readings``  – lineitem → one reading per station and ship day
* ``feed_rows``       – events → the 15-minute station feed

Every one reads the given tables, so its work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainrisk.operators.joins import checked_broadcast, clustered


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_municipio: codigo_ibge int, municipio, latitude, longitude."""
    return table(spark, sf_dir, "nation").select(
        (F.lit(2600000) + F.col("n_nationkey")).alias("codigo_ibge"),
        F.col("n_name").alias("municipio"),
        F.expr("CAST(-8.0 - n_nationkey / 100.0 AS DOUBLE)").alias("latitude"),
        F.expr("CAST(-35.0 - n_regionkey / 10.0 AS DOUBLE)").alias("longitude"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_posto: exact / prefix / contains / no-match name shapes."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    nk = F.col("s_nationkey").cast("string")
    shape = F.col("s_suppkey") % 4
    name = (F.when(shape == 0, F.concat(F.lit(" Nation_"), nk))
            .when(shape == 1, F.concat(F.lit("NATION_"), nk, F.lit(" (Várzea)")))
            .when(shape == 2, F.concat(F.lit("Pôsto NATION_"), nk))
            .otherwise(F.col("s_name")))
    region = F.when(F.col("s_suppkey") % 10 == 9, F.lit(None).cast("int")) \
        .otherwise(F.lit(2601) + F.col("n_regionkey"))
    return s.join(checked_broadcast(n), s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").alias("codigo_posto"), name.alias("nome_posto"),
        region.alias("mesorregiao_id"))


def daily_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_leitura: the bronze daily fact (codigo_posto, nome_posto, data,
    precipitacao, mesorregiao_id), unique on (codigo_posto, data).

    lineitem is reduced to one row per (supplier, day) *before* the join
    with the station table (eager aggregation): the join then sees one row
    per reading instead of one per line item.
    """
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("codigo_posto"), F.col("l_shipdate").cast("date").alias("data"),
        "l_linenumber", "l_returnflag", "l_quantity")
    per_day = (clustered(li, "codigo_posto", "data").groupBy("codigo_posto", "data")
               .agg(F.sum("l_linenumber").alias("_lines"),
                    F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))
                          .otherwise(F.lit(0.0))).alias("_rain")))
    precip = F.when(F.col("_lines") % 13 == 0, F.lit(None).cast("double")).otherwise(F.col("_rain"))
    # the station table is bounded by the supplier table; broadcast it only
    # when that is small (without cost-based statistics Catalyst would
    # otherwise pick the per-day aggregate, the larger side, to broadcast)
    st = checked_broadcast(stations(spark, sf_dir), bound=table(spark, sf_dir, "supplier"))
    return per_day.join(st, "codigo_posto").select(
        "codigo_posto", "nome_posto", "data", precip.alias("precipitacao"), "mesorregiao_id")


def reading_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dates of ``daily_readings`` with repeats, without building the readings."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("codigo_posto"), F.col("l_shipdate").cast("date").alias("data"))
    st = checked_broadcast(stations(spark, sf_dir), bound=table(spark, sf_dir, "supplier"))
    return li.join(st, "codigo_posto", "left_semi").select("data")


def feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_feed: data_hora, codigo_gmmc, cidade, nome_estacao, chuva, props."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("ts").alias("data_hora"),
        F.concat(F.lit("G"), F.col("user_id").cast("string")).alias("codigo_gmmc"),
        F.concat(F.lit(" Nation_"), (F.col("user_id") % 30).cast("string")).alias("cidade"),
        F.col("event_type").alias("nome_estacao"),
        F.col("value").alias("chuva"),
        "props",
    )


# SQL text of the same bindings, for the DuckDB oracles (FIXTURES.md §2).
ORACLE_BINDINGS = {
    "v_municipio": """
SELECT 2600000 + n_nationkey AS codigo_ibge, n_name AS municipio,
       CAST(-8.0 - n_nationkey / 100.0 AS DOUBLE) AS latitude,
       CAST(-35.0 - n_regionkey / 10.0 AS DOUBLE) AS longitude
FROM nation""",
    "v_posto": """
SELECT s.s_suppkey AS codigo_posto,
       CASE s.s_suppkey % 4
         WHEN 0 THEN ' Nation_' || CAST(s.s_nationkey AS VARCHAR(10))
         WHEN 1 THEN 'NATION_' || CAST(s.s_nationkey AS VARCHAR(10)) || ' (Várzea)'
         WHEN 2 THEN 'Pôsto NATION_' || CAST(s.s_nationkey AS VARCHAR(10))
         ELSE s.s_name END AS nome_posto,
       CASE WHEN s.s_suppkey % 10 = 9 THEN NULL ELSE 2601 + n.n_regionkey END AS mesorregiao_id
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "v_leitura": """
SELECT p.codigo_posto, p.nome_posto, CAST(l.l_shipdate AS DATE) AS data,
       CASE WHEN SUM(l.l_linenumber) % 13 = 0 THEN NULL
            ELSE SUM(CASE WHEN l.l_returnflag = 'R' THEN l.l_quantity ELSE 0 END) END AS precipitacao,
       p.mesorregiao_id
FROM lineitem l JOIN v_posto p ON l.l_suppkey = p.codigo_posto
GROUP BY 1, 2, 3, 5""",
    "v_feed": """
SELECT ts AS data_hora, 'G' || CAST(user_id AS VARCHAR(20)) AS codigo_gmmc,
       ' Nation_' || CAST(user_id % 30 AS VARCHAR(10)) AS cidade,
       event_type AS nome_estacao, value AS chuva, props
FROM events""",
}


def with_bindings(body: str, *names: str) -> str:
    """Prefix an oracle query with the binding CTEs it needs (in dependency order)."""
    order = ["v_municipio", "v_posto", "v_leitura", "v_feed"]
    need = set(names)
    if "v_leitura" in need:
        need.add("v_posto")
    ctes = [f"{n} AS MATERIALIZED ({ORACLE_BINDINGS[n].strip()})" for n in order if n in need]
    if not ctes:
        return body.strip()
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


# ---- raw wide daily pages built from the readings -----------------------------
_PT_MONTHS_SQL = "array('jan','fev','mar','abr','mai','jun','jul','ago','set','out','nov','dez')"


def daily_wide(readings: DataFrame, mis_tag_mod: int | None = None) -> DataFrame:
    """The raw wide form of ``daily_readings``: one row per (station, month)
    with text day columns ``01``..``31``, as the source publishes it.

    Text shapes exercise the loader: month names in three letter cases,
    decimal commas, padded cells, '-' and 'nan' for a missing reading, no
    cell at all for a day without a reading, a padded header name. With
    ``mis_tag_mod`` stations whose code % mis_tag_mod == 3 are filed under
    the following year (a page that mixes years).

    The readings are dealt out by station once; station-months (and pages of a
    station's year) are then groups within a task. The pivot keeps each day's
    value and which days have a reading, both of fixed width, so that it is a
    hash aggregate (text buffers would make it sort); the text is made after it.
    """
    from rainrisk.sources.daily import DAY_COLUMNS
    code = F.col("codigo_posto")
    missing = F.when(code % 3 == 0, F.lit("nan")).otherwise(F.lit("-"))
    day = F.dayofmonth("data")
    long = clustered(readings, "codigo_posto", always=True).select(
        "codigo_posto", "nome_posto", "mesorregiao_id", F.trunc("data", "month").alias("_month"), day.alias("_dd"), "precipitacao")
    # one group per station-month: at most 31 rows, whatever the table size
    # (name and region are the station's)
    wide = long.groupBy("codigo_posto", "_month", F.col("nome_posto").alias("_name"), F.col("mesorregiao_id").alias("_region")).agg(
        F.bit_or(F.expr("shiftleft(1L, _dd)")).alias("_days"),
        *[F.max(F.when(F.col("_dd") == d, F.col("precipitacao"))).alias(f"_{dd}") for d, dd in zip(range(1, 32), DAY_COLUMNS)])

    # one loop writes all days' texts (31 copies make a method too long to compile)
    def cell(value, i):
        text = F.replace(value.cast("string"), F.lit("."), F.lit(","))
        text = F.when(code % 5 == 0, F.concat(F.lit(" "), text, F.lit(" "))).otherwise(text)
        has = F.col("_days").bitwiseAND(F.get(F.array(*[F.lit(1 << d) for d in range(1, 32)]), i)) != 0
        return F.when(has, F.coalesce(text, missing))

    wide = wide.select("codigo_posto", "_month", "_name", "_region",
                       F.transform(F.array(*[f"_{dd}" for dd in DAY_COLUMNS]), cell).alias("_cells"))
    mon = F.expr(f"element_at({_PT_MONTHS_SQL}, month(_month))")
    mon = (F.when(code % 3 == 0, F.upper(mon))
           .when(code % 3 == 1, F.initcap(mon)).otherwise(mon))
    month_year = F.concat(mon, F.lit("/"), F.year("_month").cast("string"))
    year_tag = F.year("_month")
    if mis_tag_mod:
        year_tag = F.when(code % mis_tag_mod == 3, year_tag + 1).otherwise(year_tag)
    return wide.select(
        code.alias("Código"), F.col("_name").alias("Posto "), month_year.alias("Mês/Ano"),
        *[F.get("_cells", i).alias(dd) for i, dd in enumerate(DAY_COLUMNS)], F.col("_region").alias("mesorregiao_id"), year_tag.alias("ano_ref"))


def daily_pages(readings: DataFrame) -> DataFrame:
    """Landed result pages: one HTML page per station and year, holding the
    rain table (header, one row per month, a 'Total' footer) after an
    unrelated legend table. A page has at most 12 data rows, so building it
    is a bounded group whatever the size of the readings.
    """
    from rainrisk.sources.daily import DAY_COLUMNS
    wide = daily_wide(readings)
    header = ["Código", "Posto", "Mês/Ano", *DAY_COLUMNS]
    head_html = "<tr>" + "".join(f"<th>{h}</th>" for h in header) + "</tr>"
    cells = [F.col("Código").cast("string"), F.col("Posto "), F.col("Mês/Ano"),
             *[F.col(c) for c in DAY_COLUMNS]]
    row_html = F.concat(F.lit("<tr>"), F.array_join(F.transform(F.array(*cells), lambda c: F.concat(
        F.lit("<td>"), F.coalesce(c, F.lit("")), F.lit("</td>"))), ""), F.lit("</tr>"))
    rows = wide.select("Código", "ano_ref", "mesorregiao_id",
                       F.struct(F.col("Mês/Ano").alias("k"), row_html.alias("h")).alias("r"))
    footer = ("<tr><td>Total</td><td></td><td></td>" + "<td>-</td>" * len(DAY_COLUMNS) +
              "</tr>")
    pages = rows.groupBy("Código", "ano_ref", "mesorregiao_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["h"]), "")
        .alias("body"))
    html = F.concat(
        F.lit("<html><body><table id=\"legenda\"><tr><td>mm</td></tr></table>"
              "<table class=\"grid\" id=\"tbMonPluvio\"><thead>" + head_html + "</thead><tbody>"),
        F.col("body"), F.lit(footer + "</tbody></table></body></html>"))
    return pages.select(
        F.concat_ws("-", F.col("Código").cast("string"), F.col("ano_ref").cast("string"))
        .alias("page_id"), html.alias("html"))


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place-name gazetteer derived from ``nation``: for each nation an
    accented, mixed-case spelling (best rank) and the plain name (second
    rank, shifted coordinates); nations with key % 6 == 5 are absent.
    """
    n = table(spark, sf_dir, "nation").where(F.col("n_nationkey") % 6 != 5)
    lat = F.expr("CAST(-8.0 - n_nationkey / 100.0 AS DOUBLE)")
    lon = F.expr("CAST(-35.0 - n_regionkey / 10.0 AS DOUBLE)")
    first = n.select(F.replace(F.col("n_name"), F.lit("NATION"), F.lit("Natión")).alias("nome"),
                     lat.alias("latitude"), lon.alias("longitude"), F.lit(1).alias("rank"))
    second = n.select(F.col("n_name").alias("nome"), (lat - 1.0).alias("latitude"),
                      lon.alias("longitude"), F.lit(2).alias("rank"))
    return first.unionByName(second)
