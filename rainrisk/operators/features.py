"""Per-station rainfall features.

All windows partition by station and order by date, so Spark plans a single
hash exchange on ``codigo_posto`` and a single sort for them (numbers within an
island are positions within the station less the island's first). A station
holds at most one reading per day (bronze is unique on (code, date)), so a
window partition is bounded by the number of days on record, however large
the table grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rainrisk.functions.domain import alert_band, climate_period, weekday_name
from rainrisk.operators.joins import clustered

# moving mean over this many readings (rows, not calendar days)
MOVING_ROWS = 7


def _by_station():
    return Window.partitionBy("codigo_posto").orderBy("data")


def with_calendar(df: DataFrame) -> DataFrame:
    """ano, mes, dia (bigint), dia_semana, periodo_clima."""
    d = F.col("data")
    return df.withColumns({
        "ano": F.year(d).cast("bigint"),
        "mes": F.month(d).cast("bigint"),
        "dia": F.dayofmonth(d).cast("bigint"),
        "dia_semana": weekday_name(d),
        "periodo_clima": climate_period(F.col("mesorregiao_id"), d),
    })


def with_islands(df: DataFrame) -> DataFrame:
    """Running count of rainy readings per station (island id).

    The default frame (RANGE, unbounded preceding to current row) is the
    reference's; with unique dates it equals a ROWS frame.
    """
    rainy = F.when(F.coalesce(F.col("precipitacao"), F.lit(0.0)) > 0, 1).otherwise(0)
    return df.withColumn("island_id", F.sum(rainy).over(_by_station()).cast("bigint"))


def _with_places(df: DataFrame, of_island: F.Column | None = None) -> DataFrame:
    """``_at``, the reading's place within its station, and ``_start``, that of
    its island's first reading (NULL before any rain); with ``of_island`` only
    such readings begin islands. Readings of the first one's date count from it."""
    rainy = F.coalesce(F.col("precipitacao"), F.lit(0.0)) > 0
    w = _by_station()
    df = df.withColumns({"_at": F.row_number().over(w), "_rank": F.rank().over(w)})
    first = rainy if of_island is None else of_island & rainy
    return df.withColumn("_start", F.max(F.when(first, F.col("_rank"))).over(w))


def with_dry_spell(df: DataFrame, anchor: str = "reference") -> DataFrame:
    """dias_secos_consecutivos (``anchor='dry'`` needs ``island_id``).

    ``anchor='reference'`` numbers every reading of an island and shows the
    number on dry readings, so the first dry day after rain counts 2 and a
    negative reading takes a number but shows 0 (the reference's behaviour).
    ``anchor='dry'`` counts dry readings only.
    """
    p0 = F.coalesce(F.col("precipitacao"), F.lit(0.0))
    if anchor == "reference":
        df = _with_places(df)
        n = F.col("_at") - F.coalesce("_start", F.lit(1)) + 1
    elif anchor == "dry":
        w = Window.partitionBy("codigo_posto", "island_id").orderBy("data")
        n = F.sum(F.when(p0 == 0, 1).otherwise(0)).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    else:
        raise ValueError(f"unknown anchor {anchor!r}")
    return df.withColumn("dias_secos_consecutivos",
                         F.when(p0 == 0, n).otherwise(F.lit(0)).cast("bigint")).drop("_at", "_rank", "_start")


def with_moving_mean(df: DataFrame, rows: int = MOVING_ROWS) -> DataFrame:
    """Mean of the last ``rows`` readings (NULLs skipped; partial at start)."""
    w = _by_station().rowsBetween(-(rows - 1), Window.currentRow)
    return df.withColumn("mm_7d", F.avg("precipitacao").over(w))


def with_alert_band(df: DataFrame) -> DataFrame:
    return df.withColumn("alerta_chuva", alert_band(F.col("precipitacao")))


def rainfall_features(df: DataFrame, anchor: str = "reference") -> DataFrame:
    return with_dry_spell(with_moving_mean(with_islands(df)), anchor).select(
        *df.columns, "island_id", "dias_secos_consecutivos", "mm_7d")


# ---- incremental form: one year slice with carried-in station state ----------
def station_year_summary(history: DataFrame, rows: int = MOVING_ROWS) -> DataFrame:
    """One row per (station, year): readings, whether it rained, readings from
    the last rainy one on, and the last ``rows - 1`` readings. A station-year
    holds at most 366 readings, so its list is bounded; a closed year's
    summary never changes."""
    h = history.select("codigo_posto", F.year("data").alias("_y"), "data", "precipitacao")
    rainy = F.coalesce(F.col("precipitacao"), F.lit(0.0)) > 0
    per = h.groupBy("codigo_posto", "_y").agg(
        F.array_sort(F.collect_list(F.struct("data", "precipitacao"))).alias("_all"),
        F.max(F.when(rainy, F.col("data"))).alias("_rain"))
    after = F.size(F.filter("_all", lambda x: x["data"] >= F.col("_rain")))
    n = F.size("_all")
    last = F.slice("_all", F.greatest(n - (rows - 2), F.lit(1)), F.lit(rows - 1))
    return per.select("codigo_posto", "_y", n.alias("n"), F.col("_rain").isNotNull().alias("rained"),
                      F.when(F.col("_rain").isNotNull(), after).otherwise(n).alias("after"), last.alias("last"))


def station_state(history: DataFrame, rows: int = MOVING_ROWS) -> DataFrame:
    """State of each station at the end of ``history`` (all its readings
    before the slice to be computed):

    * ``carry_rn`` – the reading's number within its island at the last
      reading (readings since the last rainy one, that one included; all
      readings when it never rained);
    * ``last`` – the last ``rows - 1`` readings, for the moving mean's first rows.

    The history is aggregated once per (station, year); a station's years
    (tens of rows) are then folded in order.
    """
    years = station_year_summary(history, rows).groupBy("codigo_posto").agg(
        F.array_sort(F.collect_list(F.struct("_y", "n", "rained", "after", "last"))).alias("_years"))
    carry = F.aggregate("_years", F.lit(0), lambda acc, x: F.when(x["rained"], x["after"]).otherwise(acc + x["n"]))
    all_last = F.flatten(F.transform("_years", lambda x: x["last"]))
    size = F.size("_last")
    return years.select("codigo_posto", carry.cast("bigint").alias("carry_rn"), all_last.alias("_last")).select(
        "codigo_posto", "carry_rn", F.slice("_last", F.greatest(size - (rows - 2), F.lit(1)), F.lit(rows - 1)).alias("last"))


def carried(state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``station_state`` as (codigo_posto, carry_rn) and (codigo_posto, data, precipitacao)."""
    return state.select("codigo_posto", "carry_rn"), state.select("codigo_posto", F.inline("last"))


def carry_state(history: DataFrame, rows: int = MOVING_ROWS) -> tuple[DataFrame, DataFrame]:
    return carried(station_state(history, rows))


def rainfall_features_slice(slice_df: DataFrame, history: DataFrame | None = None,
                            rows: int = MOVING_ROWS,
                            state: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """W3–W5 for the readings of ``slice_df`` only, equal to computing them on
    history ∪ slice and keeping the slice's rows (``history`` must hold all
    of each station's readings dated before its slice readings). Instead of
    ``history``, a stored ``state = carry_state(history)`` may be given.

    ``island_id`` is not produced (its absolute value needs the whole past
    and appears in no output); ``dias_secos_consecutivos`` and ``mm_7d`` are.
    """
    rn, tail = state if state is not None else carry_state(history, rows)
    p0 = F.coalesce(F.col("precipitacao"), F.lit(0.0))
    tail_rows = tail.withColumn("_tail", F.lit(True))
    cols = slice_df.columns
    both = (slice_df.withColumn("_tail", F.lit(False))
            .unionByName(tail_rows, allowMissingColumns=True))
    w = _by_station()
    both = both.withColumns({
        "_seen": F.sum(F.when(F.col("_tail"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "mm_7d": F.avg("precipitacao").over(w.rowsBetween(-(rows - 1), Window.currentRow))})
    # the carried readings come before all others: they cancel out in the place within an island
    both = _with_places(both, of_island=~F.col("_tail")).where(~F.col("_tail"))
    out = both.join(rn, "codigo_posto", "left")
    n = F.when(F.col("_start").isNull(), F.col("_seen") + F.coalesce(F.col("carry_rn"), F.lit(0))) \
        .otherwise(F.col("_at") - F.col("_start") + 1)
    return out.select(*cols, F.when(p0 == 0, n).otherwise(F.lit(0)).cast("bigint")
                      .alias("dias_secos_consecutivos"), "mm_7d")


# ---- split form: windows per (station, year) chunk ----------------------------
def rainfall_features_split(df: DataFrame, rows: int = MOVING_ROWS,
                            chunk_of: F.Column | None = None) -> DataFrame:
    """``rainfall_features`` with every window partitioned by (station, chunk),
    chunk = year by default: a station that held a large share of the table
    is spread over as many tasks as it has years, each with at most 366
    readings. The readings are exchanged once, on (station, chunk); all
    other work is on per-chunk summaries and at most ``rows - 1`` readings
    per chunk:

    * per chunk: count, rainy count, position of the last rainy reading;
    * a segmented scan over a station's chunk summaries gives each chunk its
      carried-in number within the island (``carry_rn``) and the rainy count
      of earlier chunks (island id offset);
    * each chunk's last ``rows - 1`` readings are offered to the next
      ``rows - 1`` chunks, which keep the latest ``rows - 1``; the moving
      mean of a chunk's first ``rows - 1`` readings is recomputed over those
      plus its own first readings (same rows, same order: same values).
    """
    chunk = "_chunk"
    key = ["codigo_posto", chunk]
    p0 = F.coalesce(F.col("precipitacao"), F.lit(0.0))
    cols = df.columns
    d = clustered(df.withColumn(chunk, chunk_of if chunk_of is not None else F.year("data")), *key)
    w = Window.partitionBy(*key).orderBy("data")
    w_desc = Window.partitionBy(*key).orderBy(F.col("data").desc())
    d = d.withColumns({
        "_idx": F.row_number().over(w),
        "_ridx": F.row_number().over(w_desc),
        "_island": F.sum(F.when(p0 > 0, 1).otherwise(0)).over(w),
        "_mm_local": F.avg("precipitacao").over(w.rowsBetween(-(rows - 1), Window.currentRow)),
    })
    w_island = Window.partitionBy(*key, "_island").orderBy("data")
    d = d.withColumn("_local_rn", F.row_number().over(w_island))

    # per-chunk summaries and the segmented scan over a station's chunks
    summ = d.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max("_island").alias("_r"),
        F.max(F.when(p0 > 0, F.col("_idx"))).alias("_last_rain_idx"))
    ws = Window.partitionBy("codigo_posto").orderBy(chunk)
    upto = ws.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summ = summ.withColumns({
        "_cum_n": F.sum("_n").over(upto),
        "_cum_r": F.sum("_r").over(upto),
        "_k": F.row_number().over(ws),
    })
    # the last rainy chunk so far, with its cumulative count and tail length
    summ = summ.withColumn("_lr", F.max(F.when(F.col("_last_rain_idx").isNotNull(), F.struct(
        F.col("_cum_n").alias("cum_n"),
        (F.col("_n") - F.col("_last_rain_idx") + 1).alias("after")))).over(upto))
    after = F.when(F.col("_lr").isNull(), F.col("_cum_n")).otherwise(
        F.col("_cum_n") - F.col("_lr.cum_n") + F.col("_lr.after"))
    summ = summ.withColumn("_after", after)
    carry = summ.select(*key, "_k",
                        F.coalesce(F.lag("_after").over(ws), F.lit(0)).alias("_carry_rn"),
                        (F.col("_cum_r") - F.col("_r")).alias("_prev_rainy"))

    # moving-mean fix-up for each chunk's first rows-1 readings
    chunk_of_k = carry.select("codigo_posto", F.col("_k").alias("_target_k"),
                              F.col(chunk).alias("_target"))
    offers = (d.where(F.col("_ridx") < rows).select(*key, "data", "precipitacao")
              .join(carry.select(*key, "_k"), key)
              .select("codigo_posto", "data", "precipitacao",
                      F.explode(F.sequence(F.col("_k") + 1, F.col("_k") + rows - 1))
                      .alias("_target_k"))
              .join(chunk_of_k, ["codigo_posto", "_target_k"]))
    w_t = Window.partitionBy("codigo_posto", "_target").orderBy(F.col("data").desc())
    tails = (offers.withColumn("_t", F.row_number().over(w_t)).where(F.col("_t") < rows)
             .select("codigo_posto", F.col("_target").alias(chunk), "data", "precipitacao",
                     F.lit(True).alias("_tail")))
    heads = d.where(F.col("_idx") < rows).select(*key, "data", "precipitacao", "_idx",
                                                 F.lit(False).alias("_tail"))
    fix = (heads.unionByName(tails, allowMissingColumns=True)
           .withColumn("_mm_fix", F.avg("precipitacao").over(
               w.rowsBetween(-(rows - 1), Window.currentRow)))
           .where(~F.col("_tail"))
           # at most rows-1 values per chunk, keyed by the reading's position
           .groupBy(*key).agg(F.map_from_entries(F.collect_list(
               F.struct("_idx", "_mm_fix"))).alias("_mm_first")))
    # one small table per (station, chunk), joined on exactly the keys the
    # readings are partitioned by: only the small side moves
    per_chunk = carry.join(fix, key, "left")

    out = d.join(per_chunk, key, "left")
    n = F.col("_local_rn") + F.when(F.col("_island") == 0,
                                    F.coalesce(F.col("_carry_rn"), F.lit(0))).otherwise(0)
    island = (F.col("_island") + F.coalesce(F.col("_prev_rainy"), F.lit(0))).cast("bigint")
    return out.select(*cols, island.alias("island_id"),
                      F.when(p0 == 0, n).otherwise(F.lit(0)).cast("bigint")
                      .alias("dias_secos_consecutivos"),
                      F.when(F.col("_idx") < rows,
                             F.try_element_at(F.col("_mm_first"), F.col("_idx")))
                      .otherwise(F.col("_mm_local")).alias("mm_7d"))
