"""Risk grid: one current alert level per municipality."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rainrisk.functions.domain import alert_band, alert_level_label
from rainrisk.operators.joins import checked_broadcast


def latest_per_municipality(silver: DataFrame,
                            municipalities: DataFrame | None = None) -> DataFrame:
    """A1 + J7: readings on each municipality's latest date.

    The maxima are one row per municipality. Given the municipality
    dimension, that bound is checked and the maxima are broadcast, so the
    readings are not shuffled again by (municipality, date); without it AQE
    decides from the measured size.
    """
    s = (silver.where(F.col("municipio_inferido").isNotNull())
         .select(F.col("municipio_inferido").alias("municipio"), "codigo_posto", "data",
                 "precipitacao"))
    latest = s.groupBy("municipio").agg(F.max("data").alias("data"))
    if municipalities is not None:
        latest = checked_broadcast(latest, bound=municipalities)
    return s.join(latest, ["municipio", "data"]).select(
        "municipio", "codigo_posto", "data", "precipitacao")


def gold_grid_risk(silver: DataFrame) -> DataFrame:
    """id, municipio, nivel_alerta, atualizacao.

    The reference joins every reading to its municipality's latest date and
    ranks the wettest reading there. Both steps collapse into one aggregate:
    the maximum of struct(data, precipitacao) is the latest date and, on it,
    the largest reading (NULL only if all are NULL, which is band Normal like
    0). The aggregate combines map-side, so a municipality holding a third of
    all readings costs no more than any other. Equal rain gives an equal
    band, so the result is deterministic.
    """
    best = (silver.where(F.col("municipio_inferido").isNotNull())
            .groupBy(F.col("municipio_inferido").alias("municipio"))
            .agg(F.max(F.struct("data", "precipitacao")).alias("b")))
    # A global sequence needs one ordered pass; it runs on one row per
    # municipality (bounded by the gazetteer), never on readings.
    ids = F.row_number().over(Window.orderBy("municipio")).cast("bigint")
    return best.select(
        ids.alias("id"), "municipio",
        alert_level_label(alert_band(F.col("b.precipitacao"))).alias("nivel_alerta"),
        F.col("b.data").alias("atualizacao"))


def latest_from_readings(bronze: DataFrame, mapping: DataFrame,
                         stations: DataFrame | None = None) -> DataFrame:
    """A1 + J7 without joining the readings to the mapping.

    Per-station latest dates (combined map-side) are joined to the mapping
    and reduced per municipality; the stations whose latest date is their
    municipality's latest are the targets (at most one row per station).
    The readings are then kept by a semi-join on (station, date) — broadcast
    when ``stations`` (a table bounding the station count) is small — so
    they are scanned and probed in place. Every reading on that date is
    kept, duplicates included.
    """
    located = (bronze.groupBy("codigo_posto").agg(F.max("data").alias("_smax"))
               .join(mapping.where(F.col("municipio_inferido").isNotNull())
                     .select("codigo_posto", F.col("municipio_inferido").alias("municipio")),
                     "codigo_posto"))
    latest = located.groupBy("municipio").agg(F.max("_smax").alias("_mmax"))
    targets = (located.join(latest, "municipio")
               .where(F.col("_smax") == F.col("_mmax"))
               .select("codigo_posto", "municipio", F.col("_smax").alias("data")))
    if stations is not None:
        targets = checked_broadcast(targets, bound=stations)
    return bronze.join(targets, ["codigo_posto", "data"]).select(
        "municipio", "codigo_posto", "data", "precipitacao")


def gold_from_readings(bronze: DataFrame, mapping: DataFrame) -> DataFrame:
    """The same grid computed from the readings and the station mapping,
    reducing *before* the join: ``max(struct(data, precipitacao))`` is
    decomposable, so each station is first reduced to its own latest
    (date, rain) — combined map-side, one row per station leaves the scan —
    then the per-station results are joined to the mapping and reduced per
    municipality. The readings are never shuffled or joined.
    """
    per_station = (bronze.groupBy("codigo_posto")
                   .agg(F.max(F.struct("data", "precipitacao")).alias("s")))
    located = per_station.join(
        mapping.where(F.col("municipio_inferido").isNotNull())
        .select("codigo_posto", "municipio_inferido"), "codigo_posto")
    best = (located.groupBy(F.col("municipio_inferido").alias("municipio"))
            .agg(F.max("s").alias("b")))
    ids = F.row_number().over(Window.orderBy("municipio")).cast("bigint")
    return best.select(
        ids.alias("id"), "municipio",
        alert_level_label(alert_band(F.col("b.precipitacao"))).alias("nivel_alerta"),
        F.col("b.data").alias("atualizacao"))


def alerts(gold: DataFrame) -> DataFrame:
    """Served rows: gold ordered by id, date as text (O1, F16)."""
    return gold.select("id", "municipio", "nivel_alerta",
                       F.col("atualizacao").cast("string").alias("atualizacao")).orderBy("id")
