"""Silver and gold plans as single lazy DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainrisk.operators import features, grid, match
from rainrisk.operators.joins import clustered_alike

SILVER_COLUMNS = [
    "codigo_posto", "nome_posto", "data", "ano", "mes", "dia", "dia_semana",
    "precipitacao", "mesorregiao_id", "periodo_clima", "municipio_inferido",
    "latitude", "longitude", "tipo_match", "alerta_chuva",
    "dias_secos_consecutivos", "mm_7d",
]


def silver_rainfall(bronze: DataFrame, municipalities: DataFrame,
                    anchor: str = "reference", split_by_year: bool = False) -> DataFrame:
    """The silver daily table: bronze × station mapping + calendar + features.

    The mapping has one row per code, so the left join cannot fan out
    (silver rows = bronze rows). The join and the three windows share the
    key ``codigo_posto``: the fact is shuffled once, into as many tasks as its
    size needs (``joins.clustered_alike``), and sorted by date once; the
    calendar is added after that. With ``split_by_year``
    the windows run per (station, year) with carried-in state instead
    (``features.rainfall_features_split``), so no task holds more than one
    station-year of readings.
    """
    mapping = match.station_municipality_map(bronze, municipalities)
    if split_by_year:
        if anchor != "reference":
            raise ValueError("split_by_year supports the reference numbering only")
        # windows first, on the (station, year) exchange; the mapping join
        # after them is a join, which AQE can split when a station is hot
        feats = features.rainfall_features_split(bronze)
        feats = features.with_calendar(feats.join(mapping, "codigo_posto", "left"))
    else:
        fact, mapping = clustered_alike(bronze, mapping, "codigo_posto")
        feats = features.with_calendar(features.rainfall_features(fact.join(mapping, "codigo_posto", "left"), anchor))
    return features.with_alert_band(feats).select(*SILVER_COLUMNS)


def silver_rainfall_year(bronze: DataFrame, municipalities: DataFrame,
                         year: int | Column,
                         state: tuple[DataFrame, DataFrame] | None = None,
                         year_rows: DataFrame | None = None,
                         mapping: DataFrame | None = None) -> DataFrame:
    """Silver rows of one year only, equal to ``silver_rainfall`` filtered to
    that year: the year's readings plus each station's state carried in
    from earlier years (``features.rainfall_features_slice``). The daily
    load replaces the current year; this recomputes only that year instead
    of re-windowing the whole history. Station matching still reads the
    distinct (code, name) pairs of all years (two columns, combined
    map-side), since a new spelling can change a station's match.
    ``year`` may be a Column, e.g. a scalar subquery for "the latest year".
    ``state`` (from ``features.carry_state`` of the years before, stored once
    per year by ``flows.year_start_state``) replaces the history scan;
    ``mapping`` is the station mapping where the caller has it, and
    ``year_rows`` lets a caller pass the year's readings read with a
    partition filter (a filter on ``year(data)`` cannot prune ``ano=``
    directories).
    """
    # ``bronze`` is only needed for (code, name) pairs and, without ``state``,
    # for the history; the flows pass just the pairs when the state is stored
    if mapping is None:
        mapping = match.station_municipality_map(bronze, municipalities)
    if year_rows is None:
        year_rows = bronze.where(F.year("data") == year)
    history = None if state is not None else bronze.where(F.year("data") < year)
    year_rows, mapping = clustered_alike(year_rows, mapping, "codigo_posto")
    feats = features.rainfall_features_slice(year_rows, history, state=state)
    out = features.with_alert_band(features.with_calendar(feats.join(mapping, "codigo_posto", "left")))
    return out.select(*SILVER_COLUMNS)


def gold_grid_risk(bronze: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Gold straight from bronze: per-station reduction first, then the
    mapping (equal to ``grid.gold_grid_risk(silver_rainfall(...))``)."""
    mapping = match.station_municipality_map(bronze, municipalities)
    return grid.gold_from_readings(bronze, mapping)


__all__ = ["SILVER_COLUMNS", "silver_rainfall", "silver_rainfall_year", "gold_grid_risk"]
