"""Backfill plan: which (mesoregion, year) pages still need fetching."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainrisk.functions.domain import FIRST_HISTORY_YEAR, mesoregion_frame


def landed_units(readings: DataFrame) -> DataFrame:
    """(mesorregiao_id, ano) present in the landed data (partial aggregate)."""
    return (readings.where(F.col("mesorregiao_id").isNotNull())
            .select("mesorregiao_id", F.year("data").alias("ano")).distinct())


def backfill_plan(landed: DataFrame, as_of: dt.date,
                  first_year: int = FIRST_HISTORY_YEAR) -> DataFrame:
    """Regions × years ``first_year``..``year(as_of)`` minus what has landed.

    The current year is always planned again (its page grows every day), so
    nothing has to be deleted first (S15). The year list is generated per
    region by ``explode(sequence(...))`` — no cross join — and the landed
    units are removed with an anti join on the key.
    """
    spark = landed.sparkSession
    current = as_of.year
    plan = mesoregion_frame(spark).select(
        "mesorregiao_id", "mesorregiao_nome",
        F.explode(F.sequence(F.lit(first_year), F.lit(current))).alias("ano"))
    done = landed.where(F.col("ano") < current).select("mesorregiao_id", "ano")
    todo = plan.join(done, ["mesorregiao_id", "ano"], "left_anti")
    end = F.when(F.col("ano") == current, F.lit(as_of)).otherwise(
        F.make_date(F.col("ano"), F.lit(12), F.lit(31)))
    return todo.select("mesorregiao_id", "mesorregiao_nome", "ano",
                       F.make_date(F.col("ano"), F.lit(1), F.lit(1)).alias("data_inicio"),
                       end.alias("data_fim"))
