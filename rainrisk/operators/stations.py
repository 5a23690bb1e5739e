"""Latest reading per feed station and the station table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainrisk.functions.text import upper_trim
from rainrisk.operators.joins import checked_broadcast


def latest_per_station(feed: DataFrame, order: list[str] | None = None,
                       carry: list[str] | None = None) -> DataFrame:
    """Each station's latest reading among rows with a city.

    ``max(struct(order..., carry...))`` per station replaces
    ``ROW_NUMBER() … ORDER BY data_hora DESC = 1``: the same row, found by an
    aggregate that combines map-side instead of sorting every reading of a
    station in one task. Ties on ``data_hora`` are broken by the later
    ``order`` fields, all descending (D5).
    """
    order = order or (["data_hora", "ingestao_ts", "nome_estacao"]
                      if "ingestao_ts" in feed.columns else ["data_hora", "nome_estacao"])
    carry = carry or [c for c in ("cidade", "chuva", "latitude", "longitude")
                      if c in feed.columns and c not in order]
    best = (feed.where(F.col("cidade").isNotNull())
            .groupBy("codigo_gmmc")
            .agg(F.max(F.struct(*order, *carry)).alias("b")))
    return best.select("codigo_gmmc", *[F.col(f"b.{c}").alias(c) for c in order + carry])


def station_table(latest: DataFrame, municipalities: DataFrame,
                  as_of: F.Column | None = None) -> DataFrame:
    """Stations × municipalities on ``UPPER(TRIM(name))`` (accents kept);
    a name listed twice in the dimension gives two rows, as in the reference.
    """
    st = latest.withColumn("municipio_nome", upper_trim(F.col("cidade")))
    mun = municipalities.select(upper_trim(F.col("municipio")).alias("municipio_nome"),
                                "codigo_ibge")
    cols = [F.col("codigo_gmmc").alias("estacao_codigo"), "nome_estacao", "municipio_nome",
            "codigo_ibge", "latitude", "longitude"]
    if as_of is not None:
        cols.append(as_of.alias("atualizado_em"))
    return st.join(checked_broadcast(mun, bound=municipalities), "municipio_nome",
                   "left").select(*cols)
