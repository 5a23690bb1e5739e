"""Municipality coordinates from a gazetteer table.

The reference asks a web geocoder one municipality at a time (first hit,
misses dropped). Here the lookup is a join against a gazetteer table: the
gazetteer is first reduced to its best entry per cleaned name (a partial
aggregate), then joined on that key; no service is called and nothing runs
row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainrisk.functions.text import clean_string


def best_entries(gazetteer: DataFrame, name_col: str = "nome",
                 rank_col: str = "rank") -> DataFrame:
    return (gazetteer.groupBy(clean_string(F.col(name_col)).alias("_key"))
            .agg(F.min(F.struct(rank_col, "latitude", "longitude")).alias("_g")))


def geocode(municipalities: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """codigo_ibge, municipio, latitude, longitude for names found (inner)."""
    g = best_entries(gazetteer)
    return (municipalities.withColumn("_key", clean_string(F.col("municipio")))
            .join(g, "_key")
            .select(F.col("codigo_ibge").cast("int").alias("codigo_ibge"), "municipio",
                    F.col("_g.latitude").alias("latitude"),
                    F.col("_g.longitude").alias("longitude")))


class DuplicateKey(ValueError):
    """Two rows of the dimension have one key."""


def write_dimension(df: DataFrame, path: str, key: str = "codigo_ibge") -> None:
    """Create-or-replace the dimension, refused if its key repeats (Q2)."""
    twice = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(3).collect()
    if twice:
        raise DuplicateKey(f"{key} repeats: {[r[0] for r in twice]}")
    df.orderBy("municipio").write.mode("overwrite").parquet(path)
