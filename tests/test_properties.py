"""SURVEY §5 properties on the driver's data."""

from pyspark.sql import functions as F

from rainrisk.operators.match import station_municipality_map
from rainrisk.plans.medallion import gold_grid_risk, silver_rainfall
from rainrisk.sources import bindings as B
from tests.conftest import SF_SMALL


def test_mapping_one_row_per_code_and_silver_no_fan_out(spark):
    bronze = B.daily_readings(spark, SF_SMALL)
    mun = B.municipalities(spark, SF_SMALL)
    mapping = station_municipality_map(bronze, mun)
    n_codes = bronze.select("codigo_posto").distinct().count()
    assert mapping.count() == n_codes == mapping.select("codigo_posto").distinct().count()
    assert mapping.where(F.col("tipo_match").isNull()).count() == 0
    silver = silver_rainfall(bronze, mun)
    assert silver.count() == bronze.count()
    assert silver.select("codigo_posto", "data").distinct().count() == bronze.count()


def test_gold_one_row_per_matched_municipality(spark):
    bronze = B.daily_readings(spark, SF_SMALL)
    mun = B.municipalities(spark, SF_SMALL)
    gold = gold_grid_risk(bronze, mun).collect()
    matched = {r[0] for r in silver_rainfall(bronze, mun)
               .where(F.col("municipio_inferido").isNotNull())
               .select("municipio_inferido").distinct().collect()}
    assert {r.municipio for r in gold} == matched
    assert sorted(r.id for r in gold) == list(range(1, len(gold) + 1))
    assert [r.municipio for r in sorted(gold, key=lambda r: r.id)] == sorted(matched)
