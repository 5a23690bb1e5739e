import datetime as dt

from pyspark.sql import functions as F

from rainrisk.operators.features import rainfall_features, rainfall_features_slice
from rainrisk.plans.medallion import silver_rainfall, silver_rainfall_year
from rainrisk.sources import bindings as B
from tests.conftest import SF_SMALL


def rows(spark, vals, start=dt.date(2024, 12, 25), code=1):
    data = [(code, start + dt.timedelta(days=i), v) for i, v in enumerate(vals)]
    return spark.createDataFrame(data, "codigo_posto bigint, data date, precipitacao double")


def test_slice_equals_full_on_edges(spark):
    # year boundary inside a dry run, a rain island, NULLs and a negative reading
    vals = [0.0, 3.0, 0.0, None, 0.0, -1.0, 0.0, 0.0, 0.0, 5.0, 0.0, 0.0, None, 0.0]
    df = rows(spark, vals).unionByName(rows(spark, [0.0] * 9, code=2))
    df = df.unionByName(rows(spark, [None, 0.0], start=dt.date(2025, 3, 1), code=3))
    full = {(r.codigo_posto, r.data): (r.dias_secos_consecutivos, r.mm_7d)
            for r in rainfall_features(df).collect() if r.data.year == 2025}
    part = rainfall_features_slice(df.where(F.year("data") == 2025),
                                   df.where(F.year("data") < 2025))
    got = {(r.codigo_posto, r.data): (r.dias_secos_consecutivos, r.mm_7d) for r in part.collect()}
    assert got == full


def test_silver_year_equals_full_silver(spark):
    bronze = B.daily_readings(spark, SF_SMALL)
    mun = B.municipalities(spark, SF_SMALL)
    years = sorted({r[0] for r in bronze.select(F.year("data")).distinct().collect()})
    full = silver_rainfall(bronze, mun)
    for y in (years[0], years[len(years) // 2], years[-1]):
        want = sorted(full.where(F.col("ano") == y).collect())
        got = sorted(silver_rainfall_year(bronze, mun, y).collect())
        assert got == want, y


def test_split_equals_full(spark):
    from rainrisk.operators.features import rainfall_features_split
    # year boundaries inside dry runs and islands, a one-reading year, gaps of years
    vals = [0.0, 3.0, 0.0, None, 0.0, -1.0, 0.0, 0.0, 0.0, 5.0, 0.0, 0.0, None, 0.0]
    df = rows(spark, vals)
    df = df.unionByName(rows(spark, [0.0, 2.0, 0.0], start=dt.date(2025, 12, 31)))
    df = df.unionByName(rows(spark, [0.0, 0.0], start=dt.date(2028, 6, 1)))
    df = df.unionByName(rows(spark, [0.0] * 9, code=2)).unionByName(
        rows(spark, [None, 7.0], start=dt.date(2025, 3, 1), code=3))
    df = df.dropDuplicates(["codigo_posto", "data"])
    key = lambda r: (r.codigo_posto, r.data)
    full = {key(r): (r.island_id, r.dias_secos_consecutivos, r.mm_7d)
            for r in rainfall_features(df).collect()}
    split = {key(r): (r.island_id, r.dias_secos_consecutivos, r.mm_7d)
             for r in rainfall_features_split(df).collect()}
    assert split == full


def test_split_equals_full_on_driver_data(spark):
    from rainrisk.operators.features import rainfall_features_split
    b = B.daily_readings(spark, SF_SMALL).select("codigo_posto", "data", "precipitacao")
    assert sorted(rainfall_features_split(b).collect()) == sorted(rainfall_features(b).collect())
