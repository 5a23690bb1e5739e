import datetime as dt

from rainrisk.operators.features import rainfall_features


def series(spark, values):
    d0 = dt.date(2025, 1, 1)
    rows = [(1, d0 + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "codigo_posto bigint, data date, precipitacao double")


def test_islands_dry_spell_moving_mean(spark):
    vals = [0.0, None, 5.0, 0.0, 0.0, -1.0, 0.0, 3.0, 2.0, 0.0]
    out = rainfall_features(series(spark, vals)).orderBy("data").collect()
    assert [r.island_id for r in out] == [0, 0, 1, 1, 1, 1, 1, 2, 3, 3]
    # the rainy day takes number 1, so the first dry day after rain counts 2;
    # a negative reading takes a number but shows 0; NULL counts as dry
    assert [r.dias_secos_consecutivos for r in out] == [1, 2, 0, 2, 3, 0, 5, 0, 0, 2]
    # 7-row mean, NULLs skipped, partial at the start
    assert out[0].mm_7d == 0.0 and out[2].mm_7d == 2.5
    assert abs(out[7].mm_7d - (5 + 0 + 0 - 1 + 0 + 3) / 6) < 1e-12
    assert abs(out[9].mm_7d - (0 + 0 - 1 + 0 + 3 + 2 + 0) / 7) < 1e-12


def test_dry_anchor_counts_dry_rows_only(spark):
    vals = [0.0, 5.0, 0.0, 0.0, -1.0, 0.0]
    out = rainfall_features(series(spark, vals), anchor="dry").orderBy("data").collect()
    assert [r.dias_secos_consecutivos for r in out] == [1, 0, 1, 2, 0, 3]


def test_all_null_station(spark):
    out = rainfall_features(series(spark, [None, None])).orderBy("data").collect()
    assert [r.dias_secos_consecutivos for r in out] == [1, 2]
    assert out[0].mm_7d is None
