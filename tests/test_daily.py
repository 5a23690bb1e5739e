import datetime as dt

import pytest

from rainrisk.sources import daily

DAYS = daily.DAY_COLUMNS


def wide_rows(spark, rows, header=None, region=True, tag=True):
    cols = header or ["Código", " Posto ", "Mês/Ano", *DAYS]
    if region:
        cols = cols + ["mesorregiao_id"]
    if tag:
        cols = cols + ["ano_ref"]
    from pyspark.sql import types as T
    ints = {"Código", "mesorregiao_id", "ano_ref"}
    schema = T.StructType([T.StructField(c, T.LongType() if c in ints else T.StringType())
                           for c in cols])
    return spark.createDataFrame(rows, schema)


def make(code, name, my, cells, region=2601, tag=2025):
    cells = list(cells) + [None] * (31 - len(cells))
    return (code, name, my, *cells, region, tag)


def test_shape_daily_parsing_and_guards(spark):
    rows = [
        make(10, "A", "JAN/2025", [" 1,5 ", "-", "nan", "", "None", "5d", "1.234,5", "7"]),
        make(10, "A", "abr/2025", ["1"] * 31),          # 31 April dropped
        make(11, "B", "fev/2024", ["2"] * 29),          # wrong year for the file: dropped
        make(12, "C", "xyz/2025", ["3"]),               # unknown month: dropped
    ]
    out = daily.shape_daily(wide_rows(spark, rows)).orderBy("codigo_posto", "data").collect()
    jan = [r for r in out if r.data.month == 1]
    assert len(jan) == 31 and all(r.nome_posto == "A" for r in jan)
    assert [r.precipitacao for r in jan[:8]] == [1.5, None, None, None, None, None, None, 7.0]
    assert len([r for r in out if r.data.month == 4]) == 30
    assert {r.codigo_posto for r in out} == {10}
    assert out[0].mesorregiao_id == 2601


def test_header_rules(spark):
    # region not named: the second-last column is taken as the region
    rows = [(1, "A", "mar/2025", *(["1"] * 31), 2603, 2025)]
    df = spark.createDataFrame(rows, ["Código", "Posto", "Mês/Ano", *DAYS, "x", "ano_ref"])
    out = daily.shape_daily(df)
    assert {r.mesorregiao_id for r in out.collect()} == {2603}
    bad = spark.createDataFrame([(1, "x")], ["Código", "Posto"])
    with pytest.raises(daily.MissingColumns):
        daily.shape_daily(bad)


def test_page_year_guard(spark):
    rows = [
        make(1, "A", "jan/2025", ["1"], tag=2025),
        make(2, "B", "jan/2024", ["1"], tag=2025),   # other year in the page: row dropped
        make(3, "C", "jan/2023", ["1"], region=2602, tag=2025),  # page lacks 2025: all gone
        make(4, "D", "janeiro", ["1"], region=2603, tag=2025),   # no year at all: all gone
        make(5, "E", "jan/2025", ["1"], region=None, tag=2025),  # unknown region is a page
    ]
    kept = daily.guard_page_year(daily.normalise_header(wide_rows(spark, rows)))
    assert sorted(r["Código"] for r in kept.collect()) == [1, 5]


def test_replace_partitions_idempotent_and_scoped(spark, scratch):
    path = scratch("bronze")
    b = spark.createDataFrame(
        [(1, "A", dt.date(2024, 1, 1), 1.0, 2601), (2, "B", dt.date(2024, 1, 1), 2.0, 2602),
         (1, "A", dt.date(2025, 1, 1), 3.0, 2601)],
        "codigo_posto bigint, nome_posto string, data date, precipitacao double, "
        "mesorregiao_id int")
    daily.replace_bronze_partitions(b, path)
    daily.replace_bronze_partitions(b, path)  # running a load twice changes nothing
    assert daily.read_bronze(spark, path).count() == 3
    # a new 2024 load for region 2601 replaces only (2024, 2601)
    again = spark.createDataFrame([(9, "Z", dt.date(2024, 2, 1), 9.0, 2601)], b.schema)
    daily.replace_bronze_partitions(again, path)
    got = sorted((r.codigo_posto, r.data.year) for r in daily.read_bronze(spark, path).collect())
    assert got == [(1, 2025), (2, 2024), (9, 2024)]
    # an empty load touches nothing
    daily.replace_bronze_partitions(again.limit(0), path)
    assert daily.read_bronze(spark, path, year=2024).count() == 2


def test_land_and_read_raw_both_layouts(spark, scratch):
    rows = [make(1, "A", "jan/2025", ["1,0"], tag=2025), make(2, "B", "jan/2024", ["2"], tag=2024)]
    raw = scratch("raw")
    daily.land_raw_wide(wide_rows(spark, rows), raw)
    only = daily.read_raw_wide(spark, raw, year=2025)
    assert [r.codigo_posto for r in daily.shape_daily(only).collect()] == [1] * 31
    # legacy flat files: the expected year comes from the file name
    legacy = scratch("legacy")
    import os

    import pandas as pd
    local = legacy.removeprefix("file:")  # pandas writes the legacy files locally
    os.makedirs(local)
    cols = ["Código", "Posto", "Mês/Ano", *DAYS, "mesorregiao_id", "ano_ref"]
    pd.DataFrame([rows[0]], columns=cols).to_parquet(f"{local}/Mata_Pernambucana_2025.parquet")
    pd.DataFrame([rows[1]], columns=cols).to_parquet(f"{local}/Mata_Pernambucana_2023.parquet")
    wide = daily.read_raw_wide(spark, legacy, legacy_glob=True)
    out = daily.shape_daily(wide).collect()
    assert {r.codigo_posto for r in out} == {1}  # 2024 rows in the 2023 file are dropped
    one_year = daily.read_raw_wide(spark, legacy, year=2023, legacy_glob=True)
    assert one_year.count() == 1 and daily.shape_daily(one_year).count() == 0
    assert daily.empty_like(wide).count() == 0
