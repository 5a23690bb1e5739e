import datetime as dt

from pyspark.sql import functions as F

from rainrisk.plans import flows
from rainrisk.sources import bindings as B
from rainrisk.sources import daily
from tests.conftest import SF_SMALL


def test_daily_load_then_silver_gold(spark, scratch):
    raw, bronze = scratch("raw"), scratch("bronze")
    readings = B.daily_readings(spark, SF_SMALL)
    daily.land_raw_wide(B.daily_wide(readings), raw)
    units = flows.daily_load(spark, raw, bronze)
    assert {r.status for r in units.collect()} == {"ok"}
    # bronze holds every reading (plus empty days of the months on record)
    got = daily.read_bronze(spark, bronze).where(F.col("precipitacao").isNotNull()).count()
    assert got == readings.where(F.col("precipitacao").isNotNull()).count()
    # loading the same raw data again changes nothing
    flows.daily_load(spark, raw, bronze)
    assert daily.read_bronze(spark, bronze).where(F.col("precipitacao").isNotNull()).count() == got
    served = flows.build_silver_gold(spark, bronze, B.municipalities(spark, SF_SMALL),
                                     scratch("silver"), scratch("gold")).collect()
    # the same plan run lazily on the loaded bronze (it has a row for every
    # day of each month on record, so latest dates are month ends)
    from rainrisk.operators.grid import alerts
    from rainrisk.plans.medallion import gold_grid_risk
    direct = alerts(gold_grid_risk(daily.read_bronze(spark, bronze),
                                   B.municipalities(spark, SF_SMALL))).collect()
    assert [tuple(r) for r in served] == [tuple(r) for r in direct] and len(served) > 0


def test_pages_to_fetch_skips_landed_years(spark, scratch):
    bronze = scratch("bronze")
    plan = flows.pages_to_fetch(spark, bronze, dt.date(2026, 6, 30))  # empty bronze
    assert plan.count() == 5 * (2026 - 1961 + 1)
    b = spark.createDataFrame([(1, "A", dt.date(1990, 1, 1), 1.0, 2601)],
                              "codigo_posto bigint, nome_posto string, data date, "
                              "precipitacao double, mesorregiao_id int")
    daily.replace_bronze_partitions(b, bronze)
    plan = flows.pages_to_fetch(spark, bronze, dt.date(2026, 6, 30))
    assert plan.where("mesorregiao_id = 2601 AND ano = 1990").count() == 0
    assert plan.count() == 5 * 66 - 1


def test_refresh_year_equals_full_build(spark, scratch):
    bronze_path, silver_path = scratch("bronze"), scratch("silver")
    readings = B.daily_readings(spark, SF_SMALL)
    daily.replace_bronze_partitions(readings, bronze_path)
    mun = B.municipalities(spark, SF_SMALL)
    full = flows.build_silver_gold(spark, bronze_path, mun, silver_path, scratch("gold")).collect()
    before = sorted(spark.read.parquet(silver_path).collect())
    last = max(r.ano for r in spark.read.parquet(silver_path).select("ano").distinct().collect())
    served = flows.refresh_silver_year(spark, bronze_path, mun, silver_path, scratch("gold2"),
                                       last).collect()
    assert sorted(spark.read.parquet(silver_path).collect()) == before
    assert [tuple(r) for r in served] == [tuple(r) for r in full]
    # with the stored year-start state (computed on the first run, reused after)
    state = scratch("state")
    for _ in range(2):
        served = flows.refresh_silver_year(spark, bronze_path, mun, silver_path,
                                           scratch("gold3"), last, state_path=state).collect()
        assert sorted(spark.read.parquet(silver_path).collect()) == before
        assert [tuple(r) for r in served] == [tuple(r) for r in full]


def test_daily_load_files_reports_each_file(spark, scratch):
    import os

    import pandas as pd
    base = scratch("legacy").removeprefix("file:")
    os.makedirs(base)
    days = {f"{d:02d}": ["1,5"] for d in range(1, 32)}
    good = pd.DataFrame({"Código": [1], "Posto": ["A"], "Mês/Ano": ["jan/2020"], **days,
                         "mesorregiao_id": [2601], "ano_ref": [2020]})
    good.to_parquet(f"{base}/Sertao_Pernambucano_2020.parquet")
    wrong_year = good.assign(**{"Mês/Ano": ["jan/2019"], "ano_ref": [2019]})
    wrong_year.to_parquet(f"{base}/Mata_Pernambucana_2020.parquet")
    good.drop(columns=["Posto"]).to_parquet(f"{base}/Agreste_Pernambucano_2020.parquet")
    with open(f"{base}/Metropolitana_Recife_2020.parquet", "wb") as fh:
        fh.write(b"broken")
    bronze = scratch("bronze")
    report = {os.path.basename(r._file): r.status
              for r in flows.daily_load_files(spark, base, bronze, year=2020,
                                              raise_on_failure=False).collect()}
    assert report == {"Sertao_Pernambucano_2020.parquet": "ok",
                      "Mata_Pernambucana_2020.parquet": "inconsistent",
                      "Agreste_Pernambucano_2020.parquet": "missing_columns",
                      "Metropolitana_Recife_2020.parquet": "unreadable_or_empty"}
    loaded = daily.read_bronze(spark, bronze).collect()
    assert len(loaded) == 31 and {r.codigo_posto for r in loaded} == {1}
    assert {r.precipitacao for r in loaded} == {1.5}


def _files(scratch):
    import os

    import pandas as pd
    base = scratch("raw-files").removeprefix("file:")
    os.makedirs(base)
    days = {f"{d:02d}": ["1,5"] for d in range(1, 32)}
    row = pd.DataFrame({"Código": [1], "Posto": ["A"], "Mês/Ano": ["jan/2020"], **days,
                        "mesorregiao_id": [2601], "ano_ref": [2020]})
    return base, row


def _load(spark, scratch, base, **kw):
    import os
    bronze = scratch("bronze")
    report = {os.path.basename(r._file): r.status
              for r in flows.daily_load_files(spark, base, bronze, raise_on_failure=False, **kw).collect()}
    return report, daily.read_bronze(spark, bronze), bronze


def test_files_with_text_and_number_day_columns(spark, scratch):
    base, row = _files(scratch)
    row.to_parquet(f"{base}/A_2020.parquet")
    row.assign(Código=2, mesorregiao_id=2602, **{"07": [2.5], "08": [3]}).to_parquet(f"{base}/B_2020.parquet")
    report, got, _ = _load(spark, scratch, base)
    assert set(report.values()) == {"ok"}
    rain = {(r.codigo_posto, r.data.day): r.precipitacao for r in got.collect()}
    assert rain[1, 7] == 1.5 and rain[2, 7] == 2.5 and rain[2, 8] == 3.0 and len(rain) == 62


def test_padded_headers_and_region_by_position_are_per_file(spark, scratch):
    base, row = _files(scratch)
    row.to_parquet(f"{base}/A_2020.parquet")
    row.rename(columns={"Posto": " Posto "}).assign(Código=2, mesorregiao_id=2602).to_parquet(f"{base}/B_2020.parquet")
    other = row.rename(columns={"mesorregiao_id": "regiao"}).assign(Código=3, regiao=2604)
    other.to_parquet(f"{base}/C_2020.parquet")
    report, got, _ = _load(spark, scratch, base)
    assert set(report.values()) == {"ok"}
    assert {(r.codigo_posto, r.nome_posto, r.mesorregiao_id) for r in got.collect()} == \
        {(1, "A", 2601), (2, "A", 2602), (3, "A", 2604)}


def test_file_damaged_part_way_is_refused_whole(spark, scratch):
    import pandas as pd
    import pyarrow as pa
    import pyarrow.parquet as pq
    base, row = _files(scratch)
    row.to_parquet(f"{base}/A_2020.parquet")
    _, before, bronze = _load(spark, scratch, base)
    many = pd.concat([row.assign(Código=i, Posto=f"name {i}") for i in range(2000)])
    table = pa.Table.from_pandas(many, preserve_index=False)
    pq.write_table(table, f"{base}/A_2020.parquet", row_group_size=500)
    start = pq.ParquetFile(f"{base}/A_2020.parquet").metadata.row_group(2).column(1)
    at = start.dictionary_page_offset or start.data_page_offset
    with open(f"{base}/A_2020.parquet", "r+b") as fh:
        fh.seek(at)
        fh.write(b"\xff" * 64)
    report = flows.daily_load_files(spark, base, bronze, raise_on_failure=False).collect()
    assert [r.status for r in report] == ["damaged"]
    assert {r.codigo_posto for r in daily.read_bronze(spark, bronze).collect()} == {1}  # as before


def test_two_files_of_a_unit_the_last_written_counts(spark, scratch):
    import os

    import pandas as pd
    base, row = _files(scratch)
    for name, code, at in (("Mata_2020", 1, 3000), ("MataCopia_2020", 2, 2000), ("Mata_2021", 3, 1000)):
        row.assign(Código=code, **{"Mês/Ano": f"jan/{name[-4:]}", "ano_ref": int(name[-4:])}).to_parquet(f"{base}/{name}.parquet")
        os.utime(f"{base}/{name}.parquet", (at, at))
    two = pd.concat([row.assign(Código=4), row.assign(Código=5, mesorregiao_id=2602)])   # newer for 2602 only
    two.to_parquet(f"{base}/Duas_2020.parquet")
    os.utime(f"{base}/Duas_2020.parquet", (2500, 2500))
    report, got, _ = _load(spark, scratch, base)
    assert report == {"Mata_2020.parquet": "ok", "MataCopia_2020.parquet": "superseded", "Mata_2021.parquet": "ok", "Duas_2020.parquet": "ok"}
    rows = sorted({(r.codigo_posto, r.mesorregiao_id, r.data.year) for r in got.collect()})
    assert rows == [(1, 2601, 2020), (3, 2601, 2021), (5, 2602, 2020)] and got.count() == 93
    flows.daily_load_files(spark, base, scratch("bronze"))   # a superseded file is no failure


def test_a_newer_file_without_rows_of_its_year_replaces_nothing(spark, scratch):
    import os
    base, row = _files(scratch)
    row.to_parquet(f"{base}/A_2020.parquet")
    row.assign(Código=2, **{"Mês/Ano": "jan/2019", "ano_ref": 2019}).to_parquet(f"{base}/B_2020.parquet")
    os.utime(f"{base}/A_2020.parquet", (1000, 1000))
    report, got, _ = _load(spark, scratch, base)
    assert report == {"A_2020.parquet": "ok", "B_2020.parquet": "inconsistent"}
    assert {r.codigo_posto for r in got.collect()} == {1}


def test_any_file_name_and_no_sub_folders(spark, scratch):
    import os
    base, row = _files(scratch)
    for i, name in enumerate(["Mata[1]_2020", "Mata 100%_2020", "Sertão {a}*?_2020", "a+b%20c_2020", "#_2020"]):
        row.assign(Código=i, mesorregiao_id=2601 + i).to_parquet(f"{base}/{name}.parquet")
    for sub in ("old", "ano=2019"):
        os.makedirs(f"{base}/{sub}")
        row.assign(Código=99).to_parquet(f"{base}/{sub}/Mata_2020.parquet")
    report, got, _ = _load(spark, scratch, base)
    assert len(report) == 5 and set(report.values()) == {"ok"}
    assert sorted({r.codigo_posto for r in got.collect()}) == [0, 1, 2, 3, 4]
    assert len(_load(spark, scratch, base, year=2019)[0]) == 0


def test_any_number_of_layouts_is_one_scan_and_one_exchange(spark, scratch):
    from rainrisk.sources.raw_files import RawFiles
    base, row = _files(scratch)
    for i in range(24):
        cells = {f"{d:02d}": [float(d)] if (d * 7 + i) % 3 else ["2,5"] for d in range(1, 32 - i % 4)}
        row.drop(columns=[c for c in row if c.isdigit()]).assign(Código=i, **{f" {c}" if i % 2 else c: v for c, v in cells.items()},
                                                                 mesorregiao_id=2601 + i).to_parquet(f"{base}/R{i}_2020.parquet")
    files = RawFiles(spark, base)
    assert len({r["names"] for r in files.found}) == 4   # and as many more layouts by type
    seen = files._seen()._jdf.queryExecution().executedPlan().toString()
    assert seen.count("BatchScan") == 1 and seen.count("Exchange hashpartitioning") == 1 and "Union" not in seen
    report = files.report()
    assert {r.status for r in report.collect()} == {"ok"}
    long = files.rows(report)
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan") == 1 and "Exchange" not in plan
    # the footer's order: 24 files, 31 days of January less up to three at the end
    assert long.count() == sum(31 - i % 4 for i in range(24))
    rain = {(r.codigo_posto, r.data.day): r.precipitacao for r in long.collect()}
    assert all(v == (float(d) if (d * 7 + i) % 3 else 2.5) for (i, d), v in rain.items())


def test_cells_of_other_types(spark, scratch):
    import pyarrow as pa
    import pyarrow.parquet as pq
    base, row = _files(scratch)
    t = pa.Table.from_pandas(row.drop(columns=["01", "02", "03", "04"]), preserve_index=False)
    for name, col in (("01", pa.array(["7,5"]).dictionary_encode()), ("02", pa.array([[1, 2]])), ("03", pa.array([None], pa.int8())),
                      ("04", pa.array([float("nan")]))):
        t = t.add_column(3, name, col)
    t = t.set_column(t.schema.get_field_index("Código"), "Código", pa.array([12.0]))
    pq.write_table(t, f"{base}/A_2020.parquet")
    report, got, _ = _load(spark, scratch, base)
    rain = {r.data.day: r.precipitacao for r in got.collect()}
    assert report == {"A_2020.parquet": "ok"} and rain[1] == 7.5 and rain[2] is rain[3] is rain[4] is None and rain[5] == 1.5
    assert {r.codigo_posto for r in got.collect()} == {12}


def test_file_without_year_replaces_nothing(spark, scratch):
    base, row = _files(scratch)
    row.to_parquet(f"{base}/A_2020.parquet")
    row.assign(Código=9).to_parquet(f"{base}/extra.parquet")
    report, got, _ = _load(spark, scratch, base)
    assert report == {"A_2020.parquet": "ok", "extra.parquet": "no_year_in_name"}
    assert {r.codigo_posto for r in got.collect()} == {1}


def test_bad_file_stops_the_load_before_the_write(spark, scratch):
    import pytest
    base, row = _files(scratch)
    row.to_parquet(f"{base}/A_2020.parquet")
    row.drop(columns=["Posto"]).to_parquet(f"{base}/B_2020.parquet")
    bronze = scratch("bronze")
    with pytest.raises(ValueError, match="1 units"):
        flows.daily_load_files(spark, base, bronze)
    from rainrisk.sources.sinks import path_exists
    assert not path_exists(spark, bronze)


def test_partitioned_writes_make_few_files(spark, scratch):
    import glob
    readings = B.daily_readings(spark, SF_SMALL)
    counts = []
    for n in ("8", "64"):
        was = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            path = scratch("bronze")
            daily.replace_bronze_partitions(readings, path)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", was)
        counts.append(len(glob.glob(f"{path.removeprefix('file:')}/ano=*/mesorregiao_id=*/*.parquet")))
    units = readings.select(F.year("data"), "mesorregiao_id").distinct().count()
    assert counts[0] == counts[1] == units


def test_hot_partition_keeps_several_writers(spark, scratch):
    import glob
    was = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        path = scratch("bronze")
        hot = spark.range(0, 60000, 1, 6).select(
            F.col("id").alias("codigo_posto"), F.lit("A").alias("nome_posto"), F.lit(dt.date(2020, 1, 1)).alias("data"),
            F.rand(1).alias("precipitacao"), F.lit(2601).alias("mesorregiao_id"))
        daily.replace_bronze_partitions(hot, path)
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(glob.glob(f"{path.removeprefix('file:')}/ano=2020/mesorregiao_id=2601/*.parquet")) > 1


def test_refresh_after_reload_and_new_spelling_equals_full_build(spark, scratch):
    """An earlier year reloaded and a spelling added: refresh gives what a full build gives."""
    bronze, silver, state = scratch("bronze"), scratch("silver"), scratch("state")
    mun = spark.createDataFrame([(1, "Recife", 1.0, 1.0), (2, "Barra", 2.0, 2.0), (3, "Olinda", 3.0, 3.0)],
                                "codigo_ibge int, municipio string, latitude double, longitude double")

    def load(rows):
        daily.replace_bronze_partitions(spark.createDataFrame(
            rows, "codigo_posto bigint, nome_posto string, data date, precipitacao double, mesorregiao_id int"), bronze)

    def year(y, rain, name="Posto Barra", code=1):
        return [(code, name, dt.date(y, 12, d), rain(d), 2601) for d in range(20, 32)]

    load(year(2023, lambda d: 0.0) + year(2024, lambda d: 5.0) + year(2025, lambda d: 0.0)
         + year(2023, lambda d: 0.0, "Olinda", 2))
    flows.build_silver_gold(spark, bronze, mun, silver, scratch("g"))
    flows.refresh_silver_year(spark, bronze, mun, silver, scratch("g"), 2025, state_path=state)
    load(year(2024, lambda d: 0.0 if d > 24 else 7.0))               # reload of an earlier year
    load(year(2025, lambda d: 0.0, "Recife"))                        # a new spelling, better match
    assert flows.first_stale_year(spark, bronze, silver, 2025) == 2024
    gold = scratch("gold")
    served = flows.refresh_silver_year(spark, bronze, mun, silver, gold, 2025, state_path=state).collect()
    full_silver, full_gold = scratch("fs"), scratch("fg")
    full = flows.build_silver_gold(spark, bronze, mun, full_silver, full_gold).collect()
    cols = spark.read.parquet(full_silver).columns
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(spark.read.parquet(silver).select(cols).collect(), key=key) == \
        sorted(spark.read.parquet(full_silver).collect(), key=key)
    assert [tuple(r) for r in served] == [tuple(r) for r in full]
    assert flows.first_stale_year(spark, bronze, silver, 2025) == 2025


def _lose_content(folder, years):
    """Make the files of ``years`` unreadable; listings (size and time) stay."""
    import glob
    import os
    n = 0
    for y in years:
        for f in glob.glob(f"{folder.removeprefix('file:')}/ano={y}/**/*.parquet", recursive=True):
            at = os.stat(f)
            with open(f, "wb") as fh:
                fh.write(b"\0" * at.st_size)
            os.utime(f, ns=(at.st_atime_ns, at.st_mtime_ns))
            n += 1
    return n


def test_daily_refresh_reads_no_earlier_year(spark, scratch):
    """With the kept state a daily refresh opens no file of an earlier year, in bronze or silver."""
    bronze, silver, state = scratch("bronze"), scratch("silver"), scratch("state")
    readings = B.daily_readings(spark, SF_SMALL)
    mun = B.municipalities(spark, SF_SMALL)
    last = readings.agg(F.max(F.year("data"))).first()[0]
    daily.replace_bronze_partitions(readings, bronze)
    flows.build_silver_gold(spark, bronze, mun, silver, scratch("g"))
    flows.refresh_silver_year(spark, bronze, mun, silver, scratch("g"), last, state_path=state)
    years = [r[0] for r in readings.select(F.year("data")).distinct().collect()]
    wetter = readings.where(F.year("data") == last).withColumn("precipitacao", F.col("precipitacao") + 60)
    daily.replace_bronze_partitions(wetter, bronze)
    full = flows.build_silver_gold(spark, bronze, mun, scratch("fs"), scratch("fg")).collect()
    want = sorted(daily.read_bronze(spark, bronze, year=last).collect(), key=str)
    assert _lose_content(bronze, [y for y in years if y < last]) and _lose_content(silver, [y for y in years if y < last])
    served = flows.refresh_silver_year(spark, bronze, mun, silver, scratch("gold"), last, state_path=state).collect()
    assert [tuple(r) for r in served] == [tuple(r) for r in full] and len(served) > 0
    got = spark.read.parquet(f"{silver}/ano={last}").select(*daily.BRONZE_COLUMNS)
    assert sorted(got.collect(), key=str) == want


def test_silver_written_by_someone_else_is_compared_again(spark, scratch):
    """The kept mapping counts only while silver is as the last refresh left it."""
    bronze, silver, state = scratch("bronze"), scratch("silver"), scratch("state")
    rows = [(1, "Posto Barra", dt.date(y, 1, d), 1.0, 2601) for y in (2023, 2024) for d in (1, 2)]
    daily.replace_bronze_partitions(spark.createDataFrame(
        rows, "codigo_posto bigint, nome_posto string, data date, precipitacao double, mesorregiao_id int"), bronze)
    schema = "codigo_ibge int, municipio string, latitude double, longitude double"
    barra, other = spark.createDataFrame([(2, "Barra", 2.0, 2.0)], schema), spark.createDataFrame([(3, "Posto", 3.0, 3.0)], schema)

    def matched():
        return {(r.ano, r.municipio_inferido) for r in spark.read.parquet(silver).collect()}
    flows.build_silver_gold(spark, bronze, barra, silver, scratch("g"))
    flows.refresh_silver_year(spark, bronze, barra, silver, scratch("g"), 2024, state_path=state)
    flows.build_silver_gold(spark, bronze, other, silver, scratch("g"))
    assert matched() == {(2023, "Posto"), (2024, "Posto")}
    flows.refresh_silver_year(spark, bronze, barra, silver, scratch("g"), 2024, state_path=state)
    assert matched() == {(2023, "Barra"), (2024, "Barra")}
    flows.refresh_silver_year(spark, bronze, other, silver, scratch("g"), 2024, state_path=state)   # by the kept mapping
    assert matched() == {(2023, "Posto"), (2024, "Posto")}
