import datetime as dt

from pyspark.sql import functions as F

from rainrisk.operators import quality as Q
from rainrisk.sources.backfill import backfill_plan
from rainrisk.sources.daily import read_raw_csv
from rainrisk.sources.html_table import table_rows


def test_html_table_rows(spark):
    html = ("<html><table id='legenda'><tr><th>Código</th></tr><tr><td>999</td></tr></table>"
            "<TABLE class=x ID=\"tbMonPluvio\"><tr><th>Código</th><th>Posto</th><th>01</th></tr>"
            "<tr><td> 12 </td><td><b>S&atilde;o &amp; Co</b></td><td>1.234,5</td></tr>"
            "<tr><td>Total</td><td></td><td>-</td></tr>"
            "<tr><td colspan=3>rodapé</td></tr></TABLE></html>")
    pages = spark.createDataFrame([(1, html), (2, "<p>no table</p>")], "page_id int, html string")
    rows = table_rows(pages, columns=["Código", "Posto", "01", "02"]).orderBy("row_no").collect()
    assert [(r["Código"], r["Posto"], r["01"], r["02"]) for r in rows] == \
        [("12", "São & Co", "1.234,5", None), ("Total", "", "-", None), ("rodapé", "rodapé", "rodapé", None)]
    from rainrisk.sources.daily import numeric_code_rows
    kept = numeric_code_rows(table_rows(pages, columns=["Código"])).collect()
    assert [r["Código"] for r in kept] == [12]


def test_backfill_plan_current_year_always(spark):
    landed = spark.createDataFrame([(2601, 2024), (2601, 2025), (2602, 1961)],
                                   "mesorregiao_id int, ano int")
    plan = backfill_plan(landed, dt.date(2025, 3, 9), first_year=2023).collect()
    got = {(r.mesorregiao_id, r.ano): (r.data_inicio, r.data_fim) for r in plan}
    assert (2601, 2024) not in got and (2601, 2025) in got
    assert got[(2601, 2025)] == (dt.date(2025, 1, 1), dt.date(2025, 3, 9))
    assert got[(2603, 2023)] == (dt.date(2023, 1, 1), dt.date(2023, 12, 31))
    assert len(got) == 5 * 3 - 1


def test_quality_reports(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2025, 1, 1), 2601), (1, dt.date(2025, 1, 1), 2699), (None, None, None)],
        "codigo_posto bigint, data date, mesorregiao_id int")
    nn = {r.column_name: r.failing_rows for r in Q.not_null(df, "t", ["codigo_posto", "data"]).collect()}
    assert nn == {"codigo_posto": 1, "data": 1}
    assert Q.unique_combination(df, "t", ["codigo_posto", "data"]).first().failing_rows == 1
    acc = Q.accepted_values(df, "t", {"mesorregiao_id": [2601, 2602]}).first()
    assert acc.failing_rows == 1  # NULL passes


def test_file_integrity_csv_statuses(spark, scratch):
    import os
    base = scratch("csv").removeprefix("file:")
    os.makedirs(base)
    files = {
        "Sertao_2020.csv": "Código,Mês/Ano,ano_ref\n1,jan/2020,2020\n2,fev/2020,2020\n",
        "Sertao_2021.csv": "Código,Mês/Ano,ano_ref\n1,jan/2021,2021\n2,fev/2020,2020\n",
        "Sertao_2022.csv": "Código,Mês/Ano,ano_ref\n1,jan/2022,\n",
        "Sertao.csv": "Código,Mês/Ano,ano_ref\n1,jan/2023,2023\n",
        "Agreste_2019.csv": "Código,Mês/Ano,ano_ref\n1,jan/2019,2018\n",
    }
    for name, text in files.items():
        with open(f"{base}/{name}", "w") as fh:
            fh.write(text)
    raw = read_raw_csv(spark, base)
    units = Q.unit_integrity(raw, ["_file"], F.regexp_extract("_file", r"_(\d{4})\.csv$", 1)
                             .try_cast("bigint"), year_col="ano_ref")
    got = {r._file: r.status for r in units.collect()}
    assert got == {"Sertao_2020.csv": "ok", "Sertao_2021.csv": "inconsistent",
                   "Sertao_2022.csv": "no_valid_values", "Sertao.csv": "no_year_in_name",
                   "Agreste_2019.csv": "inconsistent"}
    summary = {r.status: r.n_units for r in Q.integrity_summary(units).collect()}
    assert summary == {"ok": 1, "inconsistent": 2, "no_valid_values": 1, "no_year_in_name": 1}
    import pytest
    with pytest.raises(ValueError):
        Q.assert_integrity(units)


def test_html_short_rows_codes_and_table_id(spark):
    from rainrisk.sources.daily import numeric_code_rows
    html = ("<table data-id='tbMonPluvio'><tr><td>no</td></tr><tr><td>9</td></tr></table>"
            "<table class='x' id = tbMonPluvio><tr><th>Código</th><th>Posto</th><th>01</th></tr>"
            "<tr><td>1.234</td><td>A</td></tr><tr><td>5</td><td>B</td><td>1,5</td></tr>"
            "<tr><td>inf</td><td>C</td><td>2</td></tr><tr></tr></table>")
    pages = spark.createDataFrame([("p", html)], "page_id string, html string")
    rows = numeric_code_rows(table_rows(pages, columns=["Código", "Posto", "01"])).collect()
    assert sorted((r["Código"], r["Posto"], r["01"]) for r in rows) == [(5, "B", "1,5"), (1234, "A", None)]
