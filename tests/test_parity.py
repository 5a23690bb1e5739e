"""Property tests: our Column rules against the libraries the reference used.

* rain cells: pandas ``str.strip`` / replace / ``to_numeric(errors='coerce')``
* dates: Python ``datetime(int(year), month_map[abbr.lower()], int(day))``
* name cleaning: DuckDB ``upper(trim(x))`` plus the 23-letter accent fold
"""

import datetime as dt

import duckdb
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rainrisk.functions.parse import PT_MONTHS, parse_decimal_comma, pt_month_year_date
from rainrisk.functions.text import ACCENTED_CAPITALS, PLAIN_CAPITALS, clean_string

SETTINGS = settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))


def pandas_rain(values):
    s = pd.Series(values, dtype=object).astype(str).str.strip()
    s = s.replace(["-", "", "nan", "None"], pd.NA).str.replace(",", ".", regex=False)
    out = pd.to_numeric(s, errors="coerce")
    return [None if pd.isna(v) else float(v) for v in out]


cells = st.lists(st.text(alphabet="0123456789,.-+ e\t\xa0\u2003\x1c", max_size=8) |
                 st.sampled_from(["-", "", "nan", "None", " 1,5 ", "1.234,5", "5d", "12",
                                  "inf", "-Infinity", "+INF", "NaN", "infinit", "\xa01,5"]),
                 min_size=1, max_size=40)


@SETTINGS
@given(cells)
def test_rain_cells_match_pandas(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r.p for r in df.select("i", parse_decimal_comma(F.col("v")).alias("p"))
           .orderBy("i").collect()]
    want = pandas_rain(values)
    import math
    for v, g, w in zip(values, got, want):
        # pandas' own text-to-float parser is not always correctly rounded
        # (e.g. '9e24' → 8.999999999999999e+24, one ulp below the nearest
        # double); Spark's parse is. Equal up to a few ulps, same NULLs.
        assert g == w or (g is not None and w is not None
                          and math.isclose(g, w, rel_tol=4e-16, abs_tol=1e-12)), (v, g, w)


def python_date(month_year, day):
    months = {m: i + 1 for i, m in enumerate(PT_MONTHS)}
    try:
        parts = str(month_year).split("/")
        return dt.date(int(parts[1]), months[parts[0].lower()], int(day))
    except Exception:
        return None


month_years = st.builds(
    lambda m, case, y, pad: (m.upper() if case == 0 else m.title() if case == 1 else m)
    + "/" + pad + str(y),
    st.sampled_from(PT_MONTHS + ["xxx", "janeiro", ""]), st.integers(0, 2),
    st.integers(1900, 2100) | st.integers(0, 10000), st.sampled_from(["", " ", "0"]))
days = st.integers(0, 32).map(lambda d: f"{d:02d}") | st.sampled_from(["1", " 7", "ab", ""])


@SETTINGS
@given(st.lists(st.tuples(month_years, days), min_size=1, max_size=40))
def test_dates_match_python(spark, pairs):
    df = spark.createDataFrame([(i, m, d) for i, (m, d) in enumerate(pairs)],
                               "i int, m string, d string")
    got = [r.x for r in df.select("i", pt_month_year_date(F.col("m"), F.col("d")).alias("x"))
           .orderBy("i").collect()]
    for (m, d), g in zip(pairs, got):
        assert g == python_date(m, d), (m, d, g)


names = st.text(alphabet=" abcçãéíõúüñßÁÉÍÓÚÇÑẞxyz_%İıǅ", max_size=12)


@SETTINGS
@given(st.lists(names, min_size=1, max_size=30))
def test_clean_string_matches_duckdb(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r.c for r in df.select("i", clean_string(F.col("v")).alias("c")).orderBy("i").collect()]
    con = duckdb.connect()
    want = [con.execute(f"SELECT translate(upper(trim(?)), '{ACCENTED_CAPITALS}', "
                        f"'{PLAIN_CAPITALS}')", [v]).fetchone()[0] for v in values]
    assert got == want
