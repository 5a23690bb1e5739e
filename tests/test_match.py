"""Single-pass matcher vs. a brute-force rendering of the literal cascade."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rainrisk.operators.match import station_municipality_map, tier_matches, unmatched_stations

ACC = str.maketrans("ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇ", "AAAAAEEEEIIIIOOOOOUUUUC")


def clean(s):
    return None if s is None else s.strip(" ").replace("ß", "ẞ").upper().translate(ACC)


def like(value, pattern):
    rx = "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern)
    return re.fullmatch(rx, value, re.S) is not None


def cascade(stations, muns):
    """stations: [(code, name)], muns: [(ibge, name, lat, lon)] → {code: (mun, lat, lon, tier)}"""
    st_ = sorted({(c, n, clean(n)) for c, n in stations if c is not None})
    mk = [(i, m, la, lo, clean(m)) for i, m, la, lo in muns]
    tiers = [lambda s, k: s == k, lambda s, k: like(s, k + "%"),
             lambda s, k: like(s, "%" + k + "%")]
    out, left = {}, st_
    for t, pred in enumerate(tiers, 1):
        hits = {}
        for c, _, s in left:
            for i, m, la, lo, k in mk:
                if pred(s, k):
                    hits.setdefault(c, []).append((-len(k), m, i, la, lo))
        for c, hs in hits.items():
            _, m, _, la, lo = min(hs)
            out[c] = (m, la, lo, {1: "Exato", 2: "Comeca_Com", 3: "Contem"}[t])
        left = [x for x in left if x[0] not in hits]
    for c, _, _ in left:
        out[c] = (None, None, None, "Sem_Match")
    return out


def run(spark, stations, muns):
    b = spark.createDataFrame(stations, "codigo_posto bigint, nome_posto string")
    m = spark.createDataFrame(muns, "codigo_ibge int, municipio string, latitude double, "
                                    "longitude double")
    got = station_municipality_map(b, m).collect()
    return {r.codigo_posto: (r.municipio_inferido, r.latitude, r.longitude, r.tipo_match)
            for r in got}, b, m


MUNS = [(1, "Recife", 1.0, 1.0), (2, "Olinda", 2.0, 2.0), (3, "São José", 3.0, 3.0),
        (4, "JOSÉ", 4.0, 4.0), (5, "Bom_Jardim", 5.0, 5.0), (6, "A%B", 6.0, 6.0),
        (7, "Barra", 7.0, 7.0), (8, "Barra de Goiana", 8.0, 8.0), (9, "C\\D", 9.0, 9.0),
        (10, "Barra", 10.0, 10.0)]


def test_cascade_cases(spark):
    stations = [
        (1, " recife "),              # exact after cleaning
        (2, "OLINDA (Alto)"),         # prefix
        (3, "Posto São José Velho"),  # contains: SAO JOSE and JOSE → longest name wins
        (4, "BOMXJARDIM"),            # '_' is a wildcard: prefix
        (5, "A anything B"),          # '%' in a name is a wildcard: prefix
        (6, "Barra de Goiana"),       # exact beats the shorter prefix match
        (7, "Barras"),                # two municipalities named Barra: lowest code
        (8, "Nowhere"),               # no match
        (9, "XC\\D"),                 # backslash is literal
        (10, "Olinda"), (10, "Zzz"),  # two spellings: any spelling's tier wins
        (11, "Recife"), (11, "Olinda do Norte"),
    ]
    got, b, m = run(spark, stations, MUNS)
    assert got == cascade(stations, MUNS)
    assert got[3][0] == "São José" and got[4][3] == "Comeca_Com"
    assert got[5][3] == "Comeca_Com" and got[6][3] == "Exato" and got[8][3] == "Sem_Match"
    assert got[7] == ("Barra", 7.0, 7.0, "Comeca_Com") and got[9][3] == "Contem"
    assert got[11] == ("Recife", 1.0, 1.0, "Exato")
    assert sorted(r.codigo_posto for r in unmatched_stations(b, m).collect()) == [8]
    assert sorted(r.codigo_posto for r in tier_matches(b, m, 1).collect()) == [1, 6, 10, 11]


def test_null_code_is_left_out(spark):
    got, _, _ = run(spark, [(None, "Recife"), (1, "Olinda x")], MUNS)
    assert got == {1: ("Olinda", 2.0, 2.0, "Comeca_Com")}


def test_null_code_as_sql_not_in(spark):
    """A NULL code that matches leaves nothing for the later tiers (NOT IN)."""
    import duckdb

    muns = [(1, "Recife", 1.0, 1.0), (2, "Olinda", 2.0, 2.0)]
    cases = [[(None, "Recife"), (1, "Olinda x"), (2, "zz"), (3, "Olinda")],
             [(None, "Recife x"), (1, "a Olinda"), (2, "zz")],
             [(None, "Recife x"), (3, "Olinda"), (1, "a Olinda"), (2, "zz")],
             [(None, "nothing"), (1, "Olinda x"), (2, "zz")], [(None, "nothing"), (2, "zz")]]
    for stations in cases:
        con = duckdb.connect()
        con.execute("create table s(c bigint, k varchar); create table m(k varchar, n varchar)")
        con.executemany("insert into s values (?, ?)", [(c, clean(n)) for c, n in stations])
        con.executemany("insert into m values (?, ?)", [(clean(n), n) for _, n, _, _ in muns])
        left, want = "s", {}
        for t, cond in ((1, "s.k = m.k"), (2, "s.k like m.k || '%'"), (3, "s.k like '%' || m.k || '%'")):
            con.execute(f"create table t{t} as select s.c, m.n from {left} s join m on {cond}")
            con.execute(f"create table r{t} as select * from {left} where c not in (select c from t{t})")
            want |= {c: n for c, n in con.execute(f"select c, n from t{t}").fetchall()}
            left = f"r{t}"
        want |= {c: None for c, in con.execute("select c from r3").fetchall()}
        b = spark.createDataFrame(stations, "codigo_posto bigint, nome_posto string")
        m = spark.createDataFrame(muns, "codigo_ibge int, municipio string, latitude double, longitude double")
        got = {r.codigo_posto: r.municipio_inferido for r in station_municipality_map(b, m, null_codes=True).collect()}
        assert got == want, stations


def test_candidates_of_plain_names_are_matches(spark):
    """The key of a name without wildcards is the whole name: no candidate is refused."""
    from pyspark.sql import functions as F

    from rainrisk.operators import match as M
    muns = [(i, f"Cidade {a}{b}", 0.0, 0.0) for i, (a, b) in enumerate((x, y) for x in "abcde" for y in "vwxyz")]
    stations = [(k, f"Posto Cidade {n[1][-2:]} {k}") for k, n in enumerate(muns * 3)]
    b = spark.createDataFrame(stations, "codigo_posto bigint, nome_posto string")
    m = spark.createDataFrame(muns, "codigo_ibge int, municipio string, latitude double, longitude double")
    mk = M._municipality_gram(M.municipality_keys(m))
    lengths = F.lit([r[0] for r in mk.select(F.length("_key")).distinct().collect()])
    cand = M._station_grams(M.distinct_stations(b), lengths).join(mk, "_key").count()
    assert cand == M.candidate_pairs(M.distinct_stations(b), m).count() == len(stations)


names = st.text(alphabet="ab_%ç ", min_size=0, max_size=6)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(names, min_size=1, max_size=8), st.lists(names, min_size=1, max_size=5))
def test_cascade_property(spark, station_names, mun_names):
    stations = [(i % 5, n) for i, n in enumerate(station_names)]
    muns = [(i, n, float(i), float(-i)) for i, n in enumerate(mun_names)]
    got, _, _ = run(spark, stations, muns)
    assert got == cascade(stations, muns)
