"""Temperature mixing against its SQL and plain Python."""
import math

import duckdb
import pytest

from rainrisk.llm import mixing as M


def rows():
    out = []
    for i in range(300):
        out.append((i, f"s{0 if i % 3 == 0 else i % 7}", "w " * (i % 11)))
    out += [(400, None, "a b c"), (401, None, None), (402, "empty", ""), (403, "empty", None), (None, "s1", "x y"), (5, "s5", "w " * 5),
            (404, "big", "w " * 20000)]
    return out


def test_query_equals_sql(spark):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows()], "doc_id long, source string, text string, copies int, block int")
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, source varchar, text varchar)")
    con.executemany("insert into documents values (?, ?, ?)", rows())
    con.execute(f"create table o as {M.OP10_SQL}")
    got = [tuple(r) for r in M.mix_sources(df, entropy=M.ENTROPY, max_repetition=M.MAX_REPETITION).collect()]
    want = con.execute("select doc_id, source, n_tokens, start, copies from o").fetchall()
    key = lambda r: tuple((x is None, x or 0 if not isinstance(x, str) else x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def _totals(spark, shares):
    return spark.createDataFrame([(float(s),) for s in shares], "share double")


def test_exponent_meets_the_target(spark):
    shares = [.6, .2, .1, .06, .04]

    def weights(a):
        p = [s ** a for s in shares]
        return [x / sum(p) for x in p]
    h = lambda w: -sum(x * math.log(x) for x in w)
    a = M.temperature(_totals(spark, shares), .9, None, 1.0)
    assert h(weights(a)) >= .9 * math.log(5) > h(weights(a + 2 / M.GRID))
    a = M.temperature(_totals(spark, shares), None, 2.0, 1.0)
    most = lambda a: max(w / s for w, s in zip(weights(a), shares))
    assert most(a) <= 2.0 < most(a - 2 / M.GRID)
    assert M.temperature(_totals(spark, shares), .1, None, 1.0) == 1.0       # nature is flat enough
    assert M.temperature(_totals(spark, [.5, .5]), .9, 1.5, 1.0) == 1.0


def test_cover_reads_every_document_and_limits_repeats(spark):
    df = spark.createDataFrame(rows(), "doc_id long, source string, text string")
    got = M.mix_sources(df, max_repetition=1.5, budget="cover").collect()
    assert len(got) == len(rows()) and min(r["copies"] for r in got) >= 1
    by = {}
    for r in got:
        t = by.setdefault(r["source"], [0, 0])
        t[0] += r["n_tokens"]
        t[1] += r["n_tokens"] * r["copies"]
    longest = 20000
    assert all(b <= 1.5 * a + longest for a, b in by.values())


@pytest.mark.parametrize("text", [None, "", " \t"])
def test_no_tokens_at_all(spark, text):
    df = spark.createDataFrame([(1, "a", text), (2, None, text)], "doc_id long, source string, text string")
    assert sorted(tuple(r)[0:1] + tuple(r)[2:] for r in M.mix_sources(df, entropy=.9).collect()) == [(1, 0, 0, 1), (2, 0, 0, 1)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    assert M.mix_sources(df, entropy=.9, max_repetition=2).collect() == []


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(rows(), "doc_id long, source string, text string")
    plan = M.mix_sources(df, entropy=.9)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
