"""Ranked lexical search against its SQL and a term-by-term loop."""
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from rainrisk.llm import lexical as X

TERM = re.compile(X.TERMS)


def terms(text):
    return [] if text is None else TERM.findall("".join(c.lower() if c.isascii() else c for c in text))


def brute(docs, items, k=X.K):
    tfs = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    tfs = [x for x in tfs if x[2]]
    n_docs, n_terms = len(tfs), sum(x[2] for x in tfs)
    df = Counter(t for _, c, _ in tfs for t in c)
    out = []
    for item, text in set(items):
        got = []
        for i, c, n in tfs:
            m = 25 + 75 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in terms(text) if c[t])
            if s > 0:
                got.append((-s, i is None, i))
        got.sort()
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(got[:k], 1)]
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, 1, "x", 2.0) for i, t in docs], "doc_id long, text string, id int, terms string, score double"),
            spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, n int"))


def made(seed=3, docs=150, items=25):
    rnd = random.Random(seed)
    vocabulary = ["the", "of", "Éa", "ü9", "x-y", "zz_z"] + [f"w{i}" for i in range(60)]
    text = lambda n: rnd.choice([" ", ", ", "\n"]).join(vocabulary[min(int(rnd.expovariate(.08)), 65)] for _ in range(n))
    d = [(i, text(rnd.randint(0, 60))) for i in range(docs)]
    d += [(500, None), (501, ""), (502, "..."), (None, d[3][1]), (None, "the W1 w2"), (3, d[3][1]), (3, d[3][1]), (7, "THE the w5"), (503, "the " * 3000)]
    q = [(i, text(rnd.randint(1, 30))) for i in range(items)]
    q += [(90, None), (91, ""), (92, "unknownterm"), (None, "w1 w2 w1"), (q[0][0], "w9 w8"), q[1], q[1], (93, "the the the of")]
    return d, q


@pytest.mark.parametrize("batch", [X.BATCH_TERMS, 60])
def test_equals_a_loop(spark, batch):
    d, q = made()
    got = sorted((tuple(r) for r in X.search(*frames(spark, d, q), batch_terms=batch).collect()), key=repr)
    assert got == brute(d, q)


def test_equals_sql(spark):
    d, q = made(8)
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.execute("create table benchmark(item_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", d)
    con.executemany("insert into benchmark values (?, ?)", q)
    con.execute(f"create table o as {X.OP13_SQL}")
    assert sorted(con.execute("select item_id, rank, doc_id, score from o").fetchall(), key=repr) == brute(d, q)


def test_small_blocks_give_the_same(spark, monkeypatch):
    d, q = made(4, docs=60, items=10)
    monkeypatch.setattr(X, "ACCUMULATOR_BYTES", 1)
    assert sorted((tuple(r) for r in X.search(*frames(spark, d, q)).collect()), key=repr) == brute(d, q)


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = ("ab " * 400_000 + "c" * 900_000 + " ü" * 300_000).encode()
    data = np.frombuffer(text, np.uint8)
    n, doc, at, tf, known = X.counted(data, np.array([0, len(data)]))
    assert n.tolist() == [700_001] and sorted(tf.tolist()) == [1, 300_000, 400_000] and len(known) == 3


def test_nodes_are_shared_and_sums_are_kept():
    rnd = random.Random(1)
    common = list(range(8))
    items = [np.array(sorted(set(common + [rnd.randrange(8, 80) for _ in range(12)]))) for _ in range(40)]
    rounds, nodes, left, off = X.shared(items, 80)
    assert len(rounds) > 1 and len(left) + nodes - 80 < sum(map(len, items)) * .7   # fewer sums than without sharing
    value = np.r_[np.arange(1, 81) ** 3, np.zeros(nodes - 80, int)]
    at = 80
    for a, b in rounds:
        value[at:at + len(a)] = value[a] + value[b]
        at += len(a)
    assert np.add.reduceat(value[left], off).tolist() == [int(((x + 1) ** 3).sum()) for x in items]


def test_empty_tables(spark):
    d, q = made(2, docs=5, items=2)
    for a, b in (([], q), (d, []), ([(1, None), (2, "--")], q), (d, [(1, None)])):
        out = X.search(*frames(spark, a, b))
        assert out.collect() == [] and out.columns == ["item_id", "rank", "doc_id", "score"]
