"""N-gram Jaccard join against brute force."""
import random
import re
from itertools import combinations

import pytest

from rainrisk.llm import ngram_join as J


def shingle_set(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def brute(rows, n, num, den):
    sets = [(i, shingle_set(t, n)) for i, t in rows]
    par = list(range(len(rows)))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x
    for a, b in combinations(range(len(rows)), 2):
        x, y = sets[a][1], sets[b][1]
        same_id = sets[a][0] is not None and sets[a][0] == sets[b][0]
        known = sets[a][0] is not None and sets[b][0] is not None
        if same_id or known and x and y and den * len(x & y) >= num * len(x | y):
            par[find(a)] = find(b)
    out = []
    for k, (i, s) in enumerate(sets):
        root = find(k)
        group = [sets[j][0] for j in range(len(rows)) if find(j) == root]
        out.append((i, len(s), None if i is None else min(group)))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def fixture(seed):
    r = random.Random(seed)
    vocab = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqr"]
    prose = lambda n: [r.choice(vocab) for _ in range(n)]
    rows, base, line = [], prose(120), prose(12)
    for i in range(40):
        rows.append((i, " ".join(prose(r.randint(1, 150)))))
    for i in range(60):  # near copies with 0 to 5 words changed, some cut
        w = list(base)
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = r.choice(vocab)
        rows.append((100 + i, " ".join(w[r.choice([0, 0, 3]):])))
    for i in range(20):  # short texts that share a frequent line
        rows.append((200 + i, " ".join(line + prose(r.randint(0, 4)))))
    rows += [(300, None), (301, ""), (302, " \t\n"), (303, "One Two"), (304, "one\x0btwo"), (305, "one"), (306, "Ärger ÄRGER ärger"),
             (None, " ".join(base)), (None, None), rows[3], (307, rows[3][1]), (308, " ".join(prose(30) * 40))]
    return rows


@pytest.mark.parametrize("n,num,den,seed", [(3, 9, 10, 0), (5, 4, 5, 1), (3, 9, 10, 2)])
def test_against_brute_force(spark, n, num, den, seed):
    rows = fixture(seed)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, sig int, component_id string").repartition(3)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.jaccard_components(df, n, num, den).collect()),
                 key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert got == brute(rows, n, num, den)


def test_empty_table(spark):
    assert J.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_only_texts_without_words(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " ")], "doc_id long, text string")
    assert sorted(tuple(r) for r in J.jaccard_components(df).collect()) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]
