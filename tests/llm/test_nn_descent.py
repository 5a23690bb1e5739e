"""NN-descent near-dedup against brute force."""
import numpy as np

from rainrisk.llm import nn_descent as N


def brute(rows, threshold):
    seen = {}
    for i, v, l in rows:
        ok = i is not None and l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if i is not None and (i not in seen or not seen[i][0]):
            seen[i] = (ok, v, l)
    ids = sorted(seen)
    par = {i: i for i in ids}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x
    n = dict.fromkeys(ids, 0)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            (x, u, l), (y, v, m) = seen[a], seen[b]
            if x and y and l == m and len(u) == len(v):
                u, v = np.array(u, np.float32).astype(float), np.array(v, np.float32).astype(float)
                if u @ v / np.sqrt(u @ u) / np.sqrt(v @ v) >= threshold:
                    n[a] += 1
                    n[b] += 1
                    p, q = sorted((find(a), find(b)))
                    par[q] = p
    return {i: (n[i], find(i), find(i) == i) for i in ids}


def fixture():
    r = np.random.default_rng(4)
    rows, vid = [], 0
    for label in (0, 1, 2):
        for _ in range(150):
            v = r.normal(size=24)
            rows.append((vid, v, label))
            vid += 1
            if r.random() < .15:  # a near copy
                rows.append((vid, v + r.normal(size=24) * .05, label))
                vid += 1
    centre = r.normal(size=24)
    for _ in range(90):  # a dense group: lists of K neighbours are too short for it
        rows.append((vid, centre + r.normal(size=24) * .02, 1))
        vid += 1
    rows += [(vid + k, rows[3][1] * 2, rows[3][2]) for k in range(3)] + [(vid + 5 + k, rows[0][1], 0) for k in range(3)]
    rows = [(int(i), [float(np.float32(x)) for x in v], l) for i, v, l in rows]
    return rows + [(9000, None, 1), (9001, [], 1), (9002, [0.0] * 24, 1), (9003, [float("nan")] * 24, 1), (9004, rows[0][1], None),
                   (9005, [None] * 24, 1), (None, rows[0][1], 0), (9006, [1.0, 2.0], 1), (9007, [2.0, 4.0], 1), rows[5]]


def test_against_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame([(i, v, l, 1) for i, v, l in rows], "vec_id long, embedding array<float>, label int, weight int").repartition(3)
    got = N.near_duplicates(df).collect()
    want = brute(rows, .93)
    assert len(got) == len(want) + 1  # one row for the null id
    assert [tuple(r)[:3] for r in got if r["vec_id"] is None] == [(None, 0, None)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] is not None}
    # a graph search may miss links; it never makes one up
    found, true = sum(n for n, _, _ in got.values()), sum(n for n, _, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want) and found >= .9 * true
    assert sum(got[i] == want[i] for i in want) >= .98 * len(want)


def test_linked_dense_sub_clusters(spark):
    # lists fill inside a sub-cluster (0.99); the links between two (0.94) are found all the same
    r = np.random.default_rng(8)
    rows = []
    for label in range(3):
        q, _ = np.linalg.qr(r.normal(size=(64, 64)))
        for side in (0.175, -0.175):  # centres at an angle of about 0.35: cosine 0.94
            centre = np.cos(side) * q[0] + np.sin(side) * q[1]
            for _ in range(40):
                v = centre + r.normal(size=64) * 0.0065
                rows.append((len(rows), [float(np.float32(x)) for x in v], label))
        rows += [(len(rows) + k, [float(np.float32(x)) for x in r.normal(size=64)], label) for k in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in N.near_duplicates(df).collect()}
    assert got == brute(rows, .93)


def test_failing_labels_are_compared_whole(spark, monkeypatch):
    # descents that find nothing: the audit sees it and the labels are compared exactly
    monkeypatch.setattr(N, "descend", lambda nodes, *_: nodes.sparkSession.createDataFrame([], N.EDGE))
    monkeypatch.setattr(N, "AUDIT", 4)  # too few to have a link: more are taken
    rows = [x for x in fixture() if x[2] != 2 and x[0] is not None][:220]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in N.near_duplicates(df).collect()}
    assert got == brute(rows, .93)


def test_empty_and_tiny_tables(spark):
    schema = "vec_id long, embedding array<double>, label int"
    assert N.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    got = N.near_duplicates(spark.createDataFrame([(2, [1.0, 0.0], 1), (1, [1.0, 0.001], 1)], schema)).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 1, True), (2, 1, 1, False)]
