"""Quality classifier: gradients, held-out accuracy, edge cases."""
import random
import zlib

import numpy as np

from rainrisk.llm import quality as Q


def test_gradients_match_differences():
    data = np.frombuffer(("word other words here. " * 20 + "A B C !!! 12 " * 10).encode(), np.uint8)
    off = np.array([0, 200, 200, 330, len(data)])
    bag, y = Q.passages(data, off), np.array([1, 0, 1, 0], np.float32)
    net = Q.Network()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}

    def loss():
        z = net.forward(*bag)[0]
        return float(np.mean(np.log1p(np.exp(z)) - y * z))
    grad, r = net.gradients(y, bag), np.random.default_rng(0)
    for name in net.p:
        flat, g = net.p[name].reshape(-1), np.asarray(grad[name]).reshape(-1)
        for i in [int(np.abs(g).argmax()), int(r.integers(len(flat)))]:
            keep = flat[i]
            flat[i] = keep + 1e-5
            up = loss()
            flat[i] = keep - 1e-5
            down = loss()
            flat[i] = keep
            assert abs((up - down) / 2e-5 - g[i]) < 1e-3 * max(1, abs(g[i])), name


def test_passages_of_a_block_equal_single_documents():
    texts = ["", "one two", "x " * 300, "   ", "Ärger über\nalles $$$ 12 12 12"]
    raw = [t.encode() for t in texts]
    off = np.cumsum([0] + [len(t) for t in raw])
    net = Q.Network()
    together = net.score(*Q.passages(np.frombuffer(b"".join(raw), np.uint8), off))
    alone = [net.score(*Q.passages(np.frombuffer(t, np.uint8), np.array([0, len(t)])))[0] for t in raw]
    assert np.allclose(together, alone, atol=1e-6) and ((together > 0) & (together < 1)).all()


def test_held_out_accuracy(spark):
    from rainrisk.llm.common import table
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    got = {r["doc_id"]: r for r in Q.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    known = [(got[r["doc_id"]], r["quality"]) for r in labels.collect()]
    test = [(g["predicted"], q) for g, q in known if g["held_out"]]
    assert len(test) > 50 and sum(p == q for p, q in test) / len(test) >= .95
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())


def test_edge_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, .5), (2, "", .5), (3, "fine words", .5), (3, "fine words", .5), (None, "no id", .5), (4, "w " * 50_000, .5)],
        "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 0), (3, 1)], "doc_id long, quality int")
    got = Q.classify(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= .7) for r in got)
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    none = labels.limit(0)
    assert {round(r["score"], 6) for r in Q.classify(docs, none).collect()} == {.75}  # nothing known: kept
    assert Q.classify(docs.limit(0), labels).collect() == [] and Q.classify(docs.limit(0), none).collect() == []


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, random.Random(i).choice(["good words here.", "$$$ ### $$$"])) for i in range(200)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(text like 'good%') as quality")
    seen = []
    fit = Q.Network.fit
    try:
        Q.Network.fit = lambda self, bags, y, **k: (seen.append(len(bags)), fit(self, bags, y, **k))[1]
        Q.train(docs, labels, fit_docs=50)
    finally:
        Q.Network.fit = fit
    assert seen == [50]


def _slow(net, text):
    """A document's score word by word: passages, their figures, attention, one logistic unit."""
    import math

    from rainrisk.llm.common import words
    raw = text.encode()
    h, _, s, e = words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    ws = [(int(x) >> 52, raw[a:b], int(x)) for x, a, b in zip(h.tolist(), s.tolist(), e.tolist())] or [(Q.BUCKETS, b"", None)]
    hidden, gates = [], []
    for i in range(0, len(ws), Q.PASSAGE):
        part = ws[i:i + Q.PASSAGE]
        n, f = len(part), [0.0] * Q.STATS
        for k, (_, w, x) in enumerate(part):
            if x is None:
                continue
            ln = len(w)
            up, dg = sum(65 <= c <= 90 for c in w), sum(48 <= c <= 57 for c in w)
            al = sum(65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in w)
            same = i + k > 0 and ws[i + k - 1][2] == x
            last = w[-1]
            for j, v in ((1, ln), (2, ln * ln), (3, up / ln), (4, up == ln), (5, dg / ln), (6, (ln - al - dg) / ln), (7, last in b".!?"), (8, same),
                         (10, al == 0), (11, ln == 1 and al == 0), (12, 65 <= last <= 90 or 97 <= last <= 122 or last >= 128), (13, 1)):
                f[j] += float(v) / n
        f[0], f[2], f[9] = math.log(n), math.sqrt(f[2]), len({x for _, _, x in part}) / n
        p = {k: v.astype(float) for k, v in net.p.items()}
        m = sum(p["E"][b] for b, _, _ in part) / n
        hid = np.tanh(m + ((np.array(f) - net.mu) / net.sd) @ p["W"] + p["b"])
        hidden.append(hid)
        gates.append(float((np.tanh(hid @ p["V"]) / (1 + np.exp(-(hid @ p["U"])))) @ p["w"]))
    weights = [math.exp(g - max(gates)) for g in gates]
    z = sum(w * x for w, x in zip(weights, hidden)) / sum(weights)
    return 1 / (1 + math.exp(-float(z @ p["c"] + p["c0"][0])))


def test_scores_equal_a_plain_forward_pass(spark):
    r = random.Random(4)
    word = lambda: r.choice(["the", "Ab", "x9", "12", "!!", "-", "ü", "end.", "REALLY?", "w" * r.randint(1, 20)])
    texts = [" ".join(word() for _ in range(r.choice([1, 5, 63, 64, 65, 200, 700]))) for _ in range(30)] + ["", " \n", "a a a b", None]
    net = Q.Network(seed=3)
    g = np.random.default_rng(1)
    net.p["c"] = g.normal(0, 1, Q.DIM).astype(np.float32)
    net.mu, net.sd = g.normal(0, .3, Q.STATS).astype(np.float32), g.uniform(.5, 2, Q.STATS).astype(np.float32)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {x["doc_id"]: x["score"] for x in Q.score(docs, net).collect()}
    assert len({round(x, 3) for x in got.values()}) > 20
    for i, t in enumerate(texts):
        assert abs(got[i] - _slow(net, t or "")) < 1e-4, (i, t)
