"""Masked pseudo-likelihood: brute force of a score, normalisation, learning."""
import numpy as np

from rainrisk.llm import lm_score as L
from rainrisk.llm.common import words

U64 = np.uint64


def _vocab(texts):
    raw = [t.encode() for t in texts]
    off = np.cumsum([0] + [len(t) for t in raw])
    h, doc, _, _ = words(np.frombuffer(b"".join(raw), np.uint8), off)
    u, n = np.unique(h, return_counts=True)
    best = np.argsort(-n, kind="stable")[:20]
    own = u[best]
    tail = np.zeros((2, 1 << L.TAIL_BITS))
    rare = ~np.isin(u, own)
    np.add.at(tail[0], (u[rare] >> U64(64 - L.TAIL_BITS)).astype(int), n[rare])
    np.add.at(tail[1], (u[rare] >> U64(64 - L.TAIL_BITS)).astype(int), 1)
    return L.Vocabulary(own, n[best], tail), h, doc


def test_log_prob_is_the_product_of_three_softmaxes():
    texts = ["the cat sat on the mat", "", "one", "a b c d e f g the the cat " * 3]
    vocab, h, doc = _vocab(texts)
    ids, _ = vocab.ids(h)
    net = L.WindowNetwork()
    pick = np.arange(len(ids))
    got = net.log_prob(L.windows(ids, doc, pick), ids)
    for k in range(len(ids)):  # word by word
        x = net.p["b"].astype(float).copy()
        for j, step in enumerate((-2, -1, 1, 2)):
            at = k + step
            ctx = ids[at] if 0 <= at < len(ids) and doc[at] == doc[k] else L.PAD
            x += net.p["E"][j][ctx]
        hid = np.tanh(x)
        lp, s = 0, net.fan
        for level, (key, take) in enumerate(((0, ids[k] // s ** 2), (ids[k] // s ** 2, ids[k] // s % s), (ids[k] // s, ids[k] % s))):
            a = hid @ net.p[f"W{level}"][key] + net.p[f"c{level}"][key]
            lp += a[take] - np.log(np.exp(a).sum())
        assert abs(got[k] - lp) < 1e-4


def test_a_step_follows_the_gradient():
    """Numeric derivatives of the mean log-probability, in every kind of table."""
    r = np.random.default_rng(2)
    net = L.WindowNetwork(8)
    ids, ctx = r.integers(0, 64, 40).astype(np.int32), r.integers(0, 65, (40, 4)).astype(np.int32)
    net.p = {k: x.astype(np.float64) for k, x in net.p.items()}
    start = {k: x.copy() for k, x in net.p.items()}
    acc = {k: np.zeros_like(x) for k, x in net.p.items()}
    net.step(ctx, ids, acc, 1e-9)
    for name in net.p:
        net.p = {k: x.copy() for k, x in start.items()}
        big = np.argsort(acc[name].ravel())[-3:]
        for at in big.tolist():
            low, high = (net.p[name].ravel().__setitem__(at, start[name].ravel()[at] + e) or float(net.log_prob(ctx, ids).astype(float).mean())
                         for e in (-1e-3, 1e-3))
            net.p[name].ravel()[at] = start[name].ravel()[at]
            assert abs(abs(high - low) / 2e-3 - acc[name].ravel()[at] ** .5) < 2e-3


def test_probabilities_of_a_place_sum_to_one():
    net, ctx = L.WindowNetwork(), np.tile(np.array([[1, 2, 3, L.PAD]], np.int32), (L.IDS, 1))
    assert abs(np.exp(net.log_prob(ctx, np.arange(L.IDS, dtype=np.int32)).astype(float)).sum() - 1) < 1e-4


def test_rare_words_share_their_id():
    vocab, h, _ = _vocab([" ".join(f"w{i}" for i in range(400)) + " common" * 50])
    rare = np.flatnonzero(vocab.distinct)
    for r in range(L.RARE):
        b = rare[rare % L.RARE == r]
        if len(b):
            assert abs((np.exp(vocab.share[b]) * vocab.distinct[b]).sum() - 1) < 1e-5


def test_learns_and_scores_whole_texts(spark):
    good = "the cat sat on the mat and the dog lay on the rug . " * 30
    rows = [(i, good) for i in range(40)] + [(100, "mat the on sat cat the rug dog " * 30), (101, None), (102, ""), (103, "zzz"),
                                             (None, good), (104, good * 60), (104, good * 60)]
    df = spark.createDataFrame([(i, t, 0.0) for i, t in rows], "doc_id long, text string, log_prob double").repartition(3)
    got = L.pseudo_likelihood(df).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[101]["n_words"] == by[102]["n_words"] == 0 and by[101]["log_prob"] == 0 and by[101]["mean_log_prob"] is None
    assert by[104]["n_words"] == 60 * by[0]["n_words"] and by[103]["n_words"] == 1
    assert by[0]["mean_log_prob"] > by[100]["mean_log_prob"] > by[103]["mean_log_prob"]  # order of words counts
    counts = np.array([r["n"] for r in L.word_counts(df).collect()], float)
    unigram = float((counts / counts.sum() * np.log(counts / counts.sum())).sum())  # what the words' shares alone would give
    assert sum(r["log_prob"] for r in got) / sum(r["n_words"] for r in got) > unigram


def test_every_word_counts_for_itself(spark):
    # w0 and w1 share a bucket and an id: their scores still differ by the log of their counts
    r = np.random.default_rng(5)
    pool = [f"x{i}" for i in range(60000)]
    hashes = words(np.frombuffer(" ".join(pool).encode(), np.uint8), np.array([0, len(" ".join(pool))]))[0]
    bucket = (hashes >> U64(64 - L.TAIL_BITS)).astype(int)
    order = np.argsort(bucket, kind="stable")
    k = next(i for i in range(len(order) - 1) if bucket[order[i]] == bucket[order[i + 1]])
    a, b = pool[order[k]], pool[order[k + 1]]
    own = " ".join(f"own{i} " * 12 for i in range(4100))  # more words than the smallest table has ids
    rows = [(0, a), (1, b), (2, own), (3, (a + " ") * 7)] + [(10 + i, pool[i]) for i in r.permutation(2000).tolist()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    by = {r["doc_id"]: r["log_prob"] for r in L.pseudo_likelihood(docs).collect()}
    n = {w: 8 if w == a else 1 for w in (a, b)}
    for i, w in ((10 + i, pool[i]) for i in range(2000)):
        n[w] = n.get(w, 0) + 1
    assert abs((by[0] - by[1]) - (np.log(n[a]) - np.log(n[b]))) < 1e-4


def test_tables_grow_with_the_vocabulary(spark):
    assert L.side_of(1000) == L.CLASSES and L.side_of(1_000_000) in (100, 101) and L.side_of(64_000_000) in (400, 401)
    counts = spark.range(500000).selectExpr("xxhash64(id) as h", "cast(1 + id % 50 as long) as n")
    vocab = L.vocabulary(counts)
    assert vocab.side == 80 and len(vocab.keys) == 80 * 79 and vocab.freq.sum() == counts.agg({"n": "sum"}).first()[0]


def test_every_word_is_a_target_once():
    texts = ["a", "b c", "", "d e f", " ".join(f"w{i}" for i in range(50))] + ["x y"] * 9
    _, h, doc = _vocab(texts)
    for rounds in (1, 2, 3, 8):
        assert sorted(np.concatenate([L.targets(h, doc, t, rounds) for t in range(rounds)])) == list(range(len(h)))


def test_learns_words_at_every_place(spark, monkeypatch):
    # eight words in a fixed order: each of them is trained, not only those at two of eight places
    seen, step = [], L.WindowNetwork.step
    monkeypatch.setattr(L.WindowNetwork, "step", lambda self, ctx, ids, acc, rate: (seen.extend(ids.tolist()), step(self, ctx, ids, acc, rate))[1])
    text = " ".join(f"w{i}" for i in range(8))
    vocab, h, doc = _vocab([text] * 50)
    ids, _ = vocab.ids(h)

    class Docs:  # runs the tasks in this process
        sparkSession = spark

        def select(self, *_):
            return self

        coalesce = select

        def mapInArrow(self, f, _):
            import pyarrow as pa
            list(f(iter([pa.RecordBatch.from_pydict({"text": [text] * 50})])))
            return spark.createDataFrame([], "slice int, n long, v binary")

    L.train(Docs(), spark.sparkContext.broadcast(vocab))
    assert sorted(seen) == sorted(ids.tolist())


def test_empty_table(spark):
    assert L.pseudo_likelihood(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_accumulators_are_made_once(monkeypatch):
    net, acc, made, full = L.WindowNetwork(), {}, [], np.full_like
    monkeypatch.setattr(np, "full_like", lambda *a, **k: made.append(1) or full(*a, **k))
    r = np.random.default_rng(2)
    for _ in range(3):
        net.step(r.integers(0, L.IDS + 1, (500, 2 * L.SIDE)).astype(np.int32), r.integers(0, L.IDS, 500).astype(np.int32), acc, .1)
    assert len(made) == len(net.p)


def test_ids_of_keys_that_share_their_first_bits():
    own = np.array([5, 6, 7, 1 << 40, (1 << 63) + 9, (1 << 63) + 8, (1 << 64) - 1], np.uint64)
    v = L.Vocabulary(own, np.ones(7), np.ones((2, L.CLASSES)))
    asked = np.concatenate([own, np.array([0, 4, 8, (1 << 40) + 1, (1 << 63) + 7, (1 << 63) + 10, (1 << 64) - 2], np.uint64)])
    ids, _ = v.ids(asked)
    assert ids[:7].tolist() == list(range(7)) and (ids[7:] >= v.first_rare).all()


def test_texts_are_cut_into_words_once(spark, monkeypatch):
    """Training and scoring read kept ids: the same words, documents and targets as from the texts."""
    import pyarrow as pa
    texts = ["a b c a b", None, "", " d  e a", "c" * 40 + " b"] * 3
    vocab, _, _ = _vocab([t or "" for t in texts])
    held = spark.sparkContext.broadcast(vocab)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    kept = L.encode(df, held).toArrow().combine_chunks().to_batches()
    plain = [pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts, pa.string())})]
    (_, ids, doc, h), = L.text_ids(plain, vocab)
    (rows, ids2, doc2, h2), = L.kept_ids(kept, vocab)
    assert ids.tolist() == ids2.tolist() and doc.tolist() == doc2.tolist()
    assert rows.column(2).to_pylist() == np.bincount(doc, minlength=len(texts)).tolist()
    for turn in range(2):
        assert L.targets(h, doc, turn, 2).tolist() == L.targets(h2, doc2, turn, 2).tolist()
