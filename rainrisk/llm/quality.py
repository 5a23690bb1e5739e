"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. A passage is encoded
from its hashed words (mean of learned vectors) and from ``STATS`` figures of
its shape (word lengths, case, digits, symbols, repeats); gated attention
weighs the passages and the weighted sum is scored by one logistic unit.
Only the document has a label; the attention learns which passages carry it.

The network (numpy, Adam) is fitted on the driver on at most ``fit_docs``
labelled documents, chosen by a hash of doc_id (the documented bound of the
sample); encoding passages for the fit and scoring run in tasks over whole
texts, a block of bytes at a time. Inputs of a score: the text, nothing else.

Cases: a null or empty text, or one without words, is a bag of one empty
passage and has a score like any other; a null doc_id is never learned from
and not held out; rows that repeat a doc_id are scored separately, repeated
labels count once (the highest); labels that are null don't count; without
any label every score is 0.75 (nothing is known against a document); an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, mix, quoted, schema_of, table, text_blocks, words

PASSAGE = 64
BUCKETS, DIM, ATT, STATS = 4096, 16, 8, 14
FIT_DOCS = 6000
THRESHOLD = 0.7

_UPPER, _DIGIT, _ALPHA, _END = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_ALPHA[65:91] = _ALPHA[97:123] = True
_ALPHA[128:] = True  # bytes of letters beyond ASCII, for the most part
_END[[33, 46, 63]] = True


def _cum(mask: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(mask)])


def passages(data: np.ndarray, off: np.ndarray):
    """Bags of a block: word buckets, first word of each passage (and the
    end), figures per passage, passage offsets per document. A document
    without words has one passage with the extra bucket ``BUCKETS``."""
    h, doc, s, e = words(data, off)
    n = len(off) - 1
    cnt = np.bincount(doc, minlength=n)
    bare = np.flatnonzero(cnt == 0)  # these get one stand-in word
    at = np.searchsorted(doc, bare)
    bucket = np.insert((h >> U64(52)).astype(np.int32), at, BUCKETS)
    real = np.insert(np.ones(len(h), bool), at, False)
    doc2 = np.insert(doc, at, bare)
    cnt2 = np.maximum(cnt, 1)
    start = _cum(cnt2)
    within = np.arange(len(doc2)) - start[doc2]
    per = -(-cnt2 // PASSAGE)
    poff = _cum(per)
    pid = poff[doc2] + within // PASSAGE
    first = np.searchsorted(pid, np.arange(poff[-1] + 1))
    size = np.diff(first).astype(np.float64)

    def mean(x):
        return np.add.reduceat(np.insert(x.astype(np.float64), at, 0.0), first[:-1]) / size if len(size) else np.zeros(0)

    ln = (e - s).astype(np.float64)
    up, dg, al, en = (_cum(t[data]) for t in (_UPPER, _DIGIT, _ALPHA, _END))
    upper, digit, alpha = (c[e] - c[s] for c in (up, dg, al))
    ends = en[e] - en[e - 1] if len(e) else np.zeros(0)
    last_alpha = al[e] - al[e - 1] if len(e) else np.zeros(0)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    code = np.insert(h, at, U64(0)) ^ mix(pid.astype(U64))  # distinct (passage, word)
    order = np.lexsort((code, pid))
    new = np.ones(len(code), bool)
    new[1:] = code[order][1:] != code[order][:-1]
    distinct = np.add.reduceat(new.astype(np.float64), first[:-1]) / size if len(size) else np.zeros(0)
    bare_word = alpha == 0
    lone = (ln == 1) & bare_word
    figures = np.stack([
        np.log(size), mean(ln), mean(ln * ln) ** 0.5, mean(upper / np.maximum(ln, 1)), mean(upper == ln),
        mean(digit / np.maximum(ln, 1)), mean((ln - alpha - digit) / np.maximum(ln, 1)), mean(ends), mean(same),
        distinct, mean(bare_word), mean(lone), mean(last_alpha), np.add.reduceat(real.astype(np.float64), first[:-1]) / size
    ], 1) if len(size) else np.zeros((0, STATS))
    return bucket, first, figures.astype(np.float32), poff


class Network:
    """Gated-attention MIL network; parameters in ``p``."""

    def __init__(self, prior: float = 0.75, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {"E": r.normal(0, .1, (BUCKETS + 1, DIM)), "W": r.normal(0, .3, (STATS, DIM)), "b": np.zeros(DIM),
                  "V": r.normal(0, .3, (DIM, ATT)), "U": r.normal(0, .3, (DIM, ATT)), "w": r.normal(0, .3, ATT),
                  "c": np.zeros(DIM), "c0": np.array([np.log(prior / (1 - prior))])}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.mu, self.sd = np.zeros(STATS, np.float32), np.ones(STATS, np.float32)

    def forward(self, bucket, first, figures, poff):
        p = self.p
        size = np.diff(first).astype(np.float32)[:, None]
        m = np.add.reduceat(p["E"][bucket], first[:-1], axis=0) / size
        s = (figures - self.mu) / self.sd
        h = np.tanh(m + s @ p["W"] + p["b"])
        t, u = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        g = (t * u) @ p["w"]
        bag = np.repeat(np.arange(len(poff) - 1), np.diff(poff))
        x = np.exp(g - np.maximum.reduceat(g, poff[:-1])[bag])
        a = x / np.add.reduceat(x, poff[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, poff[:-1], axis=0)
        logit = z @ p["c"] + p["c0"]
        return logit, (bucket, first, size, s, h, t, u, a, bag, z, poff)

    def score(self, *bag) -> np.ndarray:
        return 1 / (1 + np.exp(-self.forward(*bag)[0].astype(np.float64))) if len(bag[3]) > 1 else np.zeros(0)

    def gradients(self, y, bag):
        p = self.p
        logit, (bucket, first, size, s, h, t, u, a, ids, z, poff) = self.forward(*bag)
        d = ((1 / (1 + np.exp(-logit)) - y) / len(y)).astype(np.float32)
        dz = d[:, None] * p["c"]
        da = (h * dz[ids]).sum(1)
        dg = a * (da - np.add.reduceat(a * da, poff[:-1])[ids])
        dtu = dg[:, None] * p["w"]
        dt, du = dtu * u * (1 - t * t), dtu * t * u * (1 - u)
        dh = a[:, None] * dz[ids] + dt @ p["V"].T + du @ p["U"].T
        dpre = dh * (1 - h * h)
        dm = np.repeat(dpre / size, np.diff(first), axis=0)
        order = np.argsort(bucket, kind="stable")
        at = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        dE = np.zeros_like(p["E"])
        dE[bucket[order][at]] = np.add.reduceat(dm[order], at, axis=0)
        return {"E": dE, "W": s.T @ dpre, "b": dpre.sum(0), "V": h.T @ dt, "U": h.T @ du, "w": (t * u).T @ dg,
                "c": z.T @ d, "c0": d.sum(keepdims=True)}

    def fit(self, bags: list, y: np.ndarray, epochs: int = 14, batch: int = 64, rate: float = 0.01, seed: int = 11):
        """Adam over shuffled batches of single-document bags."""
        figures = np.concatenate([b[2] for b in bags])
        self.mu, self.sd = figures.mean(0), figures.std(0) + 1e-3
        r, m, v, step = np.random.default_rng(seed), {}, {}, 0
        for epoch in range(epochs):
            lr = rate * (0.5 if epoch >= epochs - 4 else 1)
            order = r.permutation(len(bags))
            for i in range(0, len(order), batch):
                part = [bags[k] for k in order[i:i + batch]]
                g = self.gradients(y[order[i:i + batch]], joined(part))
                step += 1
                for k, x in g.items():
                    x = x + 1e-4 * self.p[k]
                    m[k] = .9 * m.get(k, 0) + .1 * x
                    v[k] = .99 * v.get(k, 0) + .01 * x * x
                    self.p[k] = (self.p[k] - lr * (m[k] / (1 - .9 ** step)) / (np.sqrt(v[k] / (1 - .99 ** step)) + 1e-7)).astype(np.float32)
        return self


def joined(bags: list):
    """One set of arrays of several documents' bags."""
    words_at = np.cumsum([0] + [len(b[0]) for b in bags])
    first = np.concatenate([b[1][:-1] + w for b, w in zip(bags, words_at)] + [words_at[-1:]])
    return (np.concatenate([b[0] for b in bags]), first, np.concatenate([b[2] for b in bags]),
            np.cumsum([0] + [len(b[2]) for b in bags]))


def held_out(doc_id: Column | str) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> Network:
    """Fit on at most ``fit_docs`` labelled documents that are not held out; of
    rows that repeat a doc_id, on the least text."""
    known = labels.where("doc_id is not null and quality is not null").where(~held_out("doc_id")) \
        .groupBy(F.col("doc_id").alias("id")).agg(F.max("quality").alias("y"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(fit_docs)

    def encode(batches):
        for rows, data, off in text_blocks(batches):
            for i in range(rows.num_rows):
                b, first, fig, _ = passages(data[off[i]:off[i + 1]], off[i:i + 2] - off[i])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).slice(i, 1), rows.column(2).slice(i, 1), pa.array([b.astype("<i2").tobytes()]),
                     pa.array([first.astype("<i4").tobytes()]), pa.array([fig.tobytes()])], names=["doc_id", "y", "b", "f", "s"])

    rows = docs.join(known, F.col("doc_id") == F.col("id")).groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").cast("int").alias("y")) \
        .mapInArrow(encode, "doc_id long, y int, b binary, f binary, s binary").toArrow()  # fit_docs documents
    rows = sorted(rows.to_pylist(), key=lambda r: (r["doc_id"], r["b"]))
    y = np.array([r["y"] for r in rows], np.float32)
    net = Network(prior=(float(y.sum()) + 3) / (len(y) + 4))
    if len(y) and 0 < y.sum() < len(y):
        bags = [(np.frombuffer(r["b"], "<i2").astype(np.int32), np.frombuffer(r["f"], "<i4").astype(np.int64),
                 np.frombuffer(r["s"], np.float32).reshape(-1, STATS)) for r in rows]
        net.fit(bags, y)
    return net


def score(docs: DataFrame, net: Network, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with column ``out``, the score of every row's text."""
    model = docs.sparkSession.sparkContext.broadcast(net)  # BUCKETS * DIM floats
    keep = [c for c in docs.columns if c.lower() != out.lower()]
    plain = docs.select(*quoted(keep)).toDF(*[f"c{i}" for i in range(len(keep))])  # names may hold dots

    def run(batches):
        for rows, data, off in text_blocks(batches, f"c{keep.index(text)}"):
            got = pa.array(model.value.score(*passages(data, off)), pa.float64())
            yield pa.RecordBatch.from_arrays([*rows.columns, got], names=[*rows.schema.names, "score"])

    return plain.mapInArrow(run, schema_of(plain, plain.columns, "score double")).toDF(*keep, out)


def classify(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    net = train(docs, labels, fit_docs)
    return score(docs, net).select("doc_id", held_out("doc_id").alias("held_out"), "score",
                                   (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
