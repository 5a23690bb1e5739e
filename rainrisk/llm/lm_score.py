"""Language-model scoring by masked pseudo-likelihood.

A bidirectional window network (numpy) predicts every word of a text from
the ``SIDE`` words on either side of it; a document's score is the sum of the
conditional log-probabilities of all its words, each masked in turn.

* Vocabulary: words (A-Z lower-cased) of all documents are counted. The
  tables grow with the distinct words counted: ``side`` classes of ``side``
  ids, side = max(CLASSES, distinct ** (1/3)). The most frequent words
  have an id of their own, all others share the last ``side`` ids by hash. A rare
  word's probability is its id's times its exact share of the id's corpus
  count: rare words are counted per document, joined with the counts of all
  words by hash, and summed per row (frequent words are never sent).
* Encoding: each text is cut into words and looked up once and kept as ids,
  beside its phase and its rare words; training and scoring read those.
* Network: a table of vectors per window position, summed, tanh, then a
  three-level softmax over a tree of the ids with side ** (2/3) branches a
  level, so one prediction costs three small products instead of one over the
  vocabulary. A chunk's words are sorted by id: words of one inner branch stand
  together, and a step touches only branches and vectors that occur. It starts from the ids' corpus shares (biases).
* Training predicts every word of every document once: a document's words
  take ``MASK`` phases in turn (from a phase of its own) and each of the
  ``ROUNDS`` rounds predicts the words of its share of the phases. A task runs
  over its partition with AdaGrad from the broadcast parameters and returns
  its parameters; they are averaged by the number of
  predictions, slice by slice in Spark. A lost task is simply run again.
  The averaged model that reaches the driver grows with the vocabulary.

Cases: null or empty texts and texts without words have no words, score 0
and mean null; a null doc_id is scored like any other; repeated rows are
scored each; an empty table gives an empty result; very long texts are
scored whole, a chunk of words at a time; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, materialise, signed, table, text_blocks, words

SIDE = 2
CLASSES, WITHIN = 64, 64
IDS = CLASSES * WITHIN
RARE = 64
OWN = IDS - RARE
DIM = 16
TAIL_BITS = 20
MASK = 8
ROUNDS = 2
CHUNK, STEP = 1 << 16, 1 << 15  # words scored, and learned, at once
BLOCK_WORDS = 1 << 17           # of encoded documents held at once
SLICES, MOST_SLICES = 16, 4096
PAD = IDS


def side_of(distinct: int) -> int:
    """Classes, and ids of a class, for so many distinct words."""
    return max(CLASSES, int(np.ceil(distinct ** (1 / 3))))


class Vocabulary:
    """Ids of word hashes; log mean share of rare words within their id.
    ``tail``: per bucket (corpus count, distinct words) of rare words."""

    def __init__(self, own: np.ndarray, own_counts: np.ndarray, tail: np.ndarray, side: int = CLASSES):
        self.order = np.argsort(own)
        self.keys = own[self.order]
        # where the keys with the same first bits begin: a word is looked for among a key or two
        bits = max(1, int(len(own)).bit_length() + 2)
        self.shift = U64(64 - bits)
        self.begin = np.searchsorted(self.keys >> self.shift, np.arange((1 << bits) + 1, dtype=U64)).astype(np.int32)
        self.longest = int(np.diff(self.begin).max()) if len(own) else 0
        self.side, self.first_rare = side, side * side - side
        self.count, self.distinct = tail
        self.per = np.zeros(side)
        b = np.arange(len(self.count))
        np.add.at(self.per, b % side, self.count)
        self.freq = np.zeros(side * side)  # corpus count of every id
        self.freq[:len(own)] = own_counts
        self.freq[self.first_rare:] = self.per
        each = np.where(self.distinct > 0, self.count / np.maximum(self.distinct, 1), 1.0)
        self.share = np.log(each / np.maximum(self.per[b % side], 1.0)).astype(np.float32)

    def ids(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, log mean share within the id) of each word hash."""
        ids, share = np.zeros(len(h), np.int32), np.zeros(len(h), np.float32)
        rare = np.arange(len(h))
        if len(self.keys):
            at = np.take(self.begin, (h >> self.shift).astype(np.int64))
            ids = np.take(self.order, at, mode="clip").astype(np.int32)
            rare = np.flatnonzero(np.take(self.keys, at, mode="clip") != h)
            for step in range(1, self.longest):  # those that are not the first key with their bits
                then = np.minimum(at[rare] + step, len(self.keys) - 1)
                hit = self.keys[then] == h[rare]
                ids[rare[hit]] = self.order[then[hit]]
                rare = rare[~hit]
        bucket = (h[rare] >> U64(64 - TAIL_BITS)).astype(np.int64)
        ids[rare] = self.first_rare + bucket % self.side
        share[rare] = self.share[bucket % len(self.share)]
        return ids, share


def _sorted(keys: np.ndarray, limit: int) -> np.ndarray:
    """Positions in the order of ``keys`` below ``limit`` (by radix where they fit 16 bits)."""
    return np.argsort(keys.astype(np.uint16), kind="stable") if limit <= 1 << 16 else np.argsort(keys, kind="stable")


class WindowNetwork:
    """``side ** 2`` ids in a tree of three levels with ``fan`` branches each;
    ``W`` and ``c`` hold a small softmax for every inner branch."""

    def __init__(self, side: int = CLASSES, seed: int = 3):
        r = np.random.default_rng(seed)
        f, self.side = np.float32, side
        self.fan = s = next(x for x in range(max(1, int(round(side ** (2 / 3))) - 1), side + 2) if x ** 3 >= side * side)
        self.p = {"E": r.normal(0, .1, (2 * SIDE, side * side + 1, DIM)).astype(f), "b": np.zeros(DIM, f)}
        for level in range(3):
            self.p[f"W{level}"] = r.normal(0, .1, (s ** level, DIM, s)).astype(f)
            self.p[f"c{level}"] = np.zeros((s ** level, s), f)

    def start_from(self, freq: np.ndarray) -> WindowNetwork:
        """Biases of the corpus counts: before training it predicts each id's share."""
        s = self.fan
        f = np.zeros(s ** 3)  # places of the tree that no id has keep next to nothing
        f[:len(freq)] = freq + .01
        f = np.maximum(f, 1e-9).reshape(s, s, s)
        for level, x in enumerate((f.sum((1, 2)).reshape(1, s), f.sum(2), f.reshape(s * s, s))):
            self.p[f"c{level}"] = np.log(x / x.sum(1, keepdims=True)).astype(np.float32)
        return self

    def hidden(self, ctx: np.ndarray) -> np.ndarray:
        x, of = np.repeat(self.p["b"][None], len(ctx), axis=0), np.ascontiguousarray(ctx.T)
        for table, at in zip(self.p["E"], of):
            x += np.take(table, at, axis=0, mode="clip")  # ids are in range; "clip" spares a check
        return np.tanh(x, out=x)

    def _branches(self, ids: np.ndarray, level: int):
        """For sorted ids: the branch to take, the inner branches met, and where the rows of each begin."""
        s = self.fan
        key = ids // s ** (3 - level)
        start = np.flatnonzero(np.diff(key, prepend=-1))
        return (ids // s ** (2 - level)) % s, key[start], np.append(start, len(ids))

    def _exps(self, h: np.ndarray, level: int, keys: np.ndarray, cut: np.ndarray):
        """The branches' unnormalised probabilities, and their sums."""
        w, c, x = self.p[f"W{level}"], self.p[f"c{level}"], np.empty((len(h), self.fan), h.dtype)
        for k, a, z in zip(keys.tolist(), cut[:-1].tolist(), cut[1:].tolist()):
            part = x[a:z]
            np.dot(h[a:z], w[k], out=part)
            part += c[k]
        np.minimum(x, 80, out=x)  # below overflow; tanh units keep sums far from it
        np.exp(x, out=x)
        return x, x @ np.ones(self.fan, x.dtype)

    def log_prob(self, ctx: np.ndarray, ids: np.ndarray) -> np.ndarray:
        order = _sorted(ids, self.side ** 2)
        ids, h, row = ids[order], self.hidden(ctx[order]), np.arange(len(ids))
        lp = np.zeros(len(ids), np.float32)
        for level in range(3):
            take, keys, cut = self._branches(ids, level)
            x, total = self._exps(h, level, keys, cut)
            lp += np.log(x[row, take] / total)
        out = np.empty_like(lp)
        out[order] = lp
        return out

    def step(self, ctx: np.ndarray, ids: np.ndarray, acc: dict, rate: float) -> None:
        """One AdaGrad step on a chunk of masked words; only rows of the tables that they touch are read or changed."""
        n, p, row = np.float32(len(ids)), self.p, np.arange(len(ids))

        def update(name, table, rows, grad):
            a = acc[name][table]
            sums = grad * grad
            sums += a[rows]
            a[rows] = sums
            grad *= p[name].dtype.type(rate)
            grad /= np.sqrt(sums, out=sums)
            p[name][table][rows] -= grad

        for name in p.keys() - acc.keys():
            acc[name] = np.full_like(p[name], 1e-8)
        order = _sorted(ids, self.side ** 2)
        ids, ctx = ids[order], ctx[order]
        h = self.hidden(ctx)
        dh, ones = np.zeros_like(h), np.ones(len(h), h.dtype)
        for level in range(3):
            take, keys, cut = self._branches(ids, level)
            d, total = self._exps(h, level, keys, cut)
            d *= (1 / total)[:, None]
            d[row, take] -= 1
            w, g, gc = p[f"W{level}"], np.empty((len(keys), DIM, self.fan), h.dtype), np.empty((len(keys), self.fan), h.dtype)
            for i, (k, a, z) in enumerate(zip(keys.tolist(), cut[:-1].tolist(), cut[1:].tolist())):
                part = d[a:z]
                np.dot(h[a:z].T, part, out=g[i])
                np.dot(ones[a:z], part, out=gc[i])
                dh[a:z] += part.dot(w[k].T)
            g /= n
            gc /= n
            update(f"W{level}", ..., keys, g)
            update(f"c{level}", ..., keys, gc)
        dx = dh * (1 - h * h)
        dx /= n
        update("b", ..., slice(None), dx.sum(0))
        for j in range(2 * SIDE):
            order = _sorted(ctx[:, j], self.side ** 2 + 1)
            at = np.flatnonzero(np.diff(ctx[order, j], prepend=-1))
            update("E", j, ctx[order[at], j], np.add.reduceat(np.take(dx, order, axis=0, mode="clip"), at, axis=0))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)])

    def load(self, flat: np.ndarray) -> WindowNetwork:
        at = 0
        for k in sorted(self.p):
            n = self.p[k].size
            self.p[k] = flat[at:at + n].astype(np.float32).reshape(self.p[k].shape).copy()
            at += n
        return self


def windows(ids: np.ndarray, doc: np.ndarray, pick: np.ndarray, pad: int = PAD) -> np.ndarray:
    """Context ids (left to right) of the words at ``pick``; ``pad`` outside the document."""
    out = np.empty((len(pick), 2 * SIDE), np.int32)
    own = doc[pick]
    for j, step in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)] if len(pick) else ()):
        at = pick + step
        ok = (at >= 0) & (at < len(ids)) & (np.take(doc, at, mode="clip") == own)
        out[:, j] = np.where(ok, np.take(ids, at, mode="clip"), pad)
    return out


def targets(h: np.ndarray, doc: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    """The words to predict in a round; over all rounds each word once."""
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    size = np.diff(np.append(first, len(doc)))
    place = np.arange(len(doc)) - np.repeat(first, size)
    own = np.repeat((h[first] % U64(MASK)).astype(np.int64), size)
    return np.flatnonzero((place + own) % max(MASK, rounds) * rounds // max(MASK, rounds) == turn)


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, n): occurrences of every word of all documents."""

    def run(batches):
        for _, data, off in text_blocks(batches):
            h, n = np.unique(words(data, off)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(h)), pa.array(n)], names=["h", "n"])

    return docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Ids of the most frequent words, and per shared id the sums of all others."""
    side = side_of(counts.count())
    top = counts.orderBy(F.desc("n"), "h").limit(side * side - side).toArrow()  # grows with distinct ** (2/3)
    own, n = top["h"].to_numpy(), top["n"].to_numpy()
    keys = np.sort(own)
    held = counts.sparkSession.sparkContext.broadcast(keys)

    def rare(batches):
        sums = np.zeros((2, side), np.int64)
        for b in batches:
            h = b.column(0).to_numpy()
            at = np.minimum(np.searchsorted(held.value, h), max(len(held.value) - 1, 0))
            left = held.value[at] != h if len(held.value) else np.ones(len(h), bool)
            to = ((h[left].view(U64) >> U64(64 - TAIL_BITS)) % U64(side)).astype(np.int64)
            np.add.at(sums[0], to, b.column(1).to_numpy()[left])
            np.add.at(sums[1], to, 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(side)), pa.array(sums[0]), pa.array(sums[1])], names=["b", "n", "d"])

    both = np.zeros((2, side))
    for r in counts.select("h", "n").mapInArrow(rare, "b long, n long, d long").groupBy("b").agg(F.sum("n"), F.sum("d")).collect():
        both[:, r[0]] = r[1], r[2]
    return Vocabulary(np.ascontiguousarray(own).view(U64), n.astype(np.float64), both, side)


ENCODED = "row long, doc_id long, n_words long, phase byte, ids binary, rare array<struct<h:long,times:int>>"


def id_type(vocab: Vocabulary) -> np.dtype:
    return np.dtype("<u2" if len(vocab.freq) <= 1 << 16 else "<i4")


def encode(docs: DataFrame, vocab) -> DataFrame:
    """Every row of ``docs (doc_id, text)`` with the ids of all its words in
    order, its phase, and (hash, times) of its rare words."""

    def run(batches):
        v = vocab.value
        kind = id_type(v)
        row = TaskContext.get().partitionId() << 33  # of rows: a number of their own
        for rows, data, off in text_blocks(batches):
            h, doc, _, _ = words(data, off)
            ids, _ = v.ids(h)
            n = rows.num_rows
            held = np.bincount(doc, minlength=n)
            begin = np.concatenate([[0], np.cumsum(held)])
            phase = np.zeros(n, np.int8)
            phase[held > 0] = h[begin[:-1][held > 0]] % U64(MASK)
            at = np.flatnonzero(ids >= v.first_rare)
            order = at[np.lexsort((h[at], doc[at]))]
            first = np.ones(len(order), bool)
            first[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
            start = np.flatnonzero(first)
            times = np.diff(np.append(start, len(order)))
            cut = np.searchsorted(doc[order][start], np.arange(n + 1))
            rare = pa.StructArray.from_arrays([pa.array(signed(h[order][start])), pa.array(times.astype(np.int32))], names=["h", "times"])
            flat = pa.py_buffer(ids.astype(kind).tobytes())
            ends = pa.py_buffer((begin * kind.itemsize).astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + np.arange(n)), rows.column(0), pa.array(held), pa.array(phase),
                 pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, ends, flat]).cast(pa.binary()),
                 pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), rare)], names=["row", "doc_id", "n_words", "phase", "ids", "rare"])
            row += n

    return docs.mapInArrow(run, ENCODED)


def text_ids(batches, vocab: Vocabulary):
    """Blocks of whole texts as (rows, ids, document index, a number that gives its phase) of every word."""
    for rows, data, off in text_blocks(batches):
        h, doc, _, _ = words(data, off)
        yield rows, vocab.ids(h)[0], doc, h


def kept_ids(batches, vocab: Vocabulary):
    """``text_ids`` of encoded rows."""
    kind = id_type(vocab)
    for rows, data, off in text_blocks(batches, "ids", BLOCK_WORDS * kind.itemsize):
        doc = np.repeat(np.arange(rows.num_rows), np.diff(off) // kind.itemsize)
        phase = rows.column(rows.schema.get_field_index("phase")).to_numpy().astype(U64)
        yield rows, np.frombuffer(data.tobytes(), kind).astype(np.int32), doc, phase[doc]


def train(docs: DataFrame, vocab, rounds: int = ROUNDS, rate: float = 0.1, blocks=text_ids, columns=("text",)) -> WindowNetwork:
    """Rounds of local AdaGrad over all partitions, averaged; ``blocks`` gives
    the words of ``columns``."""
    sc = docs.sparkSession.sparkContext
    # every task sends a model: no more tasks than twice the words' number of model bytes pays for
    tasks = max(sc.defaultParallelism, int(2 * vocab.value.freq.sum() // (4 * (2 * SIDE + 1) * DIM * len(vocab.value.freq))))
    docs = docs.coalesce(tasks)
    slices = min(MOST_SLICES, max(SLICES, tasks))  # so that a slice's average reads about one model
    net = WindowNetwork(vocab.value.side).start_from(vocab.value.freq)
    for turn in range(rounds):
        start = sc.broadcast(net.flat())

        def local(batches):
            net, acc, seen = WindowNetwork(vocab.value.side).load(start.value), {}, 0
            for _, ids, doc, h in blocks(batches, vocab.value):
                pick = targets(h, doc, turn, rounds)
                pick = np.random.default_rng(len(ids) + turn).permutation(pick)
                for i in range(0, len(pick), STEP):
                    part = pick[i:i + STEP]
                    net.step(windows(ids, doc, part, len(vocab.value.freq)), ids[part], acc, rate)
                seen += len(pick)
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(slices), pa.int32()), pa.array([seen] * slices, pa.int64()),
                     pa.array([x.tobytes() for x in np.array_split(net.flat(), slices)])], names=["slice", "n", "v"])

        def average(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, n, key = 0.0, 0, None
            for b in rows:
                for s, k, v in zip(*(b.column(c).to_pylist() for c in ("slice", "n", "v"))):
                    total, n, key = total + k * np.frombuffer(v, np.float32).astype(np.float64), n + k, s
            yield pa.RecordBatch.from_pydict({"slice": pa.array([key], pa.int32()), "v": [(total / n).astype(np.float32).tobytes()]})

        got = docs.select(*columns).mapInArrow(local, "slice int, n long, v binary").groupBy("slice") \
            .applyInArrow(average, "slice int, v binary").collect()  # the model, whatever the input
        if got:
            net.load(np.concatenate([np.frombuffer(r["v"], np.float32) for r in sorted(got, key=lambda r: r["slice"])]))
    return net


def score(encoded: DataFrame, vocab, net: WindowNetwork, counts: DataFrame) -> DataFrame:
    """(doc_id, n_words, log_prob): summed conditional log-probabilities."""
    model = encoded.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        v = vocab.value
        per = np.log(np.maximum(v.per, 1.0))
        for rows, ids, doc, _ in kept_ids(batches, v):
            lp = np.empty(len(ids))
            for i in range(0, len(ids), CHUNK):
                pick = np.arange(i, min(i + CHUNK, len(ids)))
                lp[pick] = model.value.log_prob(windows(ids, doc, pick, len(v.freq)), ids[pick])
            # rare words: of their id's probability the part of the exact count, which is joined
            at = np.flatnonzero(ids >= v.first_rare)
            lp[at] -= per[ids[at] - v.first_rare]
            sums = np.bincount(doc, weights=lp, minlength=rows.num_rows).astype(np.float64)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), rows.column(2), pa.array(sums)],
                                             names=["row", "doc_id", "n_words", "log_prob"])

    part = materialise(encoded.select("row", "doc_id", "n_words", "phase", "ids")
                       .mapInArrow(run, "row long, doc_id long, n_words long, log_prob double"), "lm-part")
    rare = encoded.select("row", F.explode("rare").alias("r")).select("row", F.col("r.h").alias("w"), "r.times")
    exact = rare.join(counts, F.col("w") == F.col("h")).groupBy("row").agg(F.sum(F.col("times") * F.ln("n")).alias("exact"))
    return part.join(exact.withColumnRenamed("row", "of"), F.col("row") == F.col("of"), "left") \
        .select("doc_id", "n_words", (F.col("log_prob") + F.coalesce("exact", F.lit(0.0))).alias("log_prob"))


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """Per row of ``docs (doc_id, text)``: doc_id, n_words, log_prob (sum over
    all words), mean_log_prob."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = materialise(word_counts(docs), "lm-counts")
    vocab = docs.sparkSession.sparkContext.broadcast(vocabulary(counts))
    encoded = materialise(encode(docs, vocab), "lm-words")
    net = train(encoded, vocab, blocks=kept_ids, columns=("phase", "ids"))
    out = score(encoded, vocab, net, counts)
    return out.withColumn("mean_log_prob", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood(table(spark, sf_dir, "documents"))
