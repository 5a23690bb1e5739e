"""Ranked lexical search: many queries share the partial scores of their terms.

Every item is ranked against all documents by a sum over its terms of
``w * ((1000000000 * tf) div (1000 * tf + 8 * m))``, all in 64-bit integers, so
that any grouping of the sum gives the same score.

* An item is a set of atoms (term, occurrences in the item), in descending
  order of the items that hold them. Neighbouring atoms that two or more items
  share become a node, nodes and atoms that neighbour again in two or more
  items the next one, and so on, until no pair is shared: the nodes are the
  shared term sets, and with the items the sharing DAG. Time and size are
  linear in the items' terms for each of the rounds.
* One pass over the texts writes, for every document, its length and its
  occurrences of the items' terms; N, L and the df are sums over that table.
* A second pass takes its rows in blocks: the atoms' accumulators (one integer
  for each document of the block) are filled once, every node's is the sum of
  its two parts, and an item's scores the sum of the nodes left in it. A task
  keeps each item's best ``k`` documents.
* Tasks' lists meet per item and share of the documents, then per item.

Items are taken in batches of about ``BATCH_TERMS`` terms (all that the driver
and a broadcast plan hold of them); a batch is one pass over the documents.
Terms stand as 64-bit hashes.

Cases: null text and text without terms have no score and count in no
statistic; equal items (id and text) are answered once, an id that repeats with
another text is an item of its own and each has its own ranks; a null item_id
is an id; each row of documents counts and is ranked, repeated ones too; equal
scores go by doc_id, null last; scores of 0 are left out; empty tables give an
empty result; other columns are not read. Long texts are cut between terms.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, signed, table, text_blocks, words

K = 10
BATCH_TERMS = 1 << 16
TEXT_BYTES = 1 << 18         # bytes of text a step holds
ACCUMULATOR_BYTES = 24 << 20  # of a block's accumulators
SHARES = 64                  # parts of an item's candidates ranked apart first
_TERM = np.zeros(256, bool)
_TERM[0x80:] = True
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    _TERM[_a:_b] = True


# ------------------------------------------------------------------- counting

def _pieces(data: np.ndarray, off: np.ndarray):
    """A block as (bytes, offsets); a long text cut behind bytes that end terms."""
    if len(data) <= 2 * TEXT_BYTES or len(off) != 2:
        yield data, off
        return
    at = 0
    while at < len(data):
        end = min(at + TEXT_BYTES, len(data))
        while end < len(data) and _TERM[data[end - 1]]:
            more = np.flatnonzero(~_TERM[data[end:end + TEXT_BYTES]])
            end = end + int(more[0]) + 1 if len(more) else min(end + TEXT_BYTES, len(data))
        yield data[at:end], np.array([0, end - at])
        at = end


def counted(data: np.ndarray, off: np.ndarray, vocabulary: np.ndarray | None = None):
    """Per document of a block: number of terms; and (document, term, count)
    of its terms in ``vocabulary`` (sorted hashes; all terms without one),
    terms as positions in the vocabulary returned last."""
    docs = len(off) - 1
    n, found = np.zeros(docs, np.int64), []
    for piece, o in _pieces(data, off):
        h, doc, _, _ = words(piece, o, _TERM)
        n += np.bincount(doc, minlength=docs)
        if vocabulary is not None:
            at = np.searchsorted(vocabulary, h)
            at[at == len(vocabulary)] = 0
            ok = vocabulary[at] == h
            h, doc = h[ok], doc[ok]
        found.append(_summed(doc, h, np.ones(len(h), np.int64)))
    doc, h, tf = _summed(*(np.concatenate(x) for x in zip(*found))) if len(found) > 1 else found[0]
    if vocabulary is None:
        vocabulary = np.unique(h)
    return n, doc, np.searchsorted(vocabulary, h), tf, vocabulary


def _summed(doc: np.ndarray, h: np.ndarray, tf: np.ndarray):
    order = np.lexsort((h, doc))
    doc, h, tf = doc[order], h[order], tf[order]
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.zeros(0, np.int64)
    return doc[first], h[first], np.add.reduceat(tf, first) if len(h) else tf


def _lists(doc: np.ndarray, values: np.ndarray, docs: int) -> pa.Array:
    off = np.zeros(docs + 1, np.int32)
    np.cumsum(np.bincount(doc, minlength=docs), out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values))


def _count_rows(df: DataFrame, id_col: str, vocabulary: np.ndarray | None) -> DataFrame:
    """(id, n, terms, tfs) of every text; terms are hashes, or positions in
    the vocabulary."""
    def run(batches):
        for rows, data, off in text_blocks(batches, block_bytes=TEXT_BYTES):
            n, doc, at, tf, known = counted(data, off, vocabulary)
            yield pa.RecordBatch.from_pydict({
                "id": rows.column(0), "n": n, "tfs": _lists(doc, tf, len(n)),
                "terms": _lists(doc, signed(known[at]) if vocabulary is None else at.astype(np.int64), len(n))})
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(f"`{id_col}`").alias("id"), F.col("text")) \
        .mapInArrow(run, f"id {kind}, n long, tfs array<long>, terms array<long>")


# --------------------------------------------------------------------- sharing

def shared(items: list[np.ndarray], atoms: int):
    """The sharing DAG of ``items`` (lists of distinct atoms): per round the
    two parts of each node (numbered on from ``atoms``), and what is left of
    the items as one array with offsets."""
    flat = np.concatenate(items) if items else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(items)), [len(x) for x in items])
    held = np.bincount(flat, minlength=atoms)
    flat = flat[np.lexsort((flat, -held[flat], owner))]
    rounds, nodes = [], atoms
    while len(flat) > 1:
        code = np.where(owner[:-1] == owner[1:], flat[:-1] * nodes + flat[1:], -1)
        _, inverse, count = np.unique(code, return_inverse=True, return_counts=True)
        c = np.where(code < 0, 0, count[inverse])
        c[c < 2] = 0
        left, right = np.r_[0, c[:-1]], np.r_[c[1:], 0]
        take = np.flatnonzero((c > 0) & (c > left) & (c >= right))  # no two neighbours
        pairs, inverse, count = np.unique(code[take], return_inverse=True, return_counts=True)
        new = np.cumsum(count > 1) - 1
        if not (count > 1).any():
            break
        ok = count[inverse] > 1
        take, inverse = take[ok], inverse[ok]
        pairs = pairs[count > 1]
        rounds.append((pairs // nodes, pairs % nodes))
        flat = flat.copy()
        flat[take] = nodes + new[inverse]
        keep = np.ones(len(flat), bool)
        keep[take + 1] = False
        flat, owner, nodes = flat[keep], owner[keep], nodes + len(pairs)
    off = np.searchsorted(owner, np.arange(len(items)))
    return rounds, nodes, flat, off


class Plan:
    """A batch of items: their atoms, sharing DAG and ids."""

    def __init__(self, rows: list):
        self.ids = [r["id"] for r in rows]
        hashes = [np.array(r["terms"], np.int64).view(np.uint64) for r in rows]
        self.vocabulary = np.unique(np.concatenate(hashes))
        terms = [np.searchsorted(self.vocabulary, h) for h in hashes]
        times = [np.array(r["tfs"], np.int64) for r in rows]
        both = np.stack([np.concatenate(terms), np.concatenate(times)])
        atoms, inverse = np.unique(both, axis=1, return_inverse=True)
        self.term, self.times = atoms
        cut = np.cumsum([len(t) for t in terms])[:-1]
        self.rounds, self.nodes, self.left, self.off = shared(np.split(inverse.reshape(-1), cut), len(self.term))
        self.weight = None

    def scores(self, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        """(items, documents) of a block of documents with length factors ``m``."""
        base = np.zeros((len(self.vocabulary), len(m)), np.int64)
        base[term, doc] = self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        acc = np.empty((self.nodes, len(m)), np.int64)
        at = len(self.term)
        np.take(base, self.term, axis=0, out=acc[:at])
        acc[:at] *= self.times[:, None]
        for a, b in self.rounds:
            np.add(acc[a], acc[b], out=acc[at:at + len(a)])
            at += len(a)
        return np.add.reduceat(acc[self.left], self.off, axis=0)

    def block(self) -> int:
        """Documents whose accumulators fit."""
        rows = len(self.vocabulary) + self.nodes + 2 * max((len(a) for a, _ in self.rounds), default=0) + len(self.left) + 4 * len(self.ids)
        return max(1, min(4096, ACCUMULATOR_BYTES // (8 * rows)))


# --------------------------------------------------------------------- ranking

class _Best:
    """The best ``k`` documents of each item among those offered."""

    def __init__(self, items: int, k: int):
        self.k, self.kth = k, np.zeros(items, np.int64)
        z = np.zeros(0, np.int64)
        self.item, self.score, self.doc, self.null = z, z, z, np.zeros(0, bool)

    def offer(self, scores: np.ndarray, docs: np.ndarray, null: np.ndarray) -> None:
        least = np.maximum(self.kth, 1)
        if scores.shape[1] > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        item, at = np.nonzero(scores >= least[:, None])
        if not len(item):
            return
        item, score = np.r_[self.item, item], np.r_[self.score, scores[item, at]]
        doc, null = np.r_[self.doc, docs[at]], np.r_[self.null, null[at]]
        order = np.lexsort((doc, null, -score, item))
        item, score, doc, null = item[order], score[order], doc[order], null[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        self.kth[item[rank == self.k - 1]] = score[rank == self.k - 1]
        ok = rank < self.k
        self.item, self.score, self.doc, self.null = item[ok], score[ok], doc[ok], null[ok]


def _ranked(counts: DataFrame, plan: Plan, total: int, words_in_all: int, k: int, id_type: str, item_type: str) -> DataFrame:
    ids = pa.array(plan.ids)

    def run(batches):
        best, size = _Best(len(plan.ids), k), plan.block()
        for b in batches:
            for i in range(0, b.num_rows, size):
                part = b.slice(i, size)
                terms, tfs = part.column("terms"), part.column("tfs")
                doc = np.repeat(np.arange(part.num_rows), np.diff(terms.offsets.to_numpy()))
                m = np.array([25 + 75 * n * total // words_in_all for n in part.column("n").to_pylist()], np.int64)
                got = plan.scores(doc, terms.flatten().to_numpy(), tfs.flatten().to_numpy(), m)
                null = part.column("id").is_null().to_numpy(zero_copy_only=False)
                best.offer(got, part.column("id").fill_null(0).to_numpy(), null)
        yield pa.RecordBatch.from_pydict({
            "item": best.item, "item_id": ids.take(pa.array(best.item)), "score": best.score,
            "doc_id": pa.array(best.doc, mask=best.null)})

    rows = counts.where("n > 0").mapInArrow(run, f"item long, item_id {item_type}, score long, doc_id {id_type}")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    share = F.pmod(F.hash("doc_id"), F.lit(SHARES))
    few = rows.withColumn("rank", F.row_number().over(Window.partitionBy("item", share).orderBy(*order))).where(F.col("rank") <= k)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, doc_col: str = "doc_id", item_col: str = "item_id",
           batch_terms: int = BATCH_TERMS) -> DataFrame:
    """Each item's ``k`` best documents: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    asked = materialise(_count_rows(items.select(f"`{item_col}`", "text").distinct(), item_col, None).where("n > 0"), "search-items")
    terms = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    item_type, id_type = items.schema[item_col].dataType.simpleString(), docs.schema[doc_col].dataType.simpleString()
    batches, out = -(-terms // batch_terms), []
    for i in range(batches):
        mine = asked.where(F.pmod(F.xxhash64("id", "terms", "tfs"), F.lit(batches)) == i)
        rows = mine.select("id", "terms", "tfs").collect()  # about batch_terms terms
        if not rows:
            continue
        plan = Plan(rows)
        counts = materialise(_count_rows(docs, doc_col, plan.vocabulary), "search-counts")
        total, length = counts.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
        if not total:
            continue
        df = np.zeros(len(plan.vocabulary), np.int64)
        for r in counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            df[r["t"]] = r["count"]
        plan.weight = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        out.append(_ranked(counts, plan, total, length, k, id_type, item_type))
    if not out:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {id_type}, score long")
    return reduce(DataFrame.union, out)


def op13_lexical(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
OP13_SQL = rf"""
WITH lowered AS (
  SELECT 0 AS item, doc_id AS id, text FROM documents
  UNION ALL SELECT 1, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
texts AS MATERIALIZED (
  SELECT item, id, row_number() OVER () AS row,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERMS}') AS ts
  FROM lowered WHERE text IS NOT NULL),
tf AS MATERIALIZED (
  SELECT item, id, row, len(ts) AS n, term, count(*) AS tf FROM texts, unnest(ts) AS u(term) GROUP BY ALL),
size AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM texts WHERE item = 0 AND len(ts) > 0),
weight AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
           FROM tf, size WHERE item = 0 GROUP BY term, n_docs),
scored AS (
  SELECT q.row, q.id AS item_id, d.id AS doc_id, d.row AS drow,
         CAST(sum(q.tf * w * ((1000000000 * d.tf) // (1000 * d.tf + 8 * (25 + (75 * d.n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM tf q JOIN tf d USING (term) JOIN weight USING (term), size
  WHERE q.item = 1 AND d.item = 0 GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= {K}
"""
