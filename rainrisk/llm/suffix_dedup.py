"""Suffix-array dedup: remove every byte covered by a string of ``length``
bytes that also starts anywhere else in the corpus (same document included).

A full suffix array of a large corpus can't be exchanged (hundreds of bytes a
suffix), and need not be. The array is built over *anchors*, positions chosen
by their own right context only, so that equal texts have equal anchors:

* a position is an anchor if the hash of its ``GRAM`` bytes is the least of
  the next ``REACH`` positions; where that leaves a gap of more than ``GAP``
  bytes, the positions in the gap are anchors too.

Every start of a ``length``-byte string so has an anchor at most ``GAP``
bytes on, and a repeat of the string has the same anchor at the same offset.
An anchor's suffix matters if its next ``length - GAP`` bytes occur twice
(counted by hash; a collision only adds work). Those suffixes, cut
``length`` bytes behind the next anchor, are sorted by a distributed merge sort:

1. each task sorts its suffixes, folds equal ones, and cuts the run at global
   splitters; runs travel front-coded: common prefix with the one before, and
   the rest. Splitters are whole suffixes out of the runs, sampled by hash in
   every task, so their number grows with the bytes of the runs and a prefix
   that very many suffixes share is cut at deeper bytes. A range starts with
   its splitter, so the common prefix across a border is that of the last
   suffix before it with the splitter;
2. each range merges its runs with a loser tree that keeps, for every head,
   its common prefix with the last output: heads with different prefixes are
   ordered by that number alone, equal ones are compared from there on, so a
   known prefix is never compared again. The common prefixes of neighbours in
   the merged order give M, the longest repeat that starts at each anchor.

From M the starts between anchors are known (a repeat at p of length M makes
the starts up to p + M - length repeats; a start cannot repeat further than
the next anchor's repeat) except just before an anchor whose repeat reaches
further than the anchor's before it. These edges are settled by counting
their ``length``-byte strings by hash (64 bits, of string, context and offset), only for anchors that share
their context with an edge, and only where the bytes common to a stretch of
such strings occur twice. Anchors with equal bytes on either side, as far as
such a string reaches, are one kind: one of them is compared and counts for all,
so a line that every document holds costs as many rows as it has
surroundings; what is found holds for each anchor of the kind. All joins are on hashes or document keys and
counts are partial before a shuffle; texts of a copied document meet as one
folded suffix per run, so a group of copies is never collected.

Cases: null text is empty; texts shorter than ``length`` lose nothing;
matches never cross documents; rows that repeat a doc_id are documents of
their own (so a row read twice removes its whole text); a null doc_id is
treated like any other; an empty table gives an empty result; other columns
are not read. Offsets are bytes of UTF-8; a cut may split a character.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import U64, filter_bits, materialise, mix, passes, prefix_hash, release, schema_of, signed, table, text_blocks

GRAM, REACH, GAP = 16, 64, 256  # for strings of 400 bytes and more, see ``scale``
RUN_BYTES = 48 << 20    # payload a task sorts at once
RANGE_BYTES = 24 << 20  # payload a range merges
PER_RANGE = 16          # sampled suffixes of a range

KEY = ["doc_id", "tkey"]


# ------------------------------------------------------------------ anchors

def scale(length: int) -> tuple[int, int, int]:
    """(gram, reach, gap) for strings of ``length`` bytes: an anchor's choice
    must lie inside every string it stands for. Reach is a power of two."""
    part = min(1.0, length / 400)
    return max(1, int(GRAM * part)), 1 << max(0, int(REACH * part).bit_length() - 1), int(GAP * part)


def anchors(data: np.ndarray, off: np.ndarray, length: int):
    """Anchors of a block of documents: (document, position in it, bytes back
    to the anchor before, bytes ahead to the next (at most the gap), hash of
    the next ``length`` less gap bytes)."""
    gram, reach, gap = scale(length)
    need = length - gap
    s, inv = prefix_hash(data)
    n = len(data)
    if n < need:
        z = np.zeros(0, np.int64)
        return z, z, z, z, np.zeros(0, U64)
    g = np.full(n, 0xFFFFFFFF, np.uint32)
    g[:n - gram + 1] = (((s[gram:] - s[:-gram]) * inv[:n - gram + 1]) * U64(0x9E3779B97F4A7C15) >> U64(32)).astype(np.uint32)
    low, width = g, 1
    while width < reach:
        nxt = low.copy()
        nxt[:n - width] = np.minimum(low[:n - width], low[width:])
        low, width = nxt, 2 * width
    least = low.copy()
    least[:-1] = np.minimum(low[:-1], low[1:])
    size = np.diff(off)
    pos = np.flatnonzero(g == least)
    doc = np.searchsorted(off, pos, "right") - 1
    ok = pos - off[doc] <= size[doc] - need
    pos, doc = pos[ok], doc[ok]
    # gaps: starts that have no anchor within the gap
    d = np.arange(len(size))[size >= length]
    ends = np.concatenate([pos, off[d] + size[d] - length + 1 + gap])      # next anchor, or behind the last start
    begins = np.concatenate([pos, off[d] - 1])
    edoc = np.concatenate([doc, d])
    o1, o2 = np.lexsort((ends, edoc)), np.lexsort((begins, edoc))
    bd, bp = edoc[o2], begins[o2]
    sel = np.isin(bd, d)
    bd, bp = bd[sel], bp[sel]
    ed, ep = edoc[o1], ends[o1]
    sel = np.isin(ed, d)
    ep = ep[sel]
    extra = []
    for k in np.flatnonzero(np.minimum(ep - gap, off[bd] + size[bd] - length + 1) - bp > 1):
        extra.append(np.arange(bp[k] + 1, min(ep[k] - gap, off[bd[k]] + size[bd[k]] - length + 1)))
    if extra:
        pos = np.unique(np.concatenate([pos, *extra]))
        doc = np.searchsorted(off, pos, "right") - 1
    back = np.diff(pos, prepend=-1)
    first = np.diff(doc, prepend=-1) != 0
    back[first] = (pos - off[doc] + 1)[first]
    ahead = np.full(len(pos), gap)
    same = ~first[1:]
    ahead[:-1][same] = np.minimum(back[1:][same], gap)
    h = mix((s[pos + need] - s[pos]) * inv[pos])
    return doc, pos - off[doc], back, ahead, h


def _find_anchors(docs: DataFrame, length: int) -> DataFrame:
    """Rows of anchors."""

    def run(batches):
        for rows, data, off in text_blocks(batches):
            doc, pos, back, ahead, h = anchors(data, off, length)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(pa.array(doc)), rows.column(1).take(pa.array(doc)), pa.array(pos.astype(np.int32)),
                 pa.array(back.astype(np.int32)), pa.array(ahead.astype(np.int16)), pa.array(signed(h))],
                names=[*KEY, "pos", "back", "ahead", "h"])

    return docs.mapInArrow(run, "doc_id long, tkey int, pos int, back int, ahead short, h long")


# ----------------------------------------------------------------- the runs

def common_from(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of a and b, known to be at least ``at``."""
    n = min(len(a), len(b))
    while at < n:
        m = min(n, at + 48)
        x, y = a[at:m], b[at:m]
        if x != y:
            for p, q in zip(x, y):
                if p != q:
                    return at
                at += 1
        at = m
    return n


def front_code(suffixes: list[tuple[bytes, int, int, bool]]) -> bytes:
    """Sorted distinct suffixes (bytes, hash, context hash, repeated) as one
    blob: per item the common prefix with the one before and the rest."""
    out, prev = [], b""
    for x, h, c, twice in suffixes:
        k = common_from(prev, x, 0)
        out.append(struct.pack("<HHqq?", k, len(x) - k, h, c, twice))
        out.append(x[k:])
        prev = x
    return zlib.compress(b"".join(out), 1)


_HEAD = struct.Struct("<HHqq?")


def read_run(blob: bytes) -> Iterator[tuple[int, bytes, int, int, bool]]:
    """(common prefix with the one before, suffix, hash, context hash, repeated)."""
    blob = zlib.decompress(blob) if blob else b""
    at, prev, end, size = 0, b"", len(blob), _HEAD.size
    while at < end:
        k, m, h, c, twice = _HEAD.unpack_from(blob, at)
        at += size
        prev = prev[:k] + blob[at:at + m]
        at += m
        yield k, prev, h, c, twice


def merge_runs(blobs: list[bytes]) -> Iterator[tuple[int, bytes, int, int, bool]]:
    """Loser tree over front-coded runs: items in order, each with its common
    prefix with the item before. A head's ``lcp`` is its common prefix with
    the last output; only heads with equal ``lcp`` are compared, from there."""
    runs = [read_run(b) for b in blobs]
    m = len(runs)
    size = 1
    while size < m:
        size *= 2
    head: list = [next(runs[i], None) if i < m else None for i in range(size)]
    text = [x[1] if x else None for x in head]
    lcp = [0] * size

    def beats(a: int, b: int) -> bool:
        """Does head a go before head b? The loser learns its common prefix with the winner."""
        x, y = text[a], text[b]
        if x is None or y is None:
            return y is None
        la, lb = lcp[a], lcp[b]
        if la != lb:
            return la > lb
        k = common_from(x, y, la)
        first = k == len(x) or (k < len(y) and x[k] < y[k])
        lcp[b if first else a] = k
        return first

    loser = [0] * size
    win = list(range(size)) if size == 1 else [0] * size + list(range(size))
    for i in range(size - 1, 0, -1):
        a, b = win[2 * i], win[2 * i + 1]
        win[i], loser[i] = (a, b) if beats(a, b) else (b, a)
    top = win[1] if size > 1 else 0
    while text[top] is not None:
        _, x, h, c, twice = head[top]
        yield lcp[top], x, h, c, twice
        head[top] = nxt = next(runs[top], None) if top < m else None
        if nxt is None:
            text[top] = None
        else:
            lcp[top], text[top] = nxt[0], nxt[1]
        i = (top + size) // 2
        while i:
            if beats(loser[i], top):
                loser[i], top = top, loser[i]
            i //= 2


def _lists_of(rows, names: int):
    """The struct list column ``a`` of a block: its fields and each item's document."""
    lists = rows.column(rows.schema.get_field_index("a"))
    n = np.array([len(x) for x in lists])
    flat = lists.flatten()
    return [flat.field(k).to_numpy().astype(np.int64) for k in range(names)], np.repeat(np.arange(rows.num_rows), n)


def _context_ends(pos: np.ndarray, ahead: np.ndarray, doc: np.ndarray, off: np.ndarray, length: int) -> np.ndarray:
    """Where an anchor's suffix is cut: ``length`` bytes behind the next
    anchor, which equal texts have at the same place."""
    return np.minimum(off[doc] + pos + ahead + length, off[doc + 1])


def _contexts(texts: DataFrame, length: int) -> DataFrame:
    """(doc_id, tkey, pos, back, h, c, b): anchors with the hash of their whole
    cut suffix, and of the bytes between them and the anchor before."""

    def run(batches):
        for rows, data, off in text_blocks(batches):
            s, inv = prefix_hash(data)
            (pos, back, ahead, h), doc = _lists_of(rows, 4)
            at, end = off[doc] + pos, _context_ends(pos, ahead, doc, off, length)
            c = signed(mix((s[end] - s[at]) * inv[at] + (end - at).astype(U64)))
            left = at - back + 1
            b = signed(mix((s[at] - s[left]) * inv[left] + back.astype(U64)))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(pa.array(doc)), rows.column(1).take(pa.array(doc)), pa.array(pos.astype(np.int32)),
                 pa.array(back.astype(np.int32)), pa.array(h), pa.array(c), pa.array(b)], names=[*KEY, "pos", "back", "h", "c", "b"])

    return texts.mapInArrow(run, "doc_id long, tkey int, pos int, back int, h long, c long, b long")


def _sample(texts: DataFrame, rate: int, length: int) -> DataFrame:
    """(x, h, c): about one of ``rate`` distinct suffixes of every task, chosen by hash."""

    def run(batches):
        sent: set[int] = set()
        for rows, data, off in text_blocks(batches):
            s, inv = prefix_hash(data)
            (pos, _, ahead, h), doc = _lists_of(rows, 4)
            at, end = off[doc] + pos, _context_ends(pos, ahead, doc, off, length)
            c = mix((s[end] - s[at]) * inv[at] + (end - at).astype(U64))
            out = []
            for i in np.flatnonzero(mix(c + U64(5)) % U64(rate) == 0):
                if int(c[i]) not in sent:
                    sent.add(int(c[i]))
                    out.append(i)
            c = signed(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([data[at[i]:end[i]].tobytes() for i in out], pa.binary()), pa.array(h[out].astype(np.int64)),
                 pa.array(c[out])], names=["x", "h", "c"])

    return texts.mapInArrow(run, "x binary, h long, c long")


def _splitters(texts: DataFrame, n: int, length: int) -> list[tuple[bytes, int, int]]:
    """Suffixes (bytes, hash, context hash) that cut the runs of ``n`` anchors into ranges of about RANGE_BYTES."""
    rate = max(1, RANGE_BYTES // (PER_RANGE * (length + GAP)))
    if n < 2 * rate * PER_RANGE:
        return []
    got = sorted((bytes(r["x"]), r["h"], r["c"]) for r in _sample(texts, rate, length).collect())  # 1/rate of the suffixes
    return sorted(set(got[PER_RANGE::PER_RANGE]))


def _suffix_runs(texts: DataFrame, splitters, length: int) -> DataFrame:
    """From (doc_id, tkey, text, a: anchors): front-coded sorted runs by range."""

    def run(batches):
        cuts = splitters.value
        held, size = {}, 0

        def runs():
            order, at = sorted(held), 0
            for r in range(len(cuts) + 1):
                end = bisect_left(order, cuts[r][0], at) if r < len(cuts) else len(order)
                if end > at:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r], pa.int32()), pa.array([front_code([(x, *held[x]) for x in order[at:end]])])], names=["range", "run"])
                at = end

        for rows, data, off in text_blocks(batches):
            s, inv = prefix_hash(data)
            (pos, _, ahead, h), doc = _lists_of(rows, 4)
            at, end = off[doc] + pos, _context_ends(pos, ahead, doc, off, length)
            c = signed(mix((s[end] - s[at]) * inv[at] + (end - at).astype(U64)))
            raw = data.tobytes()
            for a, e, x, y in zip(at.tolist(), end.tolist(), h.tolist(), c.tolist()):
                t = raw[a:e]
                was = held.get(t)
                if was is None:
                    held[t] = (x, y, False)
                    size += len(t)
                elif not was[2]:
                    held[t] = (x, y, True)
            if size >= RUN_BYTES:
                yield from runs()
                held.clear()
                size = 0
        yield from runs()

    return texts.mapInArrow(run, "range int, run binary")


def _longest(runs: DataFrame, splitters) -> DataFrame:
    """(h, c, m): per suffix the longest common prefix with any other in its
    range or across its border (the greatest m of a suffix holds)."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(rows)  # one range: about RANGE_BYTES
        blobs, cuts = [x.as_py() for b in held for x in b.column("run")], splitters.value
        here = held[0].column("range")[0].as_py()
        out: list[tuple[int, int, int]] = []
        last, text = None, b""  # (bytes, h, c, m) not yet sent, its suffix

        def batch():
            h, c, m = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(c, pa.int64()), pa.array(m, pa.int32())],
                                              names=["h", "c", "m"])

        for lcp, x, h, c, twice in merge_runs(blobs):
            own = len(x) if twice else 0
            if last is not None:
                if lcp == len(x) == last[0]:
                    last = (len(x), h, c, len(x))  # equal suffixes of two runs
                    continue
                out.append((last[1], last[2], max(last[3], lcp)))
                if len(out) >= 20000:
                    yield batch()
                    out.clear()
                own = max(own, lcp)
            last, text = (len(x), h, c, own), x
        if last is not None:
            across = 0
            if here < len(cuts):  # the next range starts with its splitter
                across = common_from(text, cuts[here][0], 0)
                out.append((*cuts[here][1:], across))
            out.append((*last[1:3], max(last[3], across)))
        if out:
            yield batch()

    return runs.groupBy("range").applyInArrow(run, "h long, c long, m int")


# -------------------------------------------------------------------- edges

#: Offsets before an anchor fall into these stretches; see ``_edge_cores``.
STRETCHES = [(1, 8), (9, 24), (25, 56), (57, 120), (121, GAP)]


def _edge_cores(docs: DataFrame, length: int) -> DataFrame:
    """(k1, k2, kind, n, lo, hi, own, whole): for each listed anchor
    and stretch of offsets lo..hi, the bytes that all its strings have in
    common, its kind and the kind's anchors, whether it asks for any of them, and a hash of lo, hi
    and the bytes that its strings cover. Where no other anchor of the same
    context has them, or none asks, no string need be compared."""
    gap = scale(length)[2]
    stretches = [(a, min(b, gap)) for a, b in STRETCHES if a <= gap]

    def run(batches):
        for rows, data, off in text_blocks(batches):
            s, inv = prefix_hash(data)
            (pos, lo, hi, ulo, uhi, h, kind, n), doc = _lists_of(rows, 8)
            for first, last in stretches:
                a, b = np.maximum(lo, first), np.minimum(hi, last)
                ok = (a <= b) & (pos >= a) & (off[doc] + pos - b + length <= off[doc + 1])
                p, d = pos[ok], doc[ok]
                start, end = off[d] + p - first, off[d] + p + length - last
                left, right = off[d] + p - b[ok], off[d] + p - a[ok] + length  # all bytes of its strings
                whole = mix((s[right] - s[left]) * inv[left]) ^ mix((a[ok] << 16 | b[ok]).astype(U64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(mix((s[end] - s[start]) * inv[start]))),
                     pa.array((mix(h[ok].view(U64) + U64(first)) >> U64(33)).astype(np.int32)), pa.array(kind[ok]),
                     pa.array(n[ok]), pa.array(a[ok].astype(np.int32)),
                     pa.array(b[ok].astype(np.int32)), pa.array((np.maximum(a, ulo) <= np.minimum(b, uhi))[ok]),
                     pa.array(signed(whole))], names=["k1", "k2", "kind", "n", "lo", "hi", "own", "whole"])

    return docs.mapInArrow(run, "k1 long, k2 int, kind long, n long, lo int, hi int, own boolean, whole long")


def _edge_strings(docs: DataFrame, length: int) -> DataFrame:
    """(k, n, kind, o) of the ``length``-byte strings at the listed offsets
    before the listed anchors: ``n`` anchors of the kind have it; ``kind`` and
    offset ``o`` only where they ask for it."""

    def run(batches):
        for rows, data, off in text_blocks(batches):
            s, inv = prefix_hash(data)
            (pos, lo, hi, ulo, uhi, h, kind, n), doc = _lists_of(rows, 8)
            for i in range(0, len(pos), 2048):
                part = slice(i, i + 2048)
                cnt = np.maximum(hi[part] - lo[part] + 1, 0)
                who = np.repeat(np.arange(len(cnt)), cnt)
                o = np.arange(cnt.sum()) - np.repeat(np.cumsum(cnt) - cnt, cnt) + lo[part][who]
                d, p = doc[part][who], pos[part][who]
                at = off[d] + p - o
                ok = (p >= o) & (at + length <= off[d + 1])
                who, o, d, p, at = who[ok], o[ok], d[ok], p[ok], at[ok]
                k = mix(mix((s[at + length] - s[at]) * inv[at]) ^ mix(h[part][who].view(U64) * U64(3) + o.astype(U64)))
                own = (o >= ulo[part][who]) & (o <= uhi[part][who])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(k)), pa.array(n[part][who]), pa.array(kind[part][who], mask=~own),
                     pa.array(o.astype(np.int32), mask=~own)], names=["k", "n", "kind", "o"])

    return docs.mapInArrow(run, "k long, n long, kind long, o int")


def _same(a: str, b: str):
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.tkey") == F.col(f"{b}.tkey"))


def _key(df: DataFrame) -> DataFrame:
    return df.select(F.xxhash64(*KEY).alias("k"))


def _sift(docs: DataFrame, lists: DataFrame, inside: bool) -> DataFrame:
    """``docs`` that may (``inside``) or surely do not have a list: a filter of
    bounded size, so that texts without a list are not shuffled to the join."""
    held = docs.sparkSession.sparkContext.broadcast(filter_bits(_key(lists)))
    cols = docs.columns

    def run(batches):
        for b in batches:
            ok = passes(held.value, b.column(len(cols)).to_numpy())
            yield pa.RecordBatch.from_arrays(b.columns[:-1], names=cols).filter(pa.array(ok if inside else ~ok))

    return docs.withColumn("_k", F.xxhash64(*KEY)).mapInArrow(run, docs.schema)


def _with_lists(docs: DataFrame, lists: DataFrame, how: str = "inner") -> DataFrame:
    """``docs`` joined with per-document lists on the document key."""
    rest = [c for c in lists.columns if c not in KEY]
    return docs.alias("d").join(lists.alias("l"), _same("d", "l"), how).select("d.*", *[F.col(f"l.{c}") for c in rest])


def _cut(docs: DataFrame, length: int) -> DataFrame:
    """(row, spans, kept, longest) from the repeated stretches of each document."""

    def run(batches):
        for rows, data, off in text_blocks(batches):
            spans, kept = [], []
            sure = rows.column(rows.schema.get_field_index("sure")).to_pylist()
            edge = rows.column(rows.schema.get_field_index("edge")).to_pylist()
            for i in range(rows.num_rows):
                text = data[off[i]:off[i + 1]]
                parts = sorted([(x["pos"], x["end"]) for x in sure[i] or ()] + [(x, x + length) for x in edge[i] or ()])
                runs: list[list[int]] = []
                for a, b in parts:
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], b)
                    else:
                        runs.append([a, b])
                spans.append([{"start": a, "end": b} for a, b in runs])
                keep = np.ones(len(text), bool)
                for a, b in runs:
                    keep[a:b] = False
                kept.append(text[keep].tobytes())
            yield pa.RecordBatch.from_arrays(
                [rows.column(rows.schema.get_field_index("row")),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.binary()), rows.column(rows.schema.get_field_index("longest"))], names=["row", "spans", "kept", "longest"])

    return docs.mapInArrow(run, schema_of(docs, ["row"], "spans array<struct<start:long,end:long>>, kept binary, longest int"))


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """Per row of ``docs (doc_id, text, ...)``: row (the input row but for its text), spans
    (removed byte ranges, maximal, in order), kept (the remaining bytes), longest (bytes
    of the longest string at one of its anchors that also starts elsewhere: 0 below
    ``length`` less the gap, at most ``length`` and the gap)."""
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.hash("text").alias("tkey"), "text",
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"))
    if length < 1:
        raise ValueError("length must be at least 1")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.hash("text").alias("tkey"), "text")
    found = _find_anchors(docs, length)  # cheap: done twice rather than written
    seen = materialise(found.groupBy("h").agg(F.count("pos").alias("n")).where("n > 1").select("h"), "suffix-seen")
    near = found.join(seen, "h", "left_semi")
    near = materialise(near, "suffix-near")
    release(seen)
    # a set: the anchors of a row read n times count once, not n times for each of n rows
    lists = near.groupBy(*KEY).agg(F.collect_set(F.struct("pos", "back", "ahead", "h")).alias("a"))
    sifted = materialise(_with_lists(_sift(docs, near, True), lists), "suffix-texts")
    splitters = spark.sparkContext.broadcast(_splitters(sifted, near.count(), length))
    release(near)
    texts = sifted.drop("a")
    longest = materialise(_longest(_suffix_runs(sifted, splitters, length), splitters), "suffix-lcp")
    spots = _contexts(sifted, length)
    with_m = spots.join(longest.where(F.col("m") >= length - scale(length)[2]).groupBy("h", "c").agg(F.max("m").alias("m")), ["h", "c"]) \
        .select(*KEY, "pos", "back", "h", "c", "b", "m", (F.col("pos") + F.col("m")).alias("end"))
    with_m = with_m.repartition(*KEY).dropDuplicates([*KEY, "pos"])  # a row read twice has its anchors twice
    w = Window.partitionBy(*KEY).orderBy("pos")
    reached = F.when(F.lag("pos").over(w) == F.col("pos") - F.col("back"), F.lag("end").over(w))
    edges = with_m.withColumn("ulo", F.greatest(F.lit(1), length - F.col("m"))) \
        .withColumn("uhi", F.least(F.col("back") - 1, F.coalesce(F.col("pos") + length - 1 - reached, F.col("back") - 1)))
    edges = edges.withColumn("kind", F.xxhash64("h", "c", "b", "back", "ulo", "uhi")).drop("c", "b")
    edges = materialise(edges, "suffix-edges")
    release(longest)

    # anchors of one kind have the same strings and ask for the same: one of them stands for all
    kinds = edges.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*KEY, "pos", "back", "ulo", "uhi", "h")).alias("e")) \
        .select("kind", "n", "e.*")
    kinds = materialise(kinds, "suffix-kinds")
    asked = kinds.where("ulo <= uhi").groupBy("h").agg(F.min("ulo").alias("olo"), F.max("uhi").alias("ohi"))
    mates = kinds.join(asked, "h").withColumn("lo", F.greatest("olo", "ulo")) \
        .withColumn("hi", F.least("ohi", F.col("back") - 1)).where("lo <= hi")
    mates = materialise(mates.select(*KEY, "pos", "lo", "hi", "ulo", "uhi", "h", "kind", "n"), "suffix-mates")
    release(kinds)
    lists = mates.groupBy(*KEY).agg(F.collect_set(F.struct("pos", "lo", "hi", "ulo", "uhi", "h", "kind", "n")).alias("a"))
    cores = materialise(_edge_cores(_with_lists(texts, lists), length), "suffix-cores")
    # who does not ask is only a partner: one of those that cover the same bytes will do
    one = cores.where("not own").groupBy("k1", "k2", "whole").agg(F.min(F.struct("kind", "n", "lo", "hi")).alias("p"))
    told = cores.where("own").select("k1", "k2", "kind", "n", "lo", "hi", "own").unionByName(one.select("k1", "k2", "p.*", F.lit(False).alias("own")))
    alike = told.groupBy("k1", "k2").agg(F.sum("n").alias("n"), F.max("own").alias("own")).where("n > 1 and own").select("k1", "k2")
    left = told.join(alike, ["k1", "k2"], "left_semi").select("kind", "lo", "hi").distinct()
    left = materialise(mates.drop("lo", "hi").join(left, "kind"), "suffix-left")
    release(mates)
    release(cores)
    lists = left.groupBy(*KEY).agg(F.collect_set(F.struct("pos", "lo", "hi", "ulo", "uhi", "h", "kind", "n")).alias("a"))
    strings = materialise(_edge_strings(_with_lists(texts, lists), length), "suffix-strings")
    again = strings.groupBy("k").agg(F.sum("n").alias("n"), F.max(F.col("o").isNotNull()).alias("own")) \
        .where("n > 1 and own").select("k")
    found = strings.where("o is not null").join(again, "k", "left_semi").groupBy("kind").agg(F.collect_set("o").alias("o"))
    settled = edges.where("ulo <= uhi").join(found, "kind") \
        .groupBy(*KEY).agg(F.array_distinct(F.flatten(F.collect_list(F.transform("o", lambda o: F.col("pos") - o)))).alias("edge"))
    sure = edges.where(F.col("m") >= length).groupBy(*KEY).agg(F.collect_list(F.struct("pos", "end")).alias("sure"))
    far = edges.groupBy(*KEY).agg(F.max("m").cast("int").alias("longest"))  # every document that loses a byte is here
    cuts = far.alias("f").join(sure.alias("s"), _same("f", "s"), "left").select("f.*", "sure")
    cuts = cuts.alias("s").join(settled.alias("e"), _same("s", "e"), "left")
    cuts = materialise(cuts.select(*[f"s.{c}" for c in KEY], "sure", "edge", "longest"), "suffix-cuts")
    whole = _sift(rows, cuts, False).select(
        "row", F.array().cast("array<struct<start:long,end:long>>").alias("spans"),
        F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("kept"), F.lit(0).alias("longest"))
    return _cut(_with_lists(_sift(rows, cuts, True), cuts, "left"), length).unionByName(whole)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return r.select("row.doc_id", (F.octet_length("kept") + removed).cast("long").alias("n_bytes"), removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                    F.sha2("kept", 256).alias("kept_sha256"), F.coalesce("longest", F.lit(0)).cast("long").alias("longest_repeat"))
