"""Byte-level BPE encoding and decoding with a segment tree per piece.

The text is cut by the tokenizer's pattern; each piece is merged by rank:
a segment tree over the piece's byte positions holds, for every live symbol,
the key ``rank * n + position`` of the pair it starts, so the root is always
the leftmost pair of the lowest rank. A merge makes three point updates
(the merged symbol, its left neighbour, the swallowed symbol), each
O(log n): a piece of n bytes costs O(n log n), however long it is.

Cases: null text is empty; an empty text has no ids and decodes to nothing;
repeated rows give repeated rows; an empty table gives an empty table;
columns of the input other than id and text are not read. Texts are valid
UTF-8 (Spark strings); any bytes survive the round trip.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, schema_of, table

#: Distinct pieces a worker remembers (speed only).
MEMO = 120_000


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece by repeatedly merging the leftmost lowest-ranked pair."""
    n = len(piece)
    if n == 0:
        return []
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    size = 1 << (n - 1).bit_length()
    none = len(ranks) * 4 * size + (1 << 62)
    tree = [none] * (2 * size)
    sym = [piece[i:i + 1] for i in range(n)]
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    get = ranks.get
    for i in range(n - 1):
        r = get(sym[i] + sym[i + 1])
        if r is not None:
            tree[size + i] = r * size + i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b

    def put(i: int, key: int) -> None:
        i += size
        tree[i] = key
        i >>= 1
        while i:
            a, b = tree[2 * i], tree[2 * i + 1]
            key = a if a < b else b
            if tree[i] == key:
                return
            tree[i] = key
            i >>= 1

    while tree[1] != none:
        i = tree[1] % size
        j = nxt[i]
        sym[i] += sym[j]
        sym[j] = b""
        k = nxt[i] = nxt[j]
        put(j, none)
        if k < n:
            prv[k] = i
            r = get(sym[i] + sym[k])
            put(i, none if r is None else r * size + i)
        else:
            put(i, none)
        p = prv[i]
        if p >= 0:
            r = get(sym[p] + sym[i])
            put(p, none if r is None else r * size + p)
    out, i = [], 0
    while i < n:
        out.append(ranks[sym[i]])
        i = nxt[i]
    return out


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


class Merger:
    """``merge_piece`` for many pieces at once: one segment tree per piece,
    the trees of equal size side by side in an array, one merge per tree and
    step."""

    NONE = np.int64(1) << np.int64(62)
    LONGEST, ROWS = 64, 8192  # longer pieces go one by one; trees in an array

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        pairs = {}
        for tok, r in ranks.items():
            for k in range(1, len(tok)):
                a, b = ranks.get(tok[:k]), ranks.get(tok[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = r
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.rank = np.append(np.fromiter(pairs.values(), np.int64, len(pairs))[order], -1)
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int64)

    def pair_keys(self, a: np.ndarray, b: np.ndarray, pos: np.ndarray, size: int) -> np.ndarray:
        """Tree keys of the pairs (a, b) at ``pos``; NONE where they don't merge."""
        want = (a << 32) | b
        at = np.searchsorted(self.keys, want)
        return np.where((self.keys[at] == want) & (a >= 0) & (b >= 0), self.rank[at] * size + pos, self.NONE)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian uint32 bytes."""
        out: list[bytes] = [b""] * len(pieces)
        classes: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(p) > self.LONGEST:
                out[i] = np.array(merge_piece(p, self.ranks), "<u4").tobytes()
            elif p:
                classes.setdefault(max(2, 1 << (len(p) - 1).bit_length()), []).append(i)
        for size, rows in classes.items():
            for k in range(0, len(rows), self.ROWS):
                part = rows[k:k + self.ROWS]
                for i, ids in zip(part, self._trees([pieces[i] for i in part], size)):
                    out[i] = ids
        return out

    def _trees(self, pieces: list[bytes], size: int) -> list[bytes]:
        m = len(pieces)
        n = np.fromiter(map(len, pieces), np.int64, m)
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(m, size)
        pos = np.arange(size)
        # column ``size`` stands for "no symbol": left of the first, right of the last
        sym = np.full((m, size + 1), -1, np.int64)
        sym[:, :size] = np.where(pos < n[:, None], self.byte[raw], -1)
        nxt = np.minimum(np.tile(np.arange(1, size + 2), (m, 1)), n[:, None])
        nxt = np.where(nxt >= n[:, None], size, nxt)
        prv = np.tile(np.append(np.arange(-1, size - 1), size), (m, 1))
        prv[:, 0] = size
        tree = np.full((m, 2 * size), self.NONE)
        tree[:, size:2 * size - 1] = self.pair_keys(sym[:, :size - 1], sym[:, 1:size], pos[:-1], size)
        half = size // 2
        while half:
            tree[:, half:2 * half] = np.minimum(tree[:, 2 * half:4 * half:2], tree[:, 2 * half + 1:4 * half:2])
            half //= 2
        live = np.flatnonzero(tree[:, 1] != self.NONE)
        while len(live):
            key = tree[live, 1]
            i, new = key % size, key // size
            j = nxt[live, i]
            k = nxt[live, j]
            p = prv[live, i]
            sym[live, i] = new
            sym[live, j] = -1
            nxt[live, i] = k
            prv[live, k] = i
            right, left = sym[live, k], sym[live, p]
            self._put(tree, live, j, np.full(len(live), self.NONE), size)
            self._put(tree, live, i, self.pair_keys(new, right, i, size), size)
            has = p < size
            self._put(tree, live[has], p[has], self.pair_keys(left[has], new[has], p[has], size), size)
            live = live[tree[live, 1] != self.NONE]
        sym = sym[:, :size]
        keep = sym >= 0
        flat = sym[keep].astype("<u4").tobytes()
        cut = np.concatenate([[0], np.cumsum(keep.sum(1))]) * 4
        return [flat[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]

    @staticmethod
    def _put(tree: np.ndarray, rows: np.ndarray, i: np.ndarray, key: np.ndarray, size: int) -> None:
        """Point update of leaf ``i`` and its log2(size) ancestors."""
        i = i + size
        tree[rows, i] = key
        i = i >> 1
        while size > 1:
            tree[rows, i] = np.minimum(tree[rows, 2 * i], tree[rows, 2 * i + 1])
            i = i >> 1
            size //= 2


class _Codec(dict):
    """Memo piece -> ids as little-endian uint32 bytes: the first ``MEMO``
    distinct pieces stay; the others of a batch are kept for that batch."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        self.ranks = load_ranks(path)
        self._merger: Merger | None = None
        self.find = regex.compile(pattern).findall
        self.rest: dict[str, bytes] = {}
        self.vocab = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for b, i in self.ranks.items():
            self.vocab[i] = b

    @property
    def merger(self) -> Merger:
        """Made when first needed: a worker that only decodes has none."""
        if self._merger is None:
            self._merger = Merger(self.ranks)
        return self._merger

    def __missing__(self, piece: str) -> bytes:
        return self.rest[piece]

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = list(map(self.find, texts))
        new = [p for p in set().union(*cut) if p not in self]
        ids = dict(zip(new, self.merger.merge([p.encode("utf-8") for p in new])))
        room = MEMO - len(self)
        if room > 0:
            self.update((p, x) for p, x in list(ids.items())[:room] if len(p) <= 64)
        self.rest = ids
        out = [b"".join(map(self.__getitem__, c)) for c in cut]
        self.rest = {}
        return out

    def decode(self, packed: list[bytes]) -> list[bytes]:
        get = self.vocab.__getitem__
        return [b"".join(map(get, np.frombuffer(ids, "<u4").tolist())) for ids in packed]


_codecs: dict[tuple, _Codec] = {}


def codec(path: str, pattern: str) -> _Codec:
    key = (path, pattern)
    if key not in _codecs:
        _codecs[key] = _Codec(path, pattern)
    return _codecs[key]


def _row_by_row(df: DataFrame, src: str, kind: str, name: str, path: str, pattern: str) -> DataFrame:
    keep = [c for c in df.columns if c.lower() != name.lower()]
    if src.lower() == name.lower():
        raise ValueError("the result needs a column of its own")
    plain = df.select(*quoted(keep)).toDF(*[f"c{i}" for i in range(len(keep))])  # names may hold dots

    def run(batches):
        fn = getattr(codec(path, pattern), kind)
        zero = "" if kind == "encode" else b""
        for b in batches:
            col = b.column(keep.index(src))
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                out = fn([zero if x is None else x for x in col.slice(i, 256).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=[*part.schema.names, "out"])

    return plain.mapInArrow(run, schema_of(plain, plain.columns, "out binary")).toDF(*keep, name)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with column ``ids``: token ids as little-endian uint32 bytes."""
    return _row_by_row(df, text, "encode", ids, path, pattern)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with column ``out``: the bytes that ``ids`` stand for."""
    return _row_by_row(df, ids, "decode", out, path, pattern)


def n_ids(ids: Column | str) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: number of ids, SHA-256 of the ids, SHA-256 of the
    decoded bytes. One worker encodes and decodes, so there is one set of tables."""
    docs = docs.select("doc_id", "text")

    def run(batches):
        both = codec(path, pattern)
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                ids = both.encode(["" if x is None else x for x in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(both.decode(ids), pa.binary())],
                                                 names=["doc_id", "ids", "decoded"])

    return docs.mapInArrow(run, schema_of(docs, ["doc_id"], "ids binary, decoded binary")).select(
        "doc_id", n_ids("ids").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as P
    return digests(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
