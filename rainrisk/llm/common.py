"""Helpers shared by the operators of this subpackage: scratch tables in the
shared folder, text batches as flat byte blocks, vectorised hashing, and
connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainrisk.session import scratch_path

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd multiplier of the rolling hash (fixed value)
BLOCK_BYTES = 1 << 20      # bytes of text a numpy step holds at once
BATCH_BYTES = 4 << 20      # of an Arrow batch: Spark's 64 MB are held several times on either side of a worker
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, once per context, unless their
    PYTHONPATH already names its folder (then it is installed or mounted), and
    keep this session's Arrow batches to BATCH_BYTES."""
    as_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if as_bytes(spark.conf.get(BATCH_CONF)) > BATCH_BYTES:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    root = Path(__file__).resolve().parents[2]
    sc = spark.sparkContext
    if getattr(sc, "_rainrisk_sent", False) or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    to = Path(tempfile.mkdtemp(prefix="rainrisk-")) / "rainrisk.zip"  # driver's own; Spark serves it to the workers
    with zipfile.ZipFile(to, "w") as z:
        for f in sorted((root / "rainrisk").rglob("*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(str(to))
    sc._rainrisk_sent = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared folder of ``spark.checkpoint.dir`` and
    read it back: cuts the lineage, survives lost executors, computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def release(df: DataFrame) -> None:
    """Delete the scratch table behind a ``materialise`` result (only for
    tables that nothing lazy still reads)."""
    path = getattr(df, "_scratch", None)
    if path:
        jvm = df.sparkSession.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def quoted(cols: list[str]) -> list[str]:
    """Names for ``select`` that may hold dots or back-ticks."""
    return ["`" + c.replace("`", "``") + "`" for c in cols]


def schema_of(df: DataFrame, cols: list[str], extra: str) -> T.StructType:
    """Schema of ``cols`` of ``df`` followed by the DDL columns ``extra``."""
    fields = [df.schema[c] for c in cols] + list(T.StructType.fromDDL(extra).fields)
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])


# --------------------------------------------------------------- text blocks

def _bytes_column(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat bytes and n+1 offsets of a string/binary column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    n, wide = len(col), pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[off[0]:off[-1]], off - off[0]


def text_blocks(batches, text: str = "text", block_bytes: int = BLOCK_BYTES) \
        -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut Arrow batches into runs of whole documents of about
    ``block_bytes`` (one longer document stands alone): (rows, bytes, offsets)."""
    for batch in batches:
        flat, off = _bytes_column(batch.column(batch.schema.get_field_index(text)))
        i, n = 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + block_bytes, "right")) - 1)
            j = min(j, n)
            yield batch.slice(i, j - i), flat[off[i]:off[j]], off[i:j + 1] - off[i]
            i = j


# ------------------------------------------------------------------- hashing

def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser, element-wise on uint64."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(BASE))
_pow = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i (mod 2**64) for i < n."""
    if len(_pow[0]) < n:
        m = max(n, 1 << 16)
        for k, b in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            p = np.full(m, b, U64)
            p[0] = 1
            _pow[k] = np.multiply.accumulate(p)
    p, q = _pow[0][:n], _pow[1][:n]
    if len(_pow[0]) > 1 << 24:  # do not keep the tables of one huge text
        _pow[:] = [np.ones(1, U64), np.ones(1, U64)]
    return p, q


def prefix_hash(data: np.ndarray, lut: np.ndarray = _BYTE) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of byte * BASE**i, and BASE**-i: any substring's
    position-free hash is ``(S[e] - S[s]) * inv[s]``."""
    p, inv = powers(len(data) + 1)
    s = np.empty(len(data) + 1, U64)
    s[0] = 0
    np.cumsum(lut[data] * p[:-1], out=s[1:])
    return s, inv


_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_WORD = np.ones(256, bool)
_WORD[[32, 9, 10, 11, 12, 13]] = False


def words(data: np.ndarray, off: np.ndarray, inside: np.ndarray = _WORD):
    """Words ``[^\\x20\\x09-\\x0D]+`` (or runs of the bytes marked in ``inside``)
    of a block of documents, A-Z lower-cased: (hash, document index, start,
    end) of each, in order."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return np.zeros(0, U64), z, z, z
    w = inside[data]
    first = np.zeros(n + 1, bool)
    first[off] = True
    first = first[:n]
    st = w.copy()
    st[1:] &= ~w[:-1] | first[1:]
    en = np.empty(n, bool)
    en[-1] = w[-1]
    en[:-1] = w[:-1] & (~w[1:] | first[1:])
    s, e = np.flatnonzero(st), np.flatnonzero(en) + 1
    cum, inv = prefix_hash(data, _BYTE_LOWER)
    h = mix(((cum[e] - cum[s]) * inv[s]) + (e - s).astype(U64))
    doc = np.repeat(np.arange(len(off) - 1), np.diff(np.searchsorted(s, off)))
    return h, doc, s, e


def shingles(h: np.ndarray, doc: np.ndarray, ndocs: int, n: int):
    """Hashes of all ``n``-word shingles (with fewer words: the whole
    sequence as one), ordered by document, and ndocs+1 offsets."""
    cnt = np.bincount(doc, minlength=ndocs)
    start = np.zeros(ndocs + 1, np.int64)
    np.cumsum(cnt, out=start[1:])
    acc = np.zeros(len(h), U64)
    for k in range(n):  # sum of odd multiples of the words that exist
        m = len(h) - k
        if m <= 0:
            break
        mult = U64((BASE * (2 * k + 3) | 1) & 0xFFFFFFFFFFFFFFFF)
        ok = doc[k:] == doc[:m]
        acc[:m] += np.where(ok, mix(h[k:] + U64(k + 1)) * mult, U64(0))
    full = np.maximum(cnt - n + 1, (cnt > 0).astype(np.int64))
    keep = (np.arange(len(h)) - start[doc]) < full[doc]
    out = mix(acc[keep] + np.minimum(cnt, n)[doc[keep]].astype(U64))
    o = np.zeros(ndocs + 1, np.int64)
    np.cumsum(full, out=o[1:])
    return out, o


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


# ------------------------------------------------------------ bounded filter

FILTER_BITS, FILTER_SLICES = 27, 64  # 16 MB at most


def filter_bits(ids: DataFrame) -> np.ndarray:
    """A Bloom filter (two probes) of ``ids``: 16 bits a value up to
    2**FILTER_BITS bits, beyond which it only lets more through."""
    n = ids.count()
    bits = min(FILTER_BITS, max(16, int(n * 16).bit_length()))
    size = (1 << bits) // FILTER_SLICES

    def run(batches):
        on = np.zeros(1 << bits, bool)
        for b in batches:
            for at in _probes(b.column(0).to_numpy(), bits):
                on[at] = True
        if on.any():
            for k, x in enumerate(np.split(on, FILTER_SLICES)):
                yield pa.RecordBatch.from_pydict({"slice": pa.array([k], pa.int32()), "bits": [np.packbits(x).tobytes()]})

    def union(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, key = np.zeros(size // 8, np.uint8), None
        for t in rows:
            key = t.column("slice")[0].as_py()
            for x in t.column("bits"):
                total |= np.frombuffer(x.as_py(), np.uint8)
        yield pa.RecordBatch.from_pydict({"slice": pa.array([key], pa.int32()), "bits": [total.tobytes()]})

    out = np.zeros((FILTER_SLICES, size // 8), np.uint8)
    for r in ids.mapInArrow(run, "slice int, bits binary").groupBy("slice").applyInArrow(union, "slice int, bits binary").collect():
        out[r["slice"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def _probes(ids: np.ndarray, bits: int):
    x = mix(ids.view(U64) + U64(17))
    return (x >> U64(64 - bits)).astype(np.int64), (mix(x) >> U64(64 - bits)).astype(np.int64)


def passes(on: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which ``ids`` the filter lets through."""
    bits, ok = (len(on) * 8).bit_length() - 1, np.ones(len(ids), bool)
    for at in _probes(ids, bits):
        ok &= (on[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return ok


# -------------------------------------------------------------- components

def components(edges: DataFrame, label: str = "cc") -> DataFrame:
    """Connected components of ``edges (a long, b long)``: (v, c), c the
    smallest vertex reachable. Min-label propagation with pointer jumping;
    every round is a written table, aggregates are partial before the
    shuffle (a hub's links never meet unsummed), nothing is collected but a
    count of changed labels."""
    und = materialise(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                      .where("a <> b").distinct(), f"{label}-edges")
    lab = materialise(und.groupBy(F.col("a").alias("v")).agg(
        F.least(F.min("b"), F.first("a")).alias("c")), f"{label}-0")
    rounds = 0
    while True:
        rounds += 1
        near = und.join(lab, und.b == lab.v).groupBy(F.col("a").alias("v2")).agg(F.min("c").alias("m"))
        step = lab.join(near, lab.v == near.v2).select("v", F.col("c").alias("old"), F.least("c", "m").alias("c"))
        ptr = lab.select(F.col("v").alias("pv"), F.col("c").alias("pc"))
        new = step.join(ptr, step.c == ptr.pv, "left").select(
            "v", "old", F.least("c", F.coalesce("pc", "c")).alias("c"))
        new = materialise(new, f"{label}-{rounds}")
        changed = new.where("c <> old").limit(1).count()
        release(lab)
        lab = new.select("v", "c")
        lab._scratch = new._scratch
        if not changed:
            release(und)
            return lab
