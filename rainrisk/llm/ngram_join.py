"""N-gram Jaccard join: rare-first prefix filtering with length, positional
and suffix filters, candidates joined on prefix n-grams, verified once.

Two documents link when ``den * |A & B| >= num * |A | B|`` over their sets of
``n``-word shingles (64-bit hashes). Steps, all on whole data:

1. One pass over the texts: size and signature of every shingle set, and a
   fixed-size count sketch of all shingles (2**SKETCH_BITS buckets, summed per
   slice; the only thing collected, 2**SKETCH_BITS bytes whatever the data).
   Documents with equal sets are one class from here on.
2. Second pass: the prefix of every class, its shingles in order of rising
   bucket count (rare first, hash breaks ties). Any fixed order is exact, the
   sketch only makes the lists short. A shingle whose bucket counts one
   document has no partner and is not sent.
3. A list (the classes that share a prefix shingle) may hold a third of all
   classes, so its pairs are never all made. First each member is paired with
   one hub of its list, the member in whose order the shingle comes first,
   and components are taken of the links found. Then members of different
   components are paired, never two of the largest component of a list, and
   not if their distances to a common hub differ by more than a link allows
   (1 - Jaccard is a metric). Whatever is left unpaired is connected already
   or cannot link, so every link between classes is found or implied by
   links found; ``component_id`` is exact.
4. A pair passes the length and positional filters when it is made and the
   suffix filter (a lower bound of the Hamming distance from counts per hash
   range, PARTS ranges) before any set is fetched; then the sets meet once.

Cases: null or empty texts and texts without words have an empty set and link
with nothing, not even with each other; texts shorter than ``n`` words have
one shingle, the whole sequence; rows that repeat a doc_id are separate rows,
each with the component of its own text's shingles; a null
doc_id links nothing and has no component; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, filter_bits, materialise, mix, passes, release, shingles, signed, table, text_blocks, words

U64 = np.uint64
SKETCH_BITS, SLICES = 20, 64
PARTS = 32


def _sets(batch, data, off, n: int):
    """Per document of a block: sorted distinct shingle hashes."""
    h, doc, _, _ = words(data, off)
    s, o = shingles(h, doc, len(off) - 1, n)
    return [np.unique(s[o[i]:o[i + 1]]) for i in range(len(off) - 1)]


def _signature(s: np.ndarray) -> int:
    """Order-free 64-bit signature of a set."""
    with np.errstate(over="ignore"):
        return int(mix(np.array([(mix(s).sum() ^ mix(s * U64(3) + U64(1)).sum() * U64(5)) + U64(len(s))], U64))[0].view(np.int64))


def _bucket(s: np.ndarray) -> np.ndarray:
    return (s >> U64(64 - SKETCH_BITS)).astype(np.int64)


def _parts(s: np.ndarray) -> bytes:
    return np.bincount((s >> U64(59)).astype(np.int64), minlength=PARTS).astype("<u4").tobytes()


def _measure(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, n_shingles, sig, parts) and, per task, the slices of its
    sketch; parts: counts per hash range, for the suffix filter."""

    def run(batches):
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for rows, data, off in text_blocks(batches):
            sets = _sets(rows, data, off, n)
            if sets:
                counts += np.bincount(_bucket(np.concatenate(sets)), minlength=1 << SKETCH_BITS)
            m = len(sets)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_signature(s) if len(s) else 0 for s in sets], pa.int64()),
                 pa.array([_parts(s) for s in sets], pa.binary()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names=names)
        if counts.any():
            packed = [x.astype("<u4").tobytes() for x in np.split(counts, SLICES)]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(SLICES, pa.int64()), pa.nulls(SLICES, pa.int64()), pa.nulls(SLICES, pa.int64()),
                 pa.nulls(SLICES, pa.binary()), pa.array(range(SLICES), pa.int32()), pa.array(packed)], names=names)

    names = ["doc_id", "n_shingles", "sig", "parts", "slice", "counts"]
    return docs.mapInArrow(run, "doc_id long, n_shingles long, sig long, parts binary, slice int, counts binary")


def _sketch(parts: DataFrame) -> np.ndarray:
    """Quantised counts of all buckets: 0 for at most one document, then four
    levels per doubling."""

    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << SKETCH_BITS) // SLICES, np.int64)
        key = None
        for t in rows:
            key = t.column("slice")[0].as_py()
            for x in t.column("counts"):
                total += np.frombuffer(x.as_py(), "<u4")
        level = np.where(total <= 1, 0, 1 + np.floor(4 * np.log2(np.maximum(total, 1)))).astype(np.uint8)
        yield pa.RecordBatch.from_pydict({"slice": pa.array([key], pa.int32()), "levels": [level.tobytes()]})

    got = parts.where("slice is not null").select("slice", "counts").groupBy("slice") \
        .applyInArrow(add, "slice int, levels binary").collect()  # SLICES rows, 2**SKETCH_BITS bytes in all
    out = np.zeros((SLICES, (1 << SKETCH_BITS) // SLICES), np.uint8)
    for r in got:
        out[r["slice"]] = np.frombuffer(r["levels"], np.uint8)
    return out.reshape(-1)


def _prefixes(docs: DataFrame, n: int, num: int, den: int, levels) -> DataFrame:
    """(tok, sig, size, pos) of every class's prefix."""

    def run(batches):
        lv = levels.value
        for rows, data, off in text_blocks(batches):
            tok, sig, size, pos = [], [], [], []
            seen = set()
            for s in _sets(rows, data, off, n):
                m = len(s)
                if not m:
                    continue
                g = _signature(s)
                if g in seen:
                    continue
                seen.add(g)
                plen = m - (num * m + den - 1) // den + 1
                level = lv[_bucket(s)]
                order = np.lexsort((s, level))[:plen]
                use = np.flatnonzero(level[order] > 0)
                tok.append(s[order][use])
                pos.append(use)
                sig.append(np.full(len(use), g, np.int64))
                size.append(np.full(len(use), m, np.int64))
            if tok:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(np.concatenate(tok))), pa.array(np.concatenate(sig)),
                     pa.array(np.concatenate(size).astype(np.int32)), pa.array(np.concatenate(pos).astype(np.int32))],
                    names=["tok", "sig", "size", "pos"])

    return docs.select("text").mapInArrow(run, "tok long, sig long, size int, pos int")


def _able(num: int, den: int) -> str:
    """Length and positional filter of a pair that shares a prefix shingle at
    positions pa, pb: sizes compatible, and enough may follow to reach the
    overlap that the threshold needs. It is asked as if the shingle were the
    first that the two share, so a pair that links passes at its first one,
    where nothing common precedes, and need not pass at the later ones."""
    return (f"{den} * least(na, nb) >= {num} * greatest(na, nb) and "
            f"{num + den} * least(na - pa, nb - pb) >= {num} * (na + nb)")


def _suffix_filter(pairs: DataFrame, reps: DataFrame, num: int, den: int) -> DataFrame:
    """``pairs (a, b)`` with ``most``, an upper bound of their similarity from
    the counts per hash range, and ``near``, whether it leaves room for a link."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), "<u4").reshape(b.num_rows, PARTS).astype(np.int64)
                    for c in ("xp", "yp"))
            total = x.sum(1) + y.sum(1)
            overlap = (total - np.abs(x - y).sum(1)) // 2  # at most: the Hamming distance is at least the sum of differences
            yield pa.RecordBatch.from_arrays(
                [b.column("a"), b.column("b"), pa.array(overlap / np.maximum(total - overlap, 1)),
                 pa.array((num + den) * overlap >= num * total)], names=["a", "b", "most", "near"])

    xs = reps.select(F.col("sig").alias("a"), F.col("parts").alias("xp"))
    ys = reps.select(F.col("sig").alias("b"), F.col("parts").alias("yp"))
    return pairs.join(xs, "a").join(ys, "b").select("a", "b", "xp", "yp").mapInArrow(run, "a long, b long, most double, near boolean")


def _verify(docs: DataFrame, reps: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    """(a, b, both, total) of ``pairs (a, b)``, written: sizes of intersection
    and union. The sets of the classes named come from one more pass over the
    texts (a filter of bounded size lets the representatives through) and
    meet once per pair."""
    wanted = pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct()
    wanted = reps.join(wanted, "sig", "left_semi").select("rep")
    held = docs.sparkSession.sparkContext.broadcast(filter_bits(wanted))

    def fetch(batches):
        on, seen = held.value, set()
        for rows, data, off in text_blocks(batches):
            ids = rows.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            use = np.flatnonzero(passes(on, ids))
            if not len(use):
                continue
            cut = off[use + 1] - off[use]
            part = np.concatenate([data[off[i]:off[i + 1]] for i in use])
            sets = _sets(None, part, np.concatenate([[0], np.cumsum(cut)]), n)
            sig = [_signature(s) if len(s) else 0 for s in sets]
            use = [i for i, g in enumerate(sig) if len(sets[i]) and not (g in seen or seen.add(g))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([sig[i] for i in use], pa.int64()),
                 pa.array([sets[i].astype("<u8").tobytes() for i in use], pa.binary())], names=["sig", "items"])

    def meet(batches):
        for b in batches:
            both, total = [], []
            for x, y in zip(b.column("xi").to_pylist(), b.column("yi").to_pylist()):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                at = np.searchsorted(y, x)
                both.append(int((y[np.minimum(at, len(y) - 1)] == x).sum()))
                total.append(len(x) + len(y) - both[-1])
            yield pa.RecordBatch.from_arrays(
                [b.column("a"), b.column("b"), pa.array(both, pa.int64()), pa.array(total, pa.int64())],
                names=["a", "b", "both", "total"])

    sets = materialise(docs.select("doc_id", "text").mapInArrow(fetch, "sig long, items binary"), "jaccard-sets")
    xi = sets.select(F.col("sig").alias("a"), F.col("items").alias("xi"))
    yi = sets.select(F.col("sig").alias("b"), F.col("items").alias("yi"))
    met = pairs.select("a", "b").join(yi, "b").join(xi, "a").select("a", "b", "xi", "yi")
    out = materialise(met.mapInArrow(meet, "a long, b long, both long, total long"), "jaccard-met")
    release(sets)
    return out


def jaccard_components(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """Per row of ``docs (doc_id, text)``: doc_id, n_shingles, component_id,
    the smallest doc_id reachable by links at similarity ``num / den``."""
    spark: SparkSession = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = materialise(_measure(docs, n), "jaccard-measure")
    rows = parts.where("slice is null").select("doc_id", "n_shingles", "sig", "parts")
    levels = spark.sparkContext.broadcast(_sketch(parts))  # 2**SKETCH_BITS bytes

    posts = materialise(_prefixes(docs, n, num, den, levels), "jaccard-prefix")
    shared = posts.groupBy("tok").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("tok")
    lists = posts.join(shared, "tok", "left_semi").groupBy("tok", "sig").agg(F.first("size").alias("size"), F.first("pos").alias("pos"))
    lists = materialise(lists, "jaccard-lists")
    release(posts)
    reps = materialise(rows.where("n_shingles > 0 and doc_id is not null").groupBy("sig").agg(
        F.min("doc_id").alias("rep"), F.first("parts").alias("parts")), "jaccard-classes")

    able = _able(num, den)
    link = F.expr(f"{den} * both >= {num} * total")
    # every member with one hub of its list
    hubs = lists.groupBy("tok").agg(F.min(F.struct("pos", "size", "sig")).alias("h")).select(
        "tok", F.col("h.sig").alias("hs"), F.col("h.size").alias("na"), F.col("h.pos").alias("pa"))
    pairs = lists.join(hubs, "tok").where("sig <> hs").select(
        "hs", "sig", "na", "pa", F.col("size").alias("nb"), F.col("pos").alias("pb")).where(able)
    pairs = materialise(pairs.select(F.col("hs").alias("a"), F.col("sig").alias("b")).distinct(), "jaccard-hub")
    sifted = materialise(_suffix_filter(pairs, reps, num, den), "jaccard-sifted")
    met = _verify(docs, reps, sifted.where("near"), n)
    links = met.where(link).select("a", "b")
    label = components(links, "jaccard-cc1")

    # each class's distance to its nearest hub, between lo and hi
    spread = met.select(F.col("a").alias("hub"), F.col("b").alias("s"), (1 - F.col("both") / F.col("total")).alias("lo"),
                        (1 - F.col("both") / F.col("total")).alias("hi"))
    spread = spread.unionByName(sifted.where("not near").select(
        F.col("a").alias("hub"), F.col("b").alias("s"), (1 - F.col("most")).alias("lo"), F.lit(1.0).alias("hi")))
    spread = spread.unionByName(pairs.select(F.col("a").alias("hub"), F.col("a").alias("s"), F.lit(0.0).alias("lo"), F.lit(0.0).alias("hi")))
    spread = spread.groupBy("s").agg(F.min(F.struct("lo", "hi", "hub")).alias("d")).select("s", "d.*")

    # what is left: pairs of members in different components so far
    tagged = lists.join(label, lists.sig == label.v, "left").select(
        "tok", "sig", "size", "pos", F.coalesce("c", "sig").alias("c"))
    tagged = materialise(tagged.join(spread, F.col("sig") == F.col("s"), "left").drop("s"), "jaccard-tagged")
    held = tagged.groupBy("tok", "c").agg(F.count(F.lit(1)).alias("n")).groupBy("tok").agg(
        F.max(F.struct("n", "c")).alias("big"), F.count(F.lit(1)).alias("cs")).where("cs > 1") \
        .select("tok", F.col("big.c").alias("bc"))
    open_lists = tagged.join(held, "tok")
    small = open_lists.where("c <> bc").select(
        "tok", F.col("sig").alias("ls"), F.col("size").alias("na"), F.col("pos").alias("pa"),
        F.col("c").alias("lc"), F.col("lo").alias("llo"), F.col("hi").alias("lhi"), F.col("hub").alias("lhub"))
    other = open_lists.select("tok", "sig", F.col("size").alias("nb"), F.col("pos").alias("pb"), "c", "bc", "lo", "hi", "hub")
    far = f"lhub <=> hub and lhub is not null and greatest(llo - hi, lo - lhi) > {1 - num / den} + 1e-9"
    pairs2 = small.join(other, (small.tok == other.tok) & F.expr(
        f"lc <> c and (c = bc or ls < sig) and {able} and not ({far})"))
    pairs2 = pairs2.select(F.least("ls", "sig").alias("a"), F.greatest("ls", "sig").alias("b")).distinct()
    done = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    near = materialise(_suffix_filter(pairs2.join(done, ["a", "b"], "left_anti"), reps, num, den).where("near"), "jaccard-near")
    links = links.unionByName(_verify(docs, reps, near, n).where(link).select("a", "b"))
    label = components(links, "jaccard-cc")

    of_class = rows.where("n_shingles > 0 and doc_id is not null").select("sig", "doc_id").join(
        label.select(F.col("v").alias("sig"), "c"), "sig", "left").withColumn("c", F.coalesce("c", "sig"))
    return _by_document(rows, of_class)


def _by_document(rows: DataFrame, of_class: DataFrame) -> DataFrame:
    least = of_class.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    classes = of_class.select("sig", "c").distinct().join(least, "c").select(F.col("sig").alias("s"), "component_id")
    out = rows.join(classes, F.when(F.col("n_shingles") > 0, F.col("sig")) == F.col("s"), "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=3, num=9, den=10)


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS sh FROM w),
x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
-- documents with equal sets are one node, so that copies are not paired
k AS (SELECT doc_id, len(sh) AS n, sha256(array_to_string(list_sort(sh), chr(1))) AS k FROM s WHERE len(sh) > 0),
r AS (SELECT k, min(doc_id) AS rep FROM k GROUP BY k),
y AS (SELECT x.* FROM x JOIN r ON x.doc_id = r.rep),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM y a JOIN y b ON a.g = b.g AND a.doc_id < b.doc_id
        AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(v, c) AS (SELECT rep, rep FROM r UNION SELECT e.b, reach.c FROM reach JOIN e ON reach.v = e.a),
c AS (SELECT v, min(c) AS c FROM reach GROUP BY v)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, coalesce(c.c, s.doc_id) AS component_id
FROM s LEFT JOIN k ON s.doc_id = k.doc_id LEFT JOIN r ON k.k = r.k LEFT JOIN c ON r.rep = c.v
"""
