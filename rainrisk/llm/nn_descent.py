"""Embedding near-dedup by NN-descent.

Vectors are compared only inside their label. Exact copies are folded first
(one node with a weight). A neighbour graph of ``K`` neighbours a node is
started from groups of about ``GROUP`` nodes that share the signs of a few
random projections, and refined: each node introduces its neighbours and the
nodes that list it to each other (at least one of a pair must be new), and
every node keeps its best ``K``. Lists of nodes that very many others list
are cut into salted groups, so no group is unbounded. Rounds end when few lists change.

Edges of at least the threshold are kept; cosines are computed in double
precision. A node whose whole list is above the threshold is saturated: its
list may be too short, and what it misses may lie in other components. It is
therefore compared with all nodes of its label and length (``against_all``),
which counts its links exactly, those of other nodes to it, and finds one
link per pair of components it joins; components are taken after that. The
saturated nodes of a component travel together, around a pivot: a node whose
angle to the pivot is more than the group's radius and the threshold's angle
links with none of them and is compared with the pivot only. Groups are
broadcast in chunks of ``CHUNK_BYTES``, nothing is shuffled but counts.

The audit compares at least ``AUDIT`` nodes chosen by hash with all rows, more
until they have ``AUDIT_LINKS`` true links or all nodes are taken, and holds
these against the final counts; below ``RECALL`` the descent goes on with other
random groups, and after ``ATTEMPTS`` of them all nodes of the failing labels are
compared with each other.

Cases: vectors that are null, empty, zero, or hold null or non-finite
components, and those with a null label, link with nothing and are their own
component; a null vec_id has component null and no links; vectors of unequal
length are not compared; rows that repeat a vec_id count once (the first by
label and vector); an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, materialise, release, table

K, GROUP, SALT_ROWS, BLOCK = 10, 64, 32, 1024
CHUNK_BYTES = 32 << 20  # vectors of a broadcast
ROUNDS, SETTLED = 8, 0.002
AUDIT, AUDIT_LINKS, RECALL, ATTEMPTS = 1000, 200, 0.97, 3
EDGE = "a long, b long, s double, fresh boolean"


def _unit(blobs: list[bytes], dtype: str) -> np.ndarray:
    x = np.frombuffer(b"".join(blobs), dtype).astype(np.float64).reshape(len(blobs), -1)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def fold(emb: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """(rows, nodes, dtype): rows (vec_id, node) of all usable vectors; nodes
    (id, label, dim, v, weight), one per distinct vector of a label."""
    kind = emb.schema["embedding"].dataType.elementType.simpleString()
    dtype = "<f4" if kind == "float" else "<f8"
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    one = emb.where("vec_id is not null and label is not null and embedding is not null") \
        .where((F.size("embedding") > 0) & finite & F.exists(x, lambda e: e != 0)) \
        .groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("r")).select("vec_id", "r.label", "r.embedding")
    groups = one.groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"))

    def pack(batches):
        for b in batches:
            lists = b.column(2)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(dtype)
            cut = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
            v = pa.array([flat[s:e].tobytes() for s, e in zip(cut, cut[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.diff(cut).astype(np.int32)), v, b.column(3)],
                                             names=["id", "label", "dim", "v", "weight"])

    nodes = materialise(groups.select("id", F.col("label").cast("string"), "embedding", "weight").mapInArrow(
        pack, "id long, label string, dim int, v binary, weight long"), "nn-nodes")
    rows = one.join(groups.select(F.col("label").alias("gl"), F.col("embedding").alias("ge"), F.col("id").alias("node")),
                    (F.col("label") == F.col("gl")) & (F.col("embedding") == F.col("ge"))).select("vec_id", "node")
    return rows, nodes, dtype


def _top(ids: np.ndarray, s: np.ndarray, k: int, least: np.ndarray | None = None):
    """Per row its best ``k`` columns (above ``least`` if given): arrays a, b, s."""
    s = s.copy()
    np.fill_diagonal(s, -2)
    k = min(k, len(ids) - 1)
    if k < 1:
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    col = np.argpartition(-s, k - 1, axis=1)[:, :k]
    val = np.take_along_axis(s, col, 1)
    ok = val > (-1.5 if least is None else np.maximum(least, -1.5)[:, None])
    row = np.broadcast_to(np.arange(len(ids))[:, None], col.shape)
    return ids[row[ok]], ids[col[ok]], val[ok]


def _edges(a, b, s) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s), pa.array(np.ones(len(a), bool))],
                                      names=["a", "b", "s", "fresh"])


def start(nodes: DataFrame, dtype: str, bits: int, seed: int) -> DataFrame:
    """Neighbours inside groups of equal projection signs, of about GROUP nodes."""

    def sign(batches):
        for b in batches:
            dims = b.column(2).to_pylist()
            code = np.zeros(b.num_rows, np.int64)
            if bits:
                blobs = b.column(3).to_pylist()
                for d in set(dims):
                    who = [i for i, x in enumerate(dims) if x == d]
                    planes = np.random.default_rng([seed, d]).normal(size=(d, bits))
                    on = _unit([blobs[i] for i in who], dtype) @ planes > 0
                    code[who] = on @ (1 << np.arange(bits))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), pa.array(code)],
                                             names=["id", "label", "dim", "v", "code"])

    def join(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(rows))  # about GROUP nodes
        x = _unit(t["v"].to_pylist(), dtype)
        yield _edges(*_top(t["id"].to_numpy(), x @ x.T, K))

    coded = nodes.select("id", "label", "dim", "v").mapInArrow(sign, "id long, label string, dim int, v binary, code long")
    size = coded.groupBy("label", "dim", "code").agg(F.count(F.lit(1)).alias("n"))
    dealt = coded.join(size, ["label", "dim", "code"]).withColumn(
        "part", F.pmod(F.xxhash64("id", F.lit(seed)), F.ceil(F.col("n") / GROUP)))
    return dealt.groupBy("label", "dim", "code", "part").applyInArrow(join, EDGE)


def _best(edges: DataFrame) -> DataFrame:
    """The ``K`` best distinct neighbours of every node; fresh if in no list before."""
    one = edges.groupBy("a", "b").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"))
    w = Window.partitionBy("a").orderBy(F.desc("s"), "b")
    return one.withColumn("r", F.row_number().over(w)).where(F.col("r") <= K).drop("r")


def introduce(graph: DataFrame, nodes: DataFrame, dtype: str) -> DataFrame:
    """Candidates from every node's neighbours and reverse neighbours."""
    kth = graph.groupBy(F.col("a").alias("k")).agg(F.when(F.count(F.lit(1)) >= K, F.min("s")).otherwise(-1.0).alias("kth"))
    carry = nodes.select("id", "v").join(kth, F.col("id") == F.col("k"), "left").select(
        "id", "v", F.coalesce("kth", F.lit(-1.0)).alias("kth"))
    both = graph.select(F.col("a").alias("m"), F.col("b").alias("x"), "fresh").unionByName(
        graph.select(F.col("b").alias("m"), F.col("a").alias("x"), "fresh"))
    both = both.groupBy("m", "x").agg(F.max("fresh").alias("fresh"))
    deg = both.groupBy("m").agg(F.count(F.lit(1)).alias("deg"), F.max("fresh").alias("any")).where("any")
    meet = both.join(deg, "m").withColumn("salt", F.pmod(F.xxhash64("x", "m"), F.ceil(F.col("deg") / SALT_ROWS)))
    lists = meet.join(carry, F.col("x") == F.col("id")).groupBy("m", "salt").agg(
        F.collect_list(F.struct("id", "fresh", "kth", "v")).alias("l"))

    def run(batches):
        for batch in batches:
            a, b, s = [], [], []
            for row in batch.column(0):
                l = row.values
                if len(l) < 2:
                    continue
                ids, new, kth = (l.field(k).to_numpy(zero_copy_only=False) for k in range(3))
                x = _unit(l.field(3).to_pylist(), dtype)
                sim = x @ x.T
                sim[~(new[:, None] | new[None, :])] = -2
                for out, got in zip((a, b, s), _top(ids, sim, K, kth)):
                    out.append(got)
            if a:
                yield _edges(np.concatenate(a), np.concatenate(b), np.concatenate(s))

    return lists.select("l").mapInArrow(run, EDGE)


def _groups(t: pa.Table, dtype: str) -> dict:
    """Of rows (id, c, label, dim, v, weight): per (label, dim) the pivots and
    angles of its groups c, and each group's (ids, weights, vectors)."""
    out: dict[tuple, tuple] = {}
    rows: dict[tuple, list[int]] = {}
    for i, key in enumerate(zip(t["label"].to_pylist(), t["dim"].to_pylist(), t["c"].to_pylist())):
        rows.setdefault(key, []).append(i)
    ids, weight, blobs = t["id"].to_numpy(), t["weight"].to_numpy(), t["v"].to_pylist()
    for (label, dim, c), at in rows.items():
        x = _unit([blobs[i] for i in at], dtype)
        radius = np.arccos(np.clip(x @ x[0], -1, 1)).max()
        pivots, radii, members = out.setdefault((label, dim), ([], [], []))
        pivots.append(x[0])
        radii.append(radius)
        members.append((c, ids[at], weight[at], x))
    return {k: (np.array(p), np.array(r), m) for k, (p, r, m) in out.items()}


def _packed(counts: dict, joined: dict) -> pa.RecordBatch:
    n = len(counts)
    return pa.RecordBatch.from_arrays(
        [pa.array([*counts, *[a for a, _ in joined.values()]], pa.int64()),
         pa.array([*counts.values(), *[None] * len(joined)], pa.int64()),
         pa.array([*[None] * n, *[o for _, o in joined.values()]], pa.int64())], names=["id", "n", "o"])


def _compare(group, at, y, ids, c, weight, also, threshold, counts, joined) -> None:
    """Links of a group with the rows ``at`` (vectors y), and one for each component it joins."""
    gc, gid, gw, x = group
    for j in range(0, len(gid), BLOCK):
        on = x[j:j + BLOCK] @ y.T >= threshold
        on &= gid[j:j + BLOCK, None] != ids[at][None, :]
        for i, n in zip(gid[j:j + BLOCK].tolist(), (on @ weight[at]).tolist()):
            if n:
                counts[i] = counts.get(i, 0) + n
        for i, n, own in zip(ids[at].tolist(), (gw[j:j + BLOCK] @ on).tolist(), also[at].tolist()):
            if n and not own:  # nodes of ``some`` count their links themselves
                counts[i] = counts.get(i, 0) + n
        p, q = np.nonzero(on & (c[at] != gc)[None, :])
        _, first = np.unique(c[at][q], return_index=True)
        for f in first:
            joined.setdefault((gc, int(c[at][q[f]])), (int(gid[j + p[f]]), int(ids[at][q[f]])))


def against_all(nodes: DataFrame, some: DataFrame, comp: DataFrame, dtype: str, threshold: float) -> DataFrame:
    """Every node of ``some (id, c, label, dim, v, weight)`` against all nodes of
    its label and length. Rows (id, n, o): with o null, n is a summed weight of
    links (of nodes of ``some`` with all nodes, of other nodes with those of
    ``some``); with o, a link between two components. ``comp (v, c)`` names the
    components of all nodes that have links."""
    sized = some.join(some.groupBy(F.col("c").alias("gc")).agg(F.count(F.lit(1)).alias("m")), F.col("c") == F.col("gc"))
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("m") / BLOCK))
    total = some.agg(F.sum(F.col("dim").cast("long") * 8)).first()[0] or 0
    chunks = -(-total // CHUNK_BYTES)
    # the nodes of a group share a chunk (a large group is cut into parts)
    dealt = materialise(sized.withColumn("chunk", F.pmod(F.xxhash64("c", part), F.lit(max(1, chunks))))
                        .select("id", "c", "label", "dim", "v", "weight", "chunk"), "nn-some")
    listed = some.select(F.col("id").alias("si"), F.lit(True).alias("listed"))
    every = nodes.join(comp.select(F.col("v").alias("cv"), F.col("c")), F.col("id") == F.col("cv"), "left") \
        .join(listed, F.col("id") == F.col("si"), "left") \
        .select("id", F.coalesce("c", "id").alias("c"), "label", "dim", "v", "weight", F.coalesce("listed", F.lit(False)).alias("listed"))
    every = materialise(every, "nn-every")
    within = np.arccos(threshold) + 1e-6
    schema = "id long, n long, o long"
    out = nodes.sparkSession.createDataFrame([], schema)
    for k in range(chunks):
        rows = dealt.where(F.col("chunk") == k).drop("chunk").toArrow()  # about CHUNK_BYTES
        if not rows.num_rows:
            continue
        held = nodes.sparkSession.sparkContext.broadcast(_groups(rows, dtype))

        def run(batches, held=held):
            counts: dict[int, int] = {}
            joined: dict[tuple[int, int], tuple[int, int]] = {}
            for b in batches:
                keys = list(zip(b.column(2).to_pylist(), b.column(3).to_pylist()))
                ids, c, weight = (b.column(i).to_numpy() for i in (0, 1, 5))
                also, blobs = b.column(6).to_numpy(zero_copy_only=False), b.column(4).to_pylist()
                for key in set(keys) & set(held.value):
                    pivots, radii, members = held.value[key]
                    who = np.array([i for i, x in enumerate(keys) if x == key])
                    for i in range(0, len(who), BLOCK):
                        at = who[i:i + BLOCK]
                        y = _unit([blobs[j] for j in at], dtype)
                        for g in range(0, len(pivots), BLOCK):
                            angle = np.arccos(np.clip(y @ pivots[g:g + BLOCK].T, -1, 1))
                            close = angle <= radii[g:g + BLOCK] + within
                            for q in np.flatnonzero(close.any(0)):
                                _compare(members[g + q], at[close[:, q]], y[close[:, q]], ids, c, weight, also, threshold, counts, joined)
                if len(counts) + len(joined) > 100000:
                    yield _packed(counts, joined)
                    counts.clear()
                    joined.clear()
            yield _packed(counts, joined)

        part_of = materialise(every.mapInArrow(run, schema), "nn-against")
        held.unpersist()
        out = out.unionByName(part_of)
    release(dealt)
    release(every)
    return out


def descend(nodes: DataFrame, dtype: str, graph: DataFrame | None, attempt: int) -> DataFrame:
    """The graph (a, b, s) of at most K neighbours a node, refined from new random groups."""
    n, groups = nodes.agg(F.count(F.lit(1)), F.count_distinct("label", "dim")).first()
    bits = max(0, math.ceil(math.log2(max(1, n / max(1, groups) / GROUP))))
    seeds = [start(nodes, dtype, bits, 2 * attempt + i) for i in range(2)]
    pool = seeds[0].unionByName(seeds[1])
    graph = materialise(_best(pool if graph is None else pool.unionByName(graph)), "nn-graph")
    for _ in range(ROUNDS):
        met = introduce(graph, nodes, dtype)
        old = graph.withColumn("fresh", F.lit(False))
        new = materialise(_best(old.unionByName(met)), "nn-graph")
        changed = new.where("fresh").count()
        release(graph)
        graph = new
        if changed <= SETTLED * K * n:
            break
    return graph


def enlarge(nodes: DataFrame, graph: DataFrame, dtype: str, threshold: float, whole: list = ()) -> tuple[DataFrame, DataFrame]:
    """(links, comp): (id, n) summed weights of every node's links, and the
    components (v, c), with the saturated nodes, and all of the (label, dim) in
    ``whole``, compared with all."""
    close = graph.where(F.col("s") >= threshold)
    edges = materialise(close.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "nn-links")
    comp = components(edges, "nn-cc")
    full = close.groupBy(F.col("a").alias("f")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= K).select("f")
    if whole:
        named = nodes.sparkSession.createDataFrame(whole, "label string, dim int")
        full = full.union(nodes.join(named, ["label", "dim"], "left_semi").select("id")).distinct()
    full = materialise(full, "nn-full")
    some = nodes.join(full, F.col("id") == F.col("f"), "left_semi") \
        .join(comp.select(F.col("v").alias("cv"), "c"), F.col("id") == F.col("cv"), "left") \
        .select("id", F.coalesce("c", "id").alias("c"), "label", "dim", "v", "weight")
    more = materialise(against_all(nodes, some, comp, dtype, threshold), "nn-more")
    both = edges.union(edges.select("b", "a")).toDF("id", "o")
    both = both.join(full, F.col("id") == F.col("f"), "left_anti").join(full, F.col("o") == F.col("f"), "left_anti")
    weight = nodes.select(F.col("id").alias("w"), "weight")
    plain = both.join(weight, F.col("o") == F.col("w")).select("id", F.col("weight").alias("n"))
    links = plain.unionByName(more.where("o is null").select("id", "n")).groupBy("id").agg(F.sum("n").alias("n"))
    bridges = more.where("o is not null").select(F.col("id").alias("a"), F.col("o").alias("b"))
    if bridges.limit(1).count():
        comp = components(edges.unionByName(bridges), "nn-cc")
    return materialise(links, "nn-counts"), comp


def audit(nodes: DataFrame, links: DataFrame, comp: DataFrame, dtype: str, threshold: float) -> tuple[float, list]:
    """Recall of the counted links of nodes chosen by hash, against all rows,
    and the (label, dim) that have less than RECALL."""
    want, n = AUDIT, nodes.count()
    while True:
        some = nodes.where(F.pmod(F.xxhash64("id", F.lit(99)), F.lit(max(1, n))) < want)
        probe = materialise(some.join(comp.select(F.col("v").alias("cv"), "c"), F.col("id") == F.col("cv"), "left")
                            .select("id", F.coalesce("c", "id").alias("c"), "label", "dim", "v", "weight"), "nn-probe")
        true = against_all(nodes, probe, comp, dtype, threshold).where("o is null").groupBy(F.col("id").alias("p")).agg(F.sum("n").alias("t"))
        held = probe.join(true, F.col("id") == F.col("p")).select("id", "label", "dim", "t").join(links, "id", "left") \
            .groupBy("label", "dim").agg(F.sum("t").alias("t"), F.sum(F.least("t", F.coalesce("n", F.lit(0)))).alias("f"))
        t, f = (x or 0 for x in held.agg(F.sum("t"), F.sum("f")).first())
        if t >= AUDIT_LINKS or want >= n:
            # as many rows as there are labels that fail
            return (f / t if t else 1.0), [tuple(r) for r in held.where(F.col("f") < F.lit(RECALL) * F.col("t")).select("label", "dim").collect()]
        want *= 8


def near_duplicates(emb: DataFrame, threshold: float = 0.93) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    emb = emb.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    rows, nodes, dtype = fold(emb)
    rows = materialise(rows, "nn-rows")
    graph = None
    for attempt in range(ATTEMPTS):
        graph = descend(nodes, dtype, graph, attempt)
        links, comp = enlarge(nodes, graph, dtype, threshold)
        recall, failing = audit(nodes, links, comp, dtype, threshold)
        if recall >= RECALL:
            break
    else:
        links, comp = enlarge(nodes, graph, dtype, threshold, failing)
    links = links.select(F.col("id").alias("l"), "n")
    of_node = nodes.select("id", "weight").join(links, F.col("id") == F.col("l"), "left").join(
        comp.select(F.col("v").alias("cv"), "c"), F.col("id") == F.col("cv"), "left") \
        .select(F.col("id").alias("node"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"), F.coalesce("c", "id").alias("c"))
    known = rows.join(of_node, "node").select(F.col("vec_id").alias("kv"), "n", "c")
    out = emb.select("vec_id").distinct().join(known, F.col("vec_id") == F.col("kv"), "left")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("c", "vec_id").alias("component_id")) \
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
