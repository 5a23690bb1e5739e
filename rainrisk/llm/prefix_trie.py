"""Prefix trie of conversations: adaptive radix trees over turn ids.

A conversation is the byte string of its turns' ids, 16 bytes each (the start
of the SHA-256 of role and text, big-endian, so all of one width); its prefixes
at whole turns are the trie's nodes. Nothing after the first step holds texts:

1. Turns become (turn, id, code points) and meet once per conversation.
2. Equal byte strings are counted: number, smallest conv_id, and the SHA-256
   of their conv_ids. The ids of one string may be a third of all: they are
   sorted over as many range partitions as they need, each writes its ids as
   text of ``CHUNK_IDS`` ids a row, and only this text passes one hash.
3. Distinct strings are dealt to ranges of about ``RANGE_BYTES`` in byte
   order. Each range is one radix tree with nodes of 4, 16, 48 and 256 places
   that grow with their children, and compressed paths; a walk over it emits a
   node wherever a path passes a whole turn (inner branches between turns emit
   none), then sums go from the leaves upward.
4. Nodes on the paths of strings next to a range's ends also lie in the next
   range. How many turns the neighbours share (two integers a range) tells
   which these are; a turn is counted in the range that sees it first, so that
   their sums over ranges are exact. They are summed by the digest of their
   path, and the nodes below them look up their parent's smallest conv_id, with
   copies in ``SALTS`` shares as the root has any number of children.

Sums of saved_tokens go over strings and distinct nodes: (members - 1) times
length is length summed over members, less once per node.

Cases: rows without conv_id take no part; null role or text is empty; a null
turn comes first; turns with equal numbers go by their ids, repeated rows are
turns of their own; a conversation whose turns are all replaced by an absent
one is a member of the root only; without conversations there is no node;
other columns are not read. One task holds one conversation's ids (16 bytes
and a length a turn), never its texts.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, table

WIDTH = 16                # bytes of a turn's id
RANGE_BYTES = 4 << 20     # of the strings of one tree
CHUNK_IDS = 1 << 16       # ids a row on their way to the hash
CHUNK_ROWS = 1 << 17      # ids a partition writes
SALTS = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()


# -------------------------------------------------------- adaptive radix tree

class Node:
    """A compressed path and the children behind it, in the smallest of four
    layouts: up to 4 or 16 sorted bytes, 48 places behind an index of 256, or
    256 places. ``end`` is the number of the string that ends behind the path."""

    __slots__ = ("path", "end", "places", "keys", "kids")

    def __init__(self, path: bytes, end: int = -1):
        self.path, self.end, self.places, self.keys, self.kids = path, end, 4, bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.places <= 16:
            at = self.keys.find(byte)
            return self.kids[at] if at >= 0 else None
        if self.places == 48:
            at = self.keys[byte]
            return self.kids[at - 1] if at else None
        return self.kids[byte]

    def add(self, byte: int, kid: Node) -> None:
        if self.places <= 16 and len(self.kids) == self.places:
            self._grow()
        elif self.places == 48 and len(self.kids) == 48:
            self._grow()
        if self.places <= 16:
            at = 0
            while at < len(self.keys) and self.keys[at] < byte:
                at += 1
            self.keys.insert(at, byte)
            self.kids.insert(at, kid)
        elif self.places == 48:
            self.kids.append(kid)
            self.keys[byte] = len(self.kids)
        else:
            self.kids[byte] = kid

    def _grow(self) -> None:
        if self.places == 4:
            self.places = 16
        elif self.places == 16:
            index = bytearray(256)
            for at, byte in enumerate(self.keys):
                index[byte] = at + 1
            self.places, self.keys = 48, index
        else:
            kids = [self.kids[at - 1] if at else None for at in self.keys]
            self.places, self.keys, self.kids = 256, bytearray(), kids

    def in_order(self) -> list[tuple[int, Node]]:
        if self.places <= 16:
            return list(zip(self.keys, self.kids))
        if self.places == 48:
            return [(byte, self.kids[at - 1]) for byte, at in enumerate(self.keys) if at]
        return [(byte, kid) for byte, kid in enumerate(self.kids) if kid is not None]


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] agrees, a[:hi] does not
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def insert(root: Node, string: bytes, end: int) -> None:
    node, at = root, 0
    while True:
        path = node.path
        if not string.startswith(path, at):
            m = common(path, string[at:at + len(path)])
            below = Node(path[m + 1:], node.end)
            below.places, below.keys, below.kids = node.places, node.keys, node.kids
            node.path, node.end, node.places, node.keys, node.kids = path[:m], -1, 4, bytearray(), []
            node.add(path[m], below)
            path = node.path
        at += len(path)
        if at == len(string):
            node.end = end
            return
        kid = node.child(string[at])
        if kid is None:
            node.add(string[at], Node(string[at + 1:], end))
            return
        node, at = kid, at + 1


class Nodes:
    """Nodes of the trie, parents first: one per whole turn on a path."""

    def __init__(self):
        self.parent, self.depth = array("q"), array("q")
        self.ends: dict[int, int] = {}  # node -> string that ends there

    def emit(self, parent: int, depth: int) -> int:
        self.parent.append(parent)
        self.depth.append(depth)
        return len(self.parent) - 1

    @classmethod
    def of(cls, root: Node, width: int = WIDTH) -> Nodes:
        out = cls()
        todo = [(root, 0, out.emit(-1, 0))]  # (node, bytes before its path, trie node above)
        while todo:
            node, start, above = todo.pop()
            stop = start + len(node.path)
            for depth in range(out.depth[above] + 1, stop // width + 1):
                above = out.emit(above, depth)
            if node.end >= 0:
                out.ends[above] = node.end
            todo += [(kid, stop + 1, above) for _, kid in reversed(node.in_order())]
        return out


# ---------------------------------------------------------------- one range

def summed(keys: list[bytes], lens: list[np.ndarray], copies: list[int], first: list[int],
           shares_before: int = -1, shares_after: int = -1, width: int = WIDTH) -> dict:
    """The trie nodes of a range's distinct strings with their sums, as arrays.
    ``shares_before`` and ``shares_after``: whole turns that the first string
    shares with the last one of the range before, and the last with the first
    one behind (-1: there is none)."""
    root = Node(b"")
    for i, k in enumerate(keys):
        insert(root, k, i)
    t = Nodes.of(root, width)
    parent, depth, n = t.parent, t.depth, len(t.parent)
    at_end = {s: v for v, s in t.ends.items()}
    low, high = min(range(len(keys)), key=keys.__getitem__), max(range(len(keys)), key=keys.__getitem__)
    seen, open_ = set(), set()  # also in the range before; in any other range
    for string, most, also in ((low, shares_before, seen), (high, shares_after, None)):
        v = at_end[string]
        while v >= 0:
            if depth[v] <= most:
                open_.add(v)
                if also is not None:
                    also.add(v)
            v = parent[v]
    zeros = lambda: array("q", bytes(8 * n))
    members, children, leaves, saved, size = zeros(), zeros(), zeros(), zeros(), zeros()
    least = array("q", [(1 << 63) - 1]) * n
    sized = bytearray(n)
    sized[0] = 1  # the root has no text
    for v, s in t.ends.items():
        members[v], least[v] = copies[s], first[s]
        while not sized[v]:
            size[v], sized[v] = lens[s][depth[v] - 1], 1
            v = parent[v]
    below = bytearray(n)
    for v in range(n - 1, -1, -1):
        if not below[v] and not (v == at_end[high] and shares_after >= depth[v]):
            leaves[v] += 1
        saved[v] += members[v] * size[v] - (0 if v in seen else size[v])
        u = parent[v]
        if u >= 0:
            below[u] = 1
            members[u] += members[v]
            least[u] = min(least[u], least[v])
            children[u] += v not in seen
            leaves[u] += leaves[v]
            saved[u] += saved[v]
    digest = {}
    for string in (low, high):
        path, v = [], at_end[string]
        while v >= 0:
            path.append(v)
            v = parent[v]
        h = hashlib.sha256()
        for v in reversed(path):  # from the root
            if v not in open_:
                break
            if depth[v]:
                h.update(keys[string][(depth[v] - 1) * width:depth[v] * width])
            digest[v] = h.copy().digest()
    return {"parent": parent, "depth": depth, "members": members, "least": least, "children": children, "leaves": leaves,
            "saved": saved, "ends": t.ends, "digest": digest}


OUT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _range_nodes(shares: dict[int, tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(list(batches)).combine_chunks()
        r = summed(got["key"].to_pylist(), [x.values.to_numpy() for x in got["lens"]], got["copies"].to_pylist(),
                   got["first"].to_pylist(), *shares.get(got["p"][0].as_py(), (-1, -1)))
        parent, least = np.array(r["parent"]), np.array(r["least"])
        n, digest = len(parent), r["digest"]
        up = least[parent].tolist()
        whole = [None if p < 0 or p in digest else x for p, x in zip(r["parent"], up)]
        ends = [None] * n
        for v, s in r["ends"].items():
            ends[v] = got["ends"][s].as_py()
        cols = {"conv_id": least, "depth": np.array(r["depth"]), "parent_conv_id": pa.array(whole, pa.int64()),
                "n_convs": np.array(r["members"]), "n_children": np.array(r["children"]), "n_leaves": np.array(r["leaves"]),
                "saved_tokens": np.array(r["saved"]), "ends_sha256": pa.array(ends, pa.string()),
                "own": pa.array([digest.get(v) for v in range(n)], pa.binary()),
                "above": pa.array([digest.get(p) for p in r["parent"]], pa.binary())}
        out = pa.RecordBatch.from_pydict(cols)
        for i in range(0, n, 1 << 16):
            yield out.slice(i, 1 << 16)
    return run


# ------------------------------------------------------------------ in Spark

def turn_id(role: Column, text: Column) -> Column:
    """Hexadecimal id of a turn."""
    return F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<turn, id, chars>>), in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    one = F.struct(F.col("turn"), turn_id(role, text).alias("id"), F.length(text).alias("chars"))
    return conversations.where("conv_id is not null").groupBy(F.col("conv_id").cast("long").alias("conv_id")) \
        .agg(F.sort_array(F.collect_list(one)).alias("turns"))


def rebuilt(conversations: DataFrame, heads: int = 6, group: int = 100) -> DataFrame:
    """(conv_id, key, lens): the first h turns of the group's first
    conversation, then those of one's own behind the first h."""
    own = materialise(turn_lists(conversations), "trie-turns")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    base = own.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("b"), F.slice("turns", 1, heads).alias("head"))
    j = own.join(base, F.col("conv_id") - F.col("conv_id") % group == F.col("b"), "left")
    none = F.slice("turns", 1, 0)
    turns = F.concat(F.slice(F.coalesce("head", none), F.lit(1), h), F.slice("turns", h + 1, F.size("turns") + 1))
    j = j.select("conv_id", turns.alias("t"))
    return j.select("conv_id", F.unhex(F.array_join(F.transform("t", lambda x: x["id"]), "")).alias("key"),
                    F.transform("t", lambda x: x["chars"].cast("int")).alias("lens"))


def _id_text(batches):
    """Sorted (kd, conv_id) as rows of up to CHUNK_IDS ids joined by commas."""
    kd, ids, first = None, [], None

    def row():
        return pa.RecordBatch.from_pydict({"kd": pa.array([kd], pa.binary()), "first": [ids[0]], "copies": [len(ids)],
                                           "text": [",".join(map(str, ids)).encode()]})
    for b in batches:
        for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if k != kd or len(ids) >= CHUNK_IDS:
                if ids:
                    yield row()
                kd, ids = k, []
            ids.append(c)
    if ids:
        yield row()


def _id_hash(batches):
    """Rows of _id_text sorted by (kd, first) to one digest per kd."""
    kd, h, n, first = None, None, 0, None
    done = []

    def rows():
        return pa.RecordBatch.from_pydict({"kd": pa.array([x[0] for x in done], pa.binary()), "first": [x[1] for x in done],
                                           "copies": [x[2] for x in done], "ends": [x[3] for x in done]})
    for b in batches:
        for k, c, m, text in zip(*(b.column(i).to_pylist() for i in range(4))):
            if k != kd:
                if h is not None:
                    done.append((kd, first, n, h.hexdigest()))
                    if len(done) >= 4096:
                        yield rows()
                        done.clear()
                kd, h, n, first = k, hashlib.sha256(), 0, c
            else:
                h.update(b",")
            h.update(text)
            n += m
    if h is not None:
        done.append((kd, first, n, h.hexdigest()))
    if done:
        yield rows()


def distinct_strings(convs: DataFrame) -> DataFrame:
    """(key, lens, copies, first, ends) of each distinct byte string."""
    kd = F.unhex(F.sha2(F.col("key"), 256)).alias("kd")
    ids = convs.select(kd, "conv_id")
    parts = max(1, -(-convs.count() // CHUNK_ROWS))
    text = ids.repartitionByRange(parts, "kd", "conv_id").sortWithinPartitions("kd", "conv_id") \
        .mapInArrow(_id_text, "kd binary, first long, copies long, text binary")
    ends = text.repartition("kd").sortWithinPartitions("kd", "first") \
        .mapInArrow(_id_hash, "kd binary, first long, copies long, ends string")
    keys = convs.groupBy(kd).agg(F.first("key").alias("key"), F.first("lens").alias("lens"))
    return keys.join(ends, "kd").select("key", "lens", "copies", "first", "ends")


def _shares(ranged: DataFrame) -> dict[int, tuple[int, int]]:
    """Per range: whole turns shared with the neighbours (-1: no neighbour)."""
    ends = ranged.groupBy("p").agg(F.min("key").alias("a"), F.max("key").alias("z"))
    w = Window.orderBy("p")  # one row a range
    ends = ends.select("p", "a", "z", F.lag("z").over(w).alias("before"), F.lead("a").over(w).alias("after"))

    def run(batches):
        for b in batches:
            p, a, z, before, after = (b.column(i).to_pylist() for i in range(5))
            yield pa.RecordBatch.from_pydict({
                "p": pa.array(p, pa.int32()),
                "before": [-1 if y is None else common(x, y) // WIDTH for x, y in zip(a, before)],
                "after": [-1 if y is None else common(x, y) // WIDTH for x, y in zip(z, after)]})
    return {r["p"]: (r["before"], r["after"]) for r in ends.mapInArrow(run, "p int, before long, after long").collect()}


def trie(convs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The trie's nodes over ``convs (conv_id, key, lens)``, conv_id unique."""
    strings = materialise(distinct_strings(convs), "trie-strings")
    size = strings.agg(F.sum(F.octet_length("key") + WIDTH)).first()[0] or 0
    ranges = max(1, -(-size // range_bytes))
    ranged = materialise(strings.repartitionByRange(ranges, "key").withColumn("p", F.spark_partition_id()), "trie-ranges")
    shares = _shares(ranged) if ranges > 1 else {}
    parts = materialise(ranged.groupBy("p").applyInArrow(_range_nodes(shares), OUT + ", own binary, above binary"), "trie-nodes")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    spine = parts.where("own is not null").groupBy("own").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), *sums, F.max("ends_sha256").alias("ends_sha256"),
        F.first("above").alias("above")).withColumn("parent_conv_id", F.lit(None).cast("long"))
    spine = materialise(spine, "trie-spine")
    cols = [f.split()[0] for f in OUT.split(", ")]
    hang = parts.where("own is null and above is not null").select(*cols, "above").union(spine.select(*cols, "above"))
    salt = F.pmod(F.hash("conv_id", "depth"), F.lit(SALTS))
    up = spine.select(F.col("own").alias("o"), F.col("conv_id").alias("up"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    found = hang.withColumn("salt", salt).join(up, (F.col("above") == F.col("o")) & (F.col("salt") == F.col("s")), "left") \
        .withColumn("parent_conv_id", F.col("up"))
    out = parts.where("own is null and above is null").select(*cols).union(found.select(*cols))
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return trie(materialise(rebuilt(table(spark, sf_dir, "conversations")), "trie-convs"))


OP12_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         left(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), {2 * WIDTH}) AS id
  FROM conversations WHERE conv_id IS NOT NULL),
own AS MATERIALIZED (
  SELECT conv_id, list({{'id': id, 'chars': length(text)}} ORDER BY turn NULLS FIRST, id) AS turns FROM turns GROUP BY conv_id),
-- crc32 of the decimal id: eight shifts for each byte
cut AS (
  SELECT conv_id, turns,
         CAST(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT,0,0,0,0,0,0,0]),
             lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 6 AS INTEGER) AS h
  FROM own),
convs AS MATERIALIZED (
  SELECT c.conv_id, list_concat(coalesce(b.turns, [])[:h], c.turns[h + 1:]) AS turns
  FROM cut c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
steps AS MATERIALIZED (
  SELECT conv_id, d AS depth, len(turns) = d AS ends, CASE WHEN d > 0 THEN turns[d].chars ELSE 0 END AS chars,
         list_transform(turns[:d], lambda x: x.id) AS path
  FROM convs, unnest(range(len(turns) + 1)) AS u(d)),
nodes AS MATERIALIZED (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM steps GROUP BY path, depth),
placed AS MATERIALIZED (SELECT s.conv_id AS member, s.depth, n.conv_id FROM steps s JOIN nodes n USING (path, depth)),
kids AS (
  SELECT p.conv_id, p.depth, count(*) AS n_children
  FROM nodes n JOIN placed p ON p.member = n.conv_id AND p.depth = n.depth - 1 GROUP BY ALL),
whole AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (conv_id, depth)),
subtree AS (
  SELECT a.conv_id, a.depth, count(*) FILTER (WHERE n.n_children = 0) AS n_leaves, CAST(sum(n.saved) AS BIGINT) AS saved_tokens
  FROM whole n JOIN placed a ON a.member = n.conv_id AND a.depth <= n.depth GROUP BY ALL)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM whole w JOIN subtree USING (conv_id, depth) LEFT JOIN placed p ON p.member = w.conv_id AND p.depth = w.depth - 1
"""
