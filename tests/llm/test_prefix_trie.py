"""Prefix trie of conversations against its SQL and a dictionary of prefixes."""
import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from rainrisk.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int"
COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuild(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own.setdefault(c, []).append((t is not None, t or 0, hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest()[:32], r, x))
    own = {c: [k[3:] for k in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - int(np.fmod(c, 100)), [])[:h] + turns[h:]
    return out


def nodes_of(convs):
    """{prefix: members} and every node's row."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids, sums = {}, {}
    for p in members:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    for p, m in members.items():
        own = (len(m) - 1) * (len(p[-1][1]) if p else 0)
        for d in range(len(p) + 1):
            s = sums.setdefault(p[:d], [0, 0])
            s[0] += p not in kids
            s[1] += own
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(convs[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids.get(p, 0), *sums[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def made(seed, convs=260, texts=4):
    rnd = random.Random(seed)
    turn = lambda: (rnd.choice(["user", "assistant", None]), rnd.choice(["", None, "hé", "a" * 5, "b\n" * 40][:texts + 1]))
    rows = []
    for c in list(range(convs)) + [-1, -205, -300, 10 ** 15, 10 ** 15 + 7, 707]:
        if c % 7 == 3:
            continue
        n = rnd.choice([1, 1, 2, 3, 5, 8])
        if c % 5 == 0:  # many equal ones
            rows += [(c, t, "user", "same") for t in range(n)]
        else:
            rows += [(c, t, *turn()) for t in range(n)]
    rows += [(3, 0, "user", "only here"), (8, None, "system", "first"), (8, 0, "x", "tie"), (8, 0, "y", "tie"), (8, 0, "y", "tie"),
             (None, 0, "user", "nobody"), (None, None, None, None)]
    rnd.shuffle(rows)
    return rows


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA)
    out = P.trie(P.materialise(P.rebuilt(df), "t"), **options)
    assert out.columns == COLS
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("range_bytes", [P.RANGE_BYTES, 900, 120])
def test_equals_a_dictionary(spark, range_bytes, monkeypatch):
    monkeypatch.setattr(P, "CHUNK_ROWS", 50)
    rows = made(range_bytes)
    assert run(spark, rows, range_bytes=range_bytes) == nodes_of(rebuild(rows))


def test_equals_sql(spark):
    rows = made(1, convs=130)
    con = duckdb.connect()
    con.execute("create table conversations(conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    con.execute(f"create table o as {P.OP12_SQL}")
    assert sorted(con.execute(f"select {', '.join(COLS)} from o").fetchall()) == nodes_of(rebuild(rows))


def test_long_conversation_and_turnless_ones(spark):
    rows = [(100, t, "user", f"{t}" * (t % 3)) for t in range(3000)] + [(100, 5000, "u", "x" * 300_000)] + [(7, 0, "user", "z")]
    rows += [(c, 0, "u", "only") for c in (1, 2, 4, 5)]  # h > 0 leaves some without turns
    assert any(not t for t in rebuild(rows).values())
    got = run(spark, rows)
    assert len(got) == len({(r[0], r[1]) for r in got})
    short = {c: t for c, t in rebuild(rows).items() if len(t) < 50}
    assert [r for r in got if r[0] != 100 and r[1]] == [r for r in nodes_of(short) if r[1]]
    assert sum(r[0] == 100 for r in got) == 3001 and max(r[1] for r in got) == 3001
    only = [(1, 0, "u", "x")]
    if not rebuild(only)[1]:
        assert run(spark, only) == nodes_of(rebuild(only))
    assert run(spark, [(4, 0, "u", "x"), (6, 1, "u", "x")]) == nodes_of(rebuild([(4, 0, "u", "x"), (6, 1, "u", "x")]))


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "a", "b")]) == []


def test_tree_keeps_order_and_grows():
    rnd = random.Random(2)
    keys = {bytes(rnd.choice(b"\x00\x01\xfe\xff" if rnd.random() < .7 else range(256)) for _ in range(2 * rnd.randint(0, 6))) for _ in range(4000)}
    root = P.Node(b"")
    order = list(keys)
    for i, k in enumerate(order):
        P.insert(root, k, i)
    found, layouts, todo = [], set(), [(root, b"")]
    while todo:
        node, before = todo.pop()
        layouts.add(node.places)
        before += node.path
        if node.end >= 0:
            assert order[node.end] == before
            found.append(before)
        kids = node.in_order()
        assert [b for b, _ in kids] == sorted(b for b, _ in kids) and all(node.child(b) is k for b, k in kids)
        todo += [(k, before + bytes([b])) for b, k in reversed(kids)]
    assert found == sorted(keys) and layouts == {4, 16, 48, 256}


def test_parts_add_up_to_the_whole():
    """Ranges of sorted strings, however cut, give the sums of one tree."""
    rnd = random.Random(7)
    keys = sorted({bytes(rnd.choice(b"\x00\x01") for _ in range(2 * rnd.randint(0, 5))) for _ in range(300)})
    length = {bytes(x): i + 1 for i, x in enumerate({(a, b) for a in (0, 1) for b in (0, 1)})}
    lens = [np.array([length[k[i:i + 2]] for i in range(0, len(k), 2)], np.int64) for k in keys]
    whole = P.summed(keys, lens, [2] * len(keys), list(range(len(keys))), width=2)
    for step in (1, 3, 40):
        cuts = list(range(0, len(keys), step)) + [len(keys)]
        total = [0, 0, 0, 0]
        for a, z in zip(cuts, cuts[1:]):
            before = P.common(keys[a - 1], keys[a]) // 2 if a else -1
            after = P.common(keys[z - 1], keys[z]) // 2 if z < len(keys) else -1
            r = P.summed(keys[a:z], lens[a:z], [2] * (z - a), list(range(a, z)), before, after, width=2)
            for i, c in enumerate(("members", "children", "leaves", "saved")):
                total[i] += r[c][0]
        assert total == [whole[c][0] for c in ("members", "children", "leaves", "saved")]
