"""Suffix-array dedup against a brute-force search of all strings."""
import hashlib
import random
import sys
from collections import defaultdict

import numpy as np
import pytest

from rainrisk.llm import suffix_dedup as S

LENGTH = 400


def brute(rows):
    """Kept bytes and spans per row, from a dictionary of all strings."""
    texts = [(t or "").encode() for _, t in rows]
    seen = defaultdict(int)
    for t in texts:
        for i in range(len(t) - LENGTH + 1):
            seen[t[i:i + LENGTH]] += 1
    out = []
    for t in texts:
        cover = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - LENGTH + 1):
            if seen[t[i:i + LENGTH]] > 1:
                cover[i:i + LENGTH] = True
        runs = int((cover[1:] & ~cover[:-1]).sum() + cover[0])
        out.append((len(t), int(cover.sum()), runs, hashlib.sha256(t and np.frombuffer(t, np.uint8)[~cover[:-1]].tobytes()).hexdigest()))
    return out


def fixture(seed):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefgé") for _ in range(r.randint(1, 9))) for _ in range(300)]

    def prose(n):
        return " ".join(r.choice(vocab) for _ in range(n))

    passage = [prose(r.randint(60, 300)) for _ in range(4)]
    rows = []
    for i in range(60):
        t = prose(r.randint(1, 300))
        for _ in range(r.randint(0, 3)):  # a passage, or an exact or ragged part of it
            p = r.choice(passage)
            a, k = r.randint(0, 40), r.choice([399, 400, 401, 410, 600, 5000])
            at = r.randint(0, len(t))
            t = t[:at] + p[a:a + k] + t[at:]
        if r.random() < .1:
            t += r.choice(["x" * r.randint(380, 900), "ab" * r.randint(190, 500), "Eron, " * r.randint(60, 200)])
        rows.append((i, t))
    base = rows[0][1] + prose(300)
    rows += [(100 + i, base) for i in range(5)]
    for i in range(12):  # near copies: a word changed, a start or an end cut
        w = base.split(" ")
        w[r.randrange(len(w))] = "changed"
        rows.append((200 + i, " ".join(w)[r.randint(0, 30):len(base) - r.randint(0, 30)]))
    rows += [(300, None), (301, ""), (302, "short"), (None, prose(120)), (303, prose(200)), (303, prose(200))]
    rows += [rows[5], (304, prose(40) + " " + prose(500)), (305, "z" * 399), (306, "z" * 399)]
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rows = fixture(seed)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, spans string, pos int").repartition(3)
    got = []
    for r in S.remove_repeats(df).collect():
        cut = sum(s["end"] - s["start"] for s in r["spans"])
        assert (r["row"]["spans"], r["row"]["pos"]) == ("x", 1)  # columns of the input are carried, whatever their names
        got.append((r["row"]["doc_id"], len(r["kept"]) + cut, cut, len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest()))
    want = [(i, *x) for (i, _), x in zip(rows, brute(rows))]
    key = lambda x: (x[0] is None, x)
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("length", [255, 40])
def test_short_lengths_against_brute_force(spark, monkeypatch, length):
    monkeypatch.setattr(sys.modules[__name__], "LENGTH", length)
    rows = fixture(4)
    got = []
    for x in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), length).collect():
        cut = sum(s["end"] - s["start"] for s in x["spans"])
        got.append((x["row"]["doc_id"], len(x["kept"]) + cut, cut, len(x["spans"]), hashlib.sha256(bytes(x["kept"])).hexdigest()))
    key = lambda x: (x[0] is None, x)
    assert sorted(got, key=key) == sorted([(i, *w) for (i, _), w in zip(rows, brute(rows))], key=key)


def test_shared_boilerplate_is_cut_into_ranges(spark, monkeypatch):
    # a common header of 600 bytes before different texts: its suffixes don't meet in one range
    r = random.Random(7)
    prose = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    header = prose(600)
    rows = [(i, prose(r.randint(0, 40)) + header + prose(300)) for i in range(150)] + [(500 + i, header[:420] + prose(99)) for i in range(9)]
    runs, suffix_runs = [], S._suffix_runs
    monkeypatch.setattr(S, "RANGE_BYTES", 1 << 15)
    monkeypatch.setattr(S, "_suffix_runs", lambda *a: runs.append(suffix_runs(*a)) or runs[0])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = []
    for x in S.remove_repeats(df).collect():
        cut = sum(s["end"] - s["start"] for s in x["spans"])
        got.append((x["row"]["doc_id"], len(x["kept"]) + cut, cut, len(x["spans"]), hashlib.sha256(bytes(x["kept"])).hexdigest()))
    assert sorted(got) == sorted((i, *w) for (i, _), w in zip(rows, brute(rows)))
    size = {}
    for x in runs[0].collect():
        size[x["range"]] = size.get(x["range"], 0) + sum(len(i[1]) for i in S.read_run(x["run"]))
    assert len(size) > 4 and max(size.values()) < .5 * sum(size.values())


def test_empty_table(spark):
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_merge_of_front_coded_runs():
    r = random.Random(1)
    items = ["".join(r.choice("ab") for _ in range(r.randint(1, 30))).encode() for _ in range(400)]
    runs = [sorted(set(items[i::7])) for i in range(7)]
    out = list(S.merge_runs([S.front_code([(x, 1, 2, False) for x in run]) for run in runs] + [b""]))
    assert [x[1] for x in out] == sorted(x for run in runs for x in run)
    for a, b in zip(out, out[1:]):
        assert b[0] == S.common_from(a[1], b[1], 0)
    assert list(S.merge_runs([])) == [] and len(list(S.merge_runs([S.front_code([(b"a", 1, 1, True)])]))) == 1


def test_many_equal_rows_and_the_longest_repeat(spark):
    r = random.Random(9)
    prose = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    same, shared = prose(3000), prose(320)
    rows = [(1, same)] * 1500 + [(2, prose(900)), (3, prose(500) + shared + prose(700)), (4, prose(800) + shared + prose(300)), (5, None)]
    got = {}
    for x in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect():
        got.setdefault(x["row"]["doc_id"], []).append((len(x["kept"]), x["longest"]))
    assert len(got[1]) == 1500 and {k for k, _ in got[1]} == {0} and all(400 < m <= 400 + S.GAP for _, m in got[1])
    assert got[2] == [(900, 0)] and got[5] == [(0, 0)]
    assert got[3][0][0] == 1520 and got[4][0][0] == 1420          # nothing of 400 bytes is repeated
    assert all(200 <= got[i][0][1] <= 320 for i in (3, 4))        # but this is


def test_a_line_of_every_document_is_compared_once(spark, monkeypatch):
    """Anchors with equal surroundings stand for each other: what is compared grows
    with the distinct surroundings, not with the documents that hold a line."""
    r = random.Random(9)

    def prose(n):
        return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(n))

    line = prose(60) + "\n"
    rows = [(i, prose(20) + "\n" + line * 12 + prose(20)) for i in range(40)]
    sizes, write = {}, S.materialise

    def counted(df, label):
        out = write(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(S, "materialise", counted)
    got = S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).select("row.doc_id", "kept").collect()
    assert {x["doc_id"]: hashlib.sha256(bytes(x["kept"])).hexdigest() for x in got} == {i: x[3] for (i, _), x in zip(rows, brute(rows))}
    assert sizes["suffix-edges"] > 40 * 12  # every document has its anchors
    assert sizes["suffix-mates"] < sizes["suffix-edges"] / 4
