"""Byte-level BPE against tiktoken, and the round trip."""
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest

from rainrisk.llm import byte_bpe as B

PATH = P.path("byte_bpe_50k.tiktoken")
TEXTS = ["", " ", "hello world", "don't   stop\n\n\tnow", "a" * 100_000, "ab" * 40, "x" * 64, "x" * 65, "ü" * 70, "😀" * 300,
         "naïve café — déjà vu", "1234567890" * 9, "\x00\x01\x7f", " " * 200 + "end", "日本語のテキスト" * 20, None]


@pytest.fixture(scope="module")
def reference():
    import tiktoken
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=B.load_ranks(PATH), special_tokens={})


def test_codec_equals_tiktoken(reference):
    r = random.Random(5)
    texts = [t or "" for t in TEXTS] + ["".join(r.choice("abcdeé '’st.,\n\t 019-") for _ in range(r.randint(0, 80))) for _ in range(300)]
    codec = B.codec(PATH, P.PATTERN)
    ids = codec.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [reference.encode_ordinary(t) for t in texts]
    assert codec.decode(ids) == [t.encode() for t in texts]


def test_memo_limit_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(B, "MEMO", 3)
    codec = B._Codec(PATH, P.PATTERN)
    texts = ["one two three four five six", "seven eight one nine"]
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == [reference.encode_ordinary(t) for t in texts]
    assert len(codec) == 3


def test_trees_equal_single_tree(reference):
    ranks = B.load_ranks(PATH)
    merger, r = B.Merger(ranks), random.Random(2)
    pieces = [bytes(r.randrange(97, 105) for _ in range(r.randint(1, 64))) for _ in range(500)]
    assert merger.merge(pieces) == [np.array(B.merge_piece(p, ranks), "<u4").tobytes() for p in pieces]


def test_query_rows(spark, reference):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "no id", "y"), (2, TEXTS[2], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted((tuple(r) for r in B.digests(df, PATH, P.PATTERN).collect()), key=str)
    want = []
    for i, t, _ in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert B.digests(df.limit(0), PATH, P.PATTERN).collect() == []
