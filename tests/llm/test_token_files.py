"""Token files: layout, offsets and ids against whole-text encoding."""
import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from rainrisk.llm import token_files as T
from rainrisk.llm.files import mapped

PATH = P.path("word_bpe_49k.json")
TEXTS = [None, "", "Hello, World", "don't they'll 'tis", "ÉCOLE café naïve", "a\x1cb\x85c\xa0d", "İstanbul Σίσυφος ﬁ", "x" * 5000,
         "é combining", "<|endoftext|> inside", "1234 5,6", "日本語 текст", " \n\t ", "same", "same"]


def test_word_encoder_equals_whole_text():
    tok, enc = Tokenizer.from_file(PATH), T.WordEncoder(PATH)
    texts = [t or "" for t in TEXTS]
    assert enc.cut
    assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(texts)] == \
        [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_rules_are_not_cut(tmp_path):
    from tokenizers import models, pre_tokenizers
    t = Tokenizer(models.WordLevel({"[UNK]": 0, "A,b": 1}, unk_token="[UNK]"))
    t.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    t.save(str(tmp_path / "t.json"))
    enc = T.WordEncoder(str(tmp_path / "t.json"))
    assert not enc.cut and np.frombuffer(enc.encode(["A,b zz"])[0], enc.dtype).tolist() == [1, 0]


def test_files_and_rows(spark, scratch):
    tok = Tokenizer.from_file(PATH)
    rows = [(7 * i % 31, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "no id", "c"), (3, "three", "c"), (3, "three", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(4)
    folder = scratch("tokens")
    manifest = T.write_tokens(df, folder, PATH)
    got = [(r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(bytes(r["ids"]))) for r in T.read_tokens(manifest, "<u2").collect()]
    want, at = [], 0
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
    # the files as documented: global offsets, flat ids
    for m in manifest.collect():
        off, ids = mapped(f"{m['file']}.off", "<i8"), mapped(f"{m['file']}.ids", "<u2")
        assert off[0] == m["base"] and off[-1] == m["base"] + m["n_tokens"] == m["base"] + len(ids) and len(off) == m["n_docs"] + 1


def test_empty_table(spark):
    assert T.token_files(spark, spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
