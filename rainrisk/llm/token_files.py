"""Token ids as flat binary files.

Layout of a folder, one set of files per part, parts in ascending doc_id
order: ``*.ids`` ids as flat little-endian unsigned integers (16 bit if the
vocabulary fits, else 32), ``*.doc`` doc_ids (int64), ``*.off`` n+1 document
offsets (int64, counted from the first id of the whole corpus). ``parts`` is
a Parquet manifest: part, file, n_docs, n_tokens, base.

Rows are range-partitioned and sorted by doc_id; each task streams its part
to files named by its attempt and reports them in one row, so a repeated or
lost attempt leaves files that no manifest names. A part's base is the
prefix sum of the parts before it (one row per part); a second small pass
turns each part's counts into global offsets. Readers map the files.

Words are split at ASCII white space and each distinct word is encoded once
per memo: the tokenizer's normaliser and pre-tokeniser never look across
white space (``tests/llm`` holds it against whole-text encoding). For a
tokenizer with the rules of ``CUT_RULES``, Latin-1 texts are cut straight into
its pieces, each of which the library encodes once per memo.

Cases: null text is empty and has only the end id; null doc_ids come first
and are kept (as the smallest int64 in the file); repeated rows each have
their own entry, ties in the order of their text; an empty table gives a
folder without ids and an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rainrisk.session import scratch_path

from .common import materialise, table
from .files import make_dir, mapped, writer

NULL_ID = np.iinfo(np.int64).min
MEMO = 600_000  # pieces a worker remembers (speed only)
#: Normaliser and pattern whose pieces are cut here (fixed value, as the file states them).
CUT_RULES = json.dumps([
    {'type': 'Sequence', 'normalizers': [{'type': 'NFC'}, {'type': 'Replace', 'pattern': {'Regex': '\\s+'}, 'content': ' '}, {'type': 'Lowercase'}]},
    {'Regex': "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}])
MANIFEST = "part int, file string, n_docs long, n_tokens long"


#: Texts of these characters (visible Latin-1 and ASCII white space) are cut
#: into the pre-tokeniser's pieces here, so that "word," and "(word" share "word".
_PLAIN = re.compile(r"[\x09-\x0d\x20-\x7e\xa1-\xac\xae-\xff]*")
_L, _N = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\x09-\x0d {_L}{_N}]+")


class WordEncoder(dict):
    """piece or word -> packed ids: the first MEMO distinct ones stay, the
    others are kept for their batch."""

    def __init__(self, tokenizer: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(tokenizer)
        self.dtype = "<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4"
        self.rest: dict[str | bytes, bytes] = {}
        # cutting pieces here is right only for this normaliser and pre-tokeniser
        rules = json.loads(self.tok.to_str())
        parts = (rules["pre_tokenizer"] or {}).get("pretokenizers")
        self.cut = bool(parts) and json.dumps([rules["normalizer"], parts[0].get("pattern")]) == CUT_RULES

    def __missing__(self, key: str | bytes) -> bytes:
        return self.rest[key]

    def _split(self, text: str) -> list[str] | list[bytes]:
        """Pieces (str) of a plain text, else its words (bytes) between ASCII white space."""
        if self.cut and "<|" not in text and _PLAIN.fullmatch(text):
            return _PIECES.findall(text.lower())
        return text.encode("utf-8").split()

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self._split(t) for t in texts]
        new = [p for p in set().union(*split) if p not in self]
        done = self.tok.encode_batch_fast([p if isinstance(p, str) else p.decode("utf-8") for p in new], add_special_tokens=False)
        self.rest = {p: array(self.code, e.ids).tobytes() for p, e in zip(new, done)}
        room = MEMO - len(self)
        if room > 0:
            self.update(islice(((p, x) for p, x in self.rest.items() if len(p) <= 64), room))
        out = [b"".join(map(self.__getitem__, s)) for s in split]
        self.rest = {}
        return out

    @property
    def code(self) -> str:
        return "H" if self.dtype == "<u2" else "I"


_encoders: dict[str, WordEncoder] = {}


def encoder(tokenizer: str) -> WordEncoder:
    if tokenizer not in _encoders:
        _encoders[tokenizer] = WordEncoder(tokenizer)
    return _encoders[tokenizer]


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Encode ``docs (doc_id, text)`` into ``folder``; returns the manifest."""
    make_dir(folder)

    def write(batches):
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        ctx = TaskContext.get()
        stem = f"{folder}/part-{ctx.partitionId():06d}-{ctx.taskAttemptId()}"
        width, docs, counts = int(enc.dtype[-1]), [], []
        with writer(f"{stem}.ids") as out:
            for b in batches:
                docs.append(b.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype("<i8"))
                for i in range(0, b.num_rows, 512):
                    packed = enc.encode(b.column(1).slice(i, 512).fill_null("").to_pylist())
                    counts += [len(x) // width + 1 for x in packed]
                    out.write(end.join(packed) + end)
        with writer(f"{stem}.doc") as out:
            out.write(np.concatenate(docs).tobytes() if docs else b"")
        with writer(f"{stem}.cnt") as out:
            out.write(np.array(counts, "<i8").tobytes())
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([ctx.partitionId()], pa.int32()), "file": [stem], "n_docs": [len(counts)],
            "n_tokens": [int(sum(counts))]})

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    parts = materialise(ordered.mapInArrow(write, MANIFEST).where("n_docs > 0"), "token-parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    based = parts.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))

    def place(batches):
        for b in batches:
            for r in b.to_pylist():
                off = r["base"] + np.concatenate([[0], np.cumsum(mapped(f"{r['file']}.cnt", "<i8"))])
                with writer(f"{r['file']}.off") as out:
                    out.write(off.astype("<i8").tobytes())
            yield b

    n = max(1, parts.count())
    return materialise(based.repartition(n, "part").mapInArrow(place, based.schema), "token-manifest")


def read_tokens(manifest: DataFrame, dtype: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files; ids as little-endian
    uint32 bytes. One task per part, files memory-mapped."""

    def read(batches):
        for b in batches:
            for f in b.column(b.schema.get_field_index("file")).to_pylist():
                ids, docs, off = mapped(f"{f}.ids", dtype), mapped(f"{f}.doc", "<i8"), mapped(f"{f}.off", "<i8")
                for i in range(0, len(docs), 512):
                    o = np.array(off[i:i + 513])
                    d = np.array(docs[i:i + 512])
                    rows = np.array(ids[o[0] - off[0]:o[-1] - off[0]]).astype("<u4").tobytes()
                    cut = (o - o[0]) * 4
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(d, mask=d == NULL_ID), pa.array(o[:-1]), pa.array(np.diff(o)),
                         pa.array([rows[s:e] for s, e in zip(cut[:-1], cut[1:])], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])

    n = max(1, manifest.count())
    return manifest.select("part", "file").repartition(n, "part").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids binary")


def token_files(spark: SparkSession, docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    folder = folder or scratch_path(spark, "token-files")
    manifest = write_tokens(docs, folder, tokenizer)
    return read_tokens(manifest, encoder(tokenizer).dtype)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P
    rows = token_files(spark, table(spark, sf_dir, "documents"), P.path("word_bpe_49k.json"))
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
