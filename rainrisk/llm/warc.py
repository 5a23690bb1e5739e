"""WARC as a PySpark data source, and archives with revisit records.

``WarcSource`` (format ``warc``) writes one file per task and lists the files
of the committed attempts, cut at record boundaries into splits of about
``split_bytes``, in ``_splits.json``; a folder without that list is read one
file per partition. The reader takes filters on ``record_type`` and on the
header columns, parses a record's headers first and seeks over the block of
a record that a filter refuses, or when the option ``payload`` is false.

``archive`` marks repeats: of records with equal payloads (SHA-1 and length)
of at least ``min_bytes``, that with the largest page_id is the response and
the others are revisits without a payload.

Cases: null html is an empty payload; a null url is the empty URI; null
page_ids are written as ``none`` and are never the referred page unless all
of a group are null (then all are responses); rows that repeat a page_id and
its payload are all responses if they are the largest; an empty table gives
an empty result; control characters in a url are percent-encoded; other
columns are not read.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In,
                                    InputPartition, IsNotNull, IsNull, WriterCommitMessage)

from rainrisk.session import scratch_path

from .common import table
from .files import make_dir, open_fs, reader, writer

SCHEMA = ("page_id long, url string, record_type string, refers_to long, payload_digest string, "
          "payload_bytes long, payload binary")
HEADER_COLUMNS = ("record_type", "page_id", "url", "refers_to", "payload_digest", "payload_bytes")
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPLITS = "_splits.json"
URN = "urn:page:"


def _uri(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url or "")


def _url(uri: str) -> str:
    return re.sub(r"%([01][0-9A-F]|20|7F|25)", lambda m: chr(int(m[1], 16)), uri)


def record(row: dict, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record; ``row`` has the columns of ``SCHEMA``, digest in hex."""
    http = HTTP % row["payload_bytes"]
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + row["payload"]
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    ident = "none" if row["page_id"] is None else row["page_id"]
    head = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{URN}{ident}>", f"WARC-Date: {date}",
            f"WARC-Target-URI: {_uri(row['url'])}", f"WARC-Payload-Digest: sha1:{digest}",
            f"X-Payload-Length: {row['payload_bytes']}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{URN}{row['refers_to']}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8") + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    file: str
    cuts: list


@dataclass
class Split(InputPartition):
    file: str
    start: int
    end: int | None


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.folder = options["path"]
        self.split = int(options.get("split_bytes", 16 << 20))
        self.packed = options.get("packed", "false") == "true"

    def write(self, iterator):
        ctx = TaskContext.get()
        file = f"{self.folder}/part-{ctx.partitionId():06d}-{ctx.taskAttemptId()}.warc"
        cuts, at = [0], 0
        with writer(file) as out:
            for batch in iterator:
                for i in range(0, batch.num_rows, 64):
                    for row in batch.slice(i, 64).to_pylist():
                        if self.packed and row["payload"] is not None:
                            row["payload"] = zlib.decompress(row["payload"])
                        data = record(row)
                        if at - cuts[-1] >= self.split:
                            cuts.append(at)
                        out.write(data)
                        at += len(data)
        return Written(file, [*cuts, at] if at > cuts[-1] else cuts)

    def commit(self, messages):
        parts = [(m.file, s, e) for m in messages if m is not None for s, e in zip(m.cuts, m.cuts[1:])]
        with writer(f"{self.folder}/{SPLITS}") as out:
            out.write(json.dumps(sorted(parts)).encode())

    def abort(self, messages):
        for m in messages:
            if m is not None:
                f, p = open_fs(m.file)
                f.delete_file(p)


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.folder = options["path"]
        self.payload = options.get("payload", "true") == "true"
        self.tests: list[tuple[str, object]] = []

    def pushFilters(self, filters):
        """Keep tests on header columns; hand the others back to Spark."""
        for f in filters:
            col = f.attribute[0] if len(f.attribute) == 1 else None
            if col in HEADER_COLUMNS and isinstance(f, EqualTo):
                self.tests.append((col, frozenset([f.value])))
            elif col in HEADER_COLUMNS and isinstance(f, In):
                self.tests.append((col, frozenset(f.value)))
            elif col in HEADER_COLUMNS and isinstance(f, (IsNull, IsNotNull)):
                self.tests.append((col, isinstance(f, IsNull)))
            else:
                yield f

    def partitions(self):
        f, p = open_fs(self.folder)
        if f.get_file_info(f"{p}/{SPLITS}").type == pafs.FileType.File:
            with f.open_input_file(f"{p}/{SPLITS}") as src:
                return [Split(*x) for x in json.loads(src.read())]
        files = f.get_file_info(pafs.FileSelector(p))
        prefix = self.folder[:-len(p)] if self.folder.endswith(p) else ""
        return [Split(prefix + x.path, 0, None) for x in sorted(files, key=lambda x: x.path) if x.path.endswith(".warc")]

    def wanted(self, row: dict) -> bool:
        for col, test in self.tests:
            v = row[col]
            if (v is None) != test if isinstance(test, bool) else v is None or v not in test:
                return False
        return True

    def read(self, partition):
        if partition is None:  # Spark's stand-in where there is nothing to read
            return
        rows, held = [], 0
        with reader(partition.file) as raw:
            at, end = partition.start, partition.end if partition.end is not None else raw.size()
            buf, base = b"", at  # bytes read ahead, from file position ``base``
            while at < end:
                cut = -1
                while (cut := buf.find(b"\r\n\r\n", at - base)) < 0:
                    raw.seek(base + len(buf))
                    more = raw.read(min(1 << 18, max(1, end - base - len(buf))))
                    if not more:
                        raise ValueError(f"{partition.file}: headers end early at {at}")
                    buf, base = buf[at - base:] + more, at
                head, row, size = buf[at - base:cut].decode("utf-8"), dict.fromkeys(HEADER_COLUMNS), 0
                for line in head.split("\r\n")[1:]:
                    k, _, v = line.partition(":")
                    k, v = k.lower(), v.strip()
                    if k == "content-length":
                        size = int(v)
                    elif k == "warc-type":
                        row["record_type"] = v
                    elif k == "warc-record-id":
                        row["page_id"] = _page(v)
                    elif k == "warc-refers-to":
                        row["refers_to"] = _page(v)
                    elif k == "warc-target-uri":
                        row["url"] = _url(v)
                    elif k == "warc-payload-digest":
                        row["payload_digest"] = base64.b32decode(v.partition(":")[2]).hex()
                    elif k == "x-payload-length":
                        row["payload_bytes"] = int(v)
                block = base + cut + 4
                at = block + size + 4
                if self.wanted(row):
                    row["payload"] = None
                    if self.payload and row["record_type"] != "revisit":
                        if block + size > base + len(buf):
                            raw.seek(block)
                            data = raw.read(size)
                        else:
                            data = buf[block - base:block - base + size]
                        row["payload"] = data.partition(b"\r\n\r\n")[2]
                        held += size
                    rows.append(row)
                if at >= base + len(buf):  # the block was not read, or its rest was fetched: go on behind it
                    buf, base = b"", at
                if len(rows) >= 1000 or held >= 8 << 20:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)


def _page(v: str) -> int | None:
    m = re.search(r":(-?\d+)>?$", v)
    return int(m[1]) if m else None


_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                    ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                    ("payload", pa.binary())])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def pack(df: DataFrame, col: str = "payload") -> DataFrame:
    """``col`` deflated, so that a shuffle of payloads moves a fraction."""

    def run(batches):
        for b in batches:
            i = b.schema.get_field_index(col)
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                out = pa.array([zlib.compress(x.as_py(), 6) if x.is_valid else None for x in part.column(i)], pa.binary())
                yield part.set_column(i, b.schema.field(i), out)

    return df.mapInArrow(run, df.schema)


def archive(pages: DataFrame, folder: str, min_bytes: int = 1000) -> None:
    """Write ``pages (page_id, url, html)`` as WARC files into ``folder``."""
    spark = pages.sparkSession
    spark.dataSource.register(WarcSource)
    make_dir(folder)
    html = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha1("payload")) \
        .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    groups = rows.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes").agg(
        F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1") \
        .select(F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("b"), "last")
    j = pack(rows).join(groups, (F.col("payload_digest") == F.col("d")) & (F.col("payload_bytes") == F.col("b")), "left")
    revisit = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    out = j.select("page_id", "url", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                   F.when(revisit, F.col("last")).alias("refers_to"), "payload_digest", "payload_bytes",
                   F.when(~revisit, F.col("payload")).alias("payload"))
    out.write.format("warc").option("packed", "true").mode("append").save(folder)


def read_archive(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """Records of a folder; a filter on a header column reaches the reader."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("payload", str(payload).lower()).load(folder)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    archive(table(spark, sf_dir, "pages"), folder)
    # two reads, each filter with the reader: responses with their blocks, of revisits the headers only
    response = read_archive(spark, folder).where("record_type = 'response'").select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
        "record_type", "refers_to")
    revisit = read_archive(spark, folder, payload=False).where("record_type = 'revisit'")
    return response.unionByName(revisit.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(encode(coalesce(html, ''))) AS payload_digest,
                  CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages),
g AS (SELECT payload_digest, payload_bytes, max(page_id) AS last FROM p WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN last IS NULL OR page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN last IS NULL OR page_id IS NOT DISTINCT FROM last THEN NULL ELSE last END AS refers_to
FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest AND p.payload_bytes = g.payload_bytes
"""
