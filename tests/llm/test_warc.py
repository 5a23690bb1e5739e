"""WARC data source: round trip, revisits, pushdown, splits."""
import hashlib

from pyspark.sql import functions as F

from rainrisk.llm import warc as W

BIG = "<html>" + "é" * 800 + "</html>"
ROWS = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, None, BIG), (4, "http://a/ä b\r\nX: y", "small"), (5, "u", "small"),
        (6, "u", None), (7, "u", ""), (8, "u", "x" * 1000), (9, "u", "x" * 999), (10, "u", "x" * 999), (8, "u", "x" * 1000),
        (None, "u", "x" * 1000), (11, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 50), (12, "u", "y" * 3_000_000)]


def _pages(spark):
    return spark.createDataFrame([(i, u, h, "z") for i, u, h in ROWS], "page_id long, url string, html string, record_type string").repartition(3)


def test_round_trip_and_revisits(spark, scratch):
    folder = scratch("warc")
    W.archive(_pages(spark), folder)
    got = W.read_archive(spark, folder).collect()
    want = []
    for i, u, h in ROWS:
        p = (h or "").encode()
        same = [j for j, _, g in ROWS if (g or "").encode() == p and len(p) >= 1000 and j is not None]
        last = max(same, default=None)
        kind = "revisit" if last is not None and i != last and len(p) >= 1000 else "response"
        want.append((i, u or "", kind, last if kind == "revisit" else None, hashlib.sha1(p).hexdigest(), len(p),
                     None if kind == "revisit" else p))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted([(*tuple(r)[:6], None if r["payload"] is None else bytes(r["payload"])) for r in got], key=key) == sorted(want, key=key)


def test_filters_reach_the_reader_and_payloads_are_skipped(spark, scratch):
    folder = scratch("warc")
    W.archive(_pages(spark), folder)
    rows = W.read_archive(spark, folder)
    want = {r["page_id"] for r in rows.collect() if r["record_type"] == "revisit"}
    assert {r["page_id"] for r in rows.where("record_type = 'revisit'").collect()} == want
    reader = W.WarcReader({"path": folder})
    from pyspark.sql.datasource import EqualTo, GreaterThan
    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), GreaterThan(("payload_bytes",), 5), EqualTo(("page_id",), 12)]))
    assert left == [GreaterThan(("payload_bytes",), 5)]  # the others are the reader's
    got = [r for s in reader.partitions() for b in reader.read(s) for r in b.to_pylist()]
    assert [r["page_id"] for r in got] == [12] and len(got[0]["payload"]) == 3_000_000
    assert all(r["payload"] is None for r in W.read_archive(spark, folder, payload=False).collect())
    assert rows.where(F.col("page_id").isNull()).count() == 1


def test_splits_at_record_boundaries(spark, scratch):
    folder = scratch("warc")
    spark.dataSource.register(W.WarcSource)
    W.make_dir(folder)
    html = F.encode(F.lit("p" * 500), "UTF-8")
    df = spark.range(0, 400, 1, 2).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.lit("response").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"), F.sha1(html).alias("payload_digest"), F.lit(500).cast("long").alias("payload_bytes"),
        html.alias("payload"))
    df.write.format("warc").option("split_bytes", "20000").mode("append").save(folder)
    assert len(W.WarcReader({"path": folder}).partitions()) > 8
    back = W.read_archive(spark, folder)
    assert back.count() == 400 and back.select("page_id").distinct().count() == 400


def test_empty_table(spark, scratch):
    folder = scratch("warc")
    W.archive(_pages(spark).limit(0), folder)
    assert W.read_archive(spark, folder).collect() == []
