"""Flat raw files ``<Region>_<yyyy>.parquet`` → bronze rows, file by file
rules over one scan (S1, S2, S5, P2–P4, P10, Q4).

The rules of a raw file are its own: header names are trimmed per file, the
region is the file's second-last column when it has no ``mesorregiao_id``,
and a day column may hold text in one file and numbers in another. A Python
data source therefore reads all files as one table: footers (read in tasks,
one small row per file) give each file's header; partitions are runs of (file,
row group) of about ``PART_BYTES``; every cell arrives as text under its
standard name. 330 files in 330 layouts are one scan.

Only files directly in the folder count, whatever legal name they have. A file
is refused whole, before anything is replaced, when it cannot be opened, when a
row group cannot be read to the end or gives fewer rows than its footer
promises, when a mandatory column is missing, or when its name holds no year
(replacing a partition needs a year the file vouches for). Of several files
that hold one (region, year) with rows of that year, the one written last counts (equal
times: the last name); a file that counts for none of its regions is ``superseded``.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rainrisk.functions.parse import pt_month_start, year_in_file_name, year_in_text
from rainrisk.operators import quality as Q
from rainrisk.session import scratch_path
from rainrisk.sources import daily

STATUS_MISSING_COLUMNS = "missing_columns"
STATUS_DAMAGED = "damaged"
#: A file with one of these goes nowhere; one that is only inconsistent loads the rows of its own year.
REFUSED = (Q.STATUS_UNREADABLE, STATUS_DAMAGED, STATUS_MISSING_COLUMNS, Q.STATUS_NO_NAME_YEAR)
PART_BYTES = 32 << 20  # of a scan's partition, as stored
FORMAT = "rainrisk_raw_wide"
NO_REGION = -1         # stands for an unknown region in the ranking of files
ABSENT = "\0"          # a day's cell where the file has no such column: it gives no reading


def _opener():
    """A function that opens a path of a listing; workers need no module of ours."""
    def open_(path: str):
        import re
        from urllib.parse import quote

        from pyarrow import fs
        plain = re.sub(r"^file:/+", "/", path)
        if plain.startswith("/"):
            return fs.LocalFileSystem().open_input_file(plain)
        scheme, rest = path.split("://", 1)
        f, p = fs.FileSystem.from_uri(f"{scheme}://{quote(rest, safe='/:@')}")
        return f.open_input_file(p)
    return open_


def footers(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """One row per file directly in ``path``: path, written (milliseconds),
    names (JSON, in file order) and groups (JSON: bytes and rows of each row
    group), NULL when the footer cannot be read."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = fs.makeQualified(p).toString().rstrip("/")
    literal = re.sub(r"([\\\[\]{}*?])", r"\\\1", path)  # the folder's name is no pattern
    # a recursive lookup infers no partitions from sub-folders; their files are left out here
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(literal)
              .where(F.regexp_replace("path", "/[^/]*$", "") == F.lit(base))
              .select("path", F.unix_millis("modificationTime").alias("written")))
    open_ = _opener()

    def read(batches):
        import pyarrow.parquet as pq
        for b in batches:
            names, groups = [], []
            for path in b.column(0).to_pylist():
                try:
                    with open_(path) as f:
                        file = pq.ParquetFile(f)
                        sizes = [(file.metadata.row_group(i).total_byte_size, file.metadata.row_group(i).num_rows)
                                 for i in range(file.metadata.num_row_groups)]
                        names.append(json.dumps(file.schema_arrow.names))
                        groups.append(json.dumps(sizes))
                except (OSError, pa.ArrowException):
                    names.append(None)
                    groups.append(None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string()), pa.array(groups, pa.string())],
                                             names=["path", "written", "names", "groups"])

    return listed.mapInArrow(read, "path string, written long, names string, groups string")


def header(names: list[str]) -> dict[str, int] | None:
    """Standard name → position in the file; None without a mandatory
    column. Of names that are equal when trimmed, the first counts."""
    trimmed = [n.strip() for n in names]
    if any(c not in trimmed for c in daily.MANDATORY):
        return None
    known = [*daily.MANDATORY, daily.YEAR_TAG, *daily.DAY_COLUMNS]
    at = {c: trimmed.index(c) for c in known if c in trimmed}
    at[daily.REGION] = trimmed.index(daily.REGION) if daily.REGION in trimmed else len(trimmed) - 2
    return at


def _source(parts: list, columns: list[str], every: bool):
    """A data source over ``parts``, lists of (path, row group, rows promised,
    {standard name: position}). It gives ``_file``, ``_broken`` (one row where a
    row group cannot be read) and ``columns`` as text; with ``every`` each
    column of the file is decoded. Defined here so that it is sent by value."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
    open_, days, absent = _opener(), set(daily.DAY_COLUMNS), ABSENT
    ddl = "_file string, _broken boolean, " + ", ".join(f"`{c}` string" for c in columns)

    class Part(InputPartition):
        def __init__(self, items):
            super().__init__(None)
            self.items = items

    class Reader(DataSourceReader):
        def partitions(self):
            return [Part(p) for p in parts]

        def read(self, partition):
            import pyarrow as pa
            import pyarrow.parquet as pq

            def text(col):
                if pa.types.is_dictionary(col.type):
                    col = col.dictionary_decode()
                try:
                    return col.cast(pa.string())
                except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
                    return pa.array([None if x is None else str(x) for x in col.to_pylist()], pa.string())

            def batch(path, broken, cells, n):
                return pa.RecordBatch.from_arrays(
                    [pa.array([path] * n, pa.string()), pa.array([broken] * n),
                     *[cells[c] if c in cells else pa.array([absent] * n) if c in days else pa.nulls(n, pa.string()) for c in columns]],
                    names=["_file", "_broken", *columns])

            for path, group, promised, at in partition.items if partition else ():  # no file: Spark passes None
                got = 0
                try:
                    with open_(path) as f:
                        file = pq.ParquetFile(f)
                        names = file.schema_arrow.names
                        wanted = {c: names[i] for c, i in at.items() if c in columns}
                        plain = not every and len(set(names)) == len(names) and not any("." in n for n in wanted.values())
                        for b in file.iter_batches(4096, row_groups=[group], columns=list(wanted.values()) if plain else None):
                            order = b.schema.names if plain else names
                            cells = {c: text(b.column(order.index(n))) for c, n in wanted.items()}
                            got += b.num_rows
                            yield batch(path, False, cells, b.num_rows)
                    if got != promised:
                        yield batch(path, True, {}, 1)
                except (OSError, pa.ArrowException):
                    yield batch(path, True, {}, 1)

    class RawWide(DataSource):
        @classmethod
        def name(cls):
            return FORMAT

        def schema(self):
            return ddl

        def reader(self, schema):
            return Reader()

    return RawWide


class RawFiles:
    """The files directly in ``path``: ``report()`` judges them, ``rows()``
    gives the long rows of the files that the report accepts."""

    def __init__(self, spark: SparkSession, path: str, glob: str = "*.parquet"):
        self.spark = spark
        # the driver holds one row per file, as Spark's own listing does
        self.found = sorted(footers(spark, path, glob).collect(), key=lambda r: r["path"])
        self.headers = {r["path"]: header(json.loads(r["names"])) for r in self.found if r["names"] is not None}

    def scan(self, files: set[str] | None, columns: list[str], every: bool = False) -> DataFrame:
        """One scan of ``files`` (None: all with a usable header)."""
        items = [(r["path"], i, rows, self.headers[r["path"]], size) for r in self.found
                 if self.headers.get(r["path"]) and (files is None or r["path"] in files)
                 for i, (size, rows) in enumerate(json.loads(r["groups"]))]
        share = max(1, sum(x[4] for x in items) // (2 * self.spark.sparkContext.defaultParallelism))
        parts, held = [], 0
        for *item, size in items:
            if not parts or held + size > min(PART_BYTES, share):
                parts.append([])
                held = 0
            parts[-1].append(tuple(item))
            held += size
        self.spark.dataSource.register(_source(parts, columns, every))
        return self.spark.read.format(FORMAT).load()

    def _seen(self) -> DataFrame:
        """Per file and region: rows read, whether a part is broken, years found."""
        raw = self.scan(None, [daily.COL_MONTH_YEAR, daily.REGION, daily.YEAR_TAG], every=True)
        tagged = F.col("_file").isin([p for p, h in self.headers.items() if h and daily.YEAR_TAG in h])
        year = F.when(tagged, F.col(daily.YEAR_TAG).try_cast("double").cast("bigint")) \
            .otherwise(year_in_text(F.col(daily.COL_MONTH_YEAR)))
        region = F.coalesce(F.col(daily.REGION).try_cast("double").cast("int"), F.lit(NO_REGION))
        own = F.year(pt_month_start(F.col(daily.COL_MONTH_YEAR))) == year_in_file_name(F.col("_file"))
        return raw.select("_file", "_broken", year.alias("_y"), own.alias("_own"), F.when(~F.col("_broken"), region).alias("region")) \
            .groupBy("_file", "region").agg(F.count_if(~F.col("_broken")).alias("n_rows"), F.max("_broken").alias("broken"), F.min("_y").alias("year_min"),
                                            F.max("_y").alias("year_max"), F.count_if("_own").alias("own"))

    def report(self) -> DataFrame:
        """One row per file: _file, status, expected_year, n_rows, year_min,
        year_max, regions (those it counts for), n_regions (those
        it has rows of its year for)."""
        known = [(r["path"], r["written"], None if r["names"] is None else self.headers[r["path"]] is not None) for r in self.found]
        files = self.spark.createDataFrame(known, "_file string, written long, usable boolean") \
            .withColumn("expected_year", year_in_file_name(F.col("_file")))
        path = scratch_path(self.spark, "raw-seen")  # a row per file and region; read twice below
        self._seen().write.parquet(path)
        seen = self.spark.read.schema("_file string, region int, n_rows long, broken boolean, year_min long, year_max long, own long").parquet(path)
        per = seen.groupBy("_file").agg(F.sum("n_rows").alias("n_rows"), F.max("broken").alias("broken"), F.min("year_min").alias("year_min"),
                                        F.max("year_max").alias("year_max"), F.collect_list(F.when(F.col("own") > 0, F.col("region"))).alias("held"))
        j = files.join(per, "_file", "left").withColumn("n", F.when(F.col("usable"), F.coalesce("n_rows", F.lit(0))))
        status = (F.when(F.col("usable").isNull(), Q.STATUS_UNREADABLE)
                  .when(~F.col("usable"), STATUS_MISSING_COLUMNS)
                  .when(F.col("broken"), STATUS_DAMAGED)
                  .when(F.col("n") == 0, Q.STATUS_UNREADABLE)
                  .when(F.col("expected_year").isNull(), Q.STATUS_NO_NAME_YEAR)
                  .when(F.col("year_min").isNull(), Q.STATUS_NO_VALUES)
                  .when((F.col("year_min") != F.col("year_max")) | (F.col("year_min") != F.col("expected_year")),
                        Q.STATUS_INCONSISTENT).otherwise(Q.STATUS_OK))
        j = j.withColumn("status", status)
        good = ~F.col("status").isin(*REFUSED)
        last = Window.partitionBy("region", "expected_year").orderBy(F.desc("written"), F.desc("_file"))  # files of one unit
        won = j.where(good).select("_file", "written", "expected_year", F.explode("held").alias("region")) \
            .withColumn("place", F.row_number().over(last)).where("place = 1") \
            .groupBy("_file").agg(F.sort_array(F.collect_list("region")).alias("regions"))
        out = j.join(won, "_file", "left")
        late = good & F.col("regions").isNull() & (F.size("held") > 0)
        return out.select("_file", F.when(late, Q.STATUS_SUPERSEDED).otherwise(F.col("status")).alias("status"), "expected_year",
                          F.col("n").alias("n_rows"), "year_min", "year_max", "regions", F.size("held").alias("n_regions"))

    def rows(self, report: DataFrame) -> DataFrame:
        """Bronze rows of the accepted files, each for the regions it counts for."""
        taken = report.where("regions is not null").select("_file", "regions", "n_regions").collect()  # a row per file
        if not taken:
            return self.spark.createDataFrame([], daily.bronze_schema()).select(*daily.BRONZE_COLUMNS)
        days = [c for c in daily.DAY_COLUMNS if any(c in self.headers[r["_file"]] for r in taken)]
        raw = self.scan({r["_file"] for r in taken}, [*daily.MANDATORY, daily.REGION, *days])
        raw = raw.withColumn(daily.REGION, F.col(daily.REGION).try_cast("double").cast("int")) \
            .withColumn(daily.EXPECTED_YEAR, year_in_file_name(F.col("_file")))
        partly = [(r["_file"], x) for r in taken if len(r["regions"]) < r["n_regions"] for x in r["regions"]]
        if partly:
            whole: Column = ~F.col("_file").isin([p for p, _ in partly])
            pairs = self.spark.createDataFrame(partly, "_pf string, _pr int")
            mine = (F.col("_file") == F.col("_pf")) & (F.coalesce(F.col(daily.REGION), F.lit(NO_REGION)) == F.col("_pr"))
            raw = raw.join(F.broadcast(pairs), mine, "left").where(whole | F.col("_pf").isNotNull()).drop("_pf", "_pr")
        short = any(c not in self.headers[r["_file"]] for r in taken for c in days)
        return daily.shape_daily(raw.drop("_file", "_broken"), absent=ABSENT if short else None)
