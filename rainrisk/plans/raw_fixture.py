"""Flat raw files written from the readings, one per (region, year), with the
irregularities that real landings have. ``kind = (region + year) % 9``:

0 plain · 1 day columns as numbers · 2 padded header names · 3 region under
another name, second to last · 4 without ``Posto`` · 5 no year in the file's
name · 6 filed under the next year (``ano_ref``) · 7 damaged part-way ·
8 ``ano_ref`` empty. Units of kind 0 have an older second file with other rain,
files of kind 3 names with brackets, blanks and per cent signs; one file is no
Parquet at all, and a sub-folder holds a file that does not count.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainrisk.sources import bindings as B
from rainrisk.sources import daily

KINDS = 9
REFUSED_KINDS = (4, 5, 7)
JUNK = "lixo_2000.parquet"
COPY = "copia"


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _overwrite(path: str, data: bytes, at: int | None = None) -> None:
    """Put ``data`` into a file of the shared folder (``at``: in place)."""
    from pyarrow import fs
    plain = re.sub(r"^file:/+", "/", path)
    f, p = (fs.LocalFileSystem(), plain) if plain.startswith("/") else fs.FileSystem.from_uri(path)
    if at is not None:
        with f.open_input_file(p) as src:
            old = src.read()
        data = old[:at] + data + old[at + len(data):]
    with f.open_output_stream(p) as out:
        out.write(data)


def _write_kind(spark: SparkSession, staged: str, folder: str, kind) -> None:
    days = daily.DAY_COLUMNS
    try:
        part = spark.read.parquet(f"{staged}/kind={0 if kind == COPY else kind}")
    except Exception as e:  # a kind that no (region, year) has
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return
    if kind == 1:
        number = [F.replace(F.trim(F.col(f"`{c}`")), F.lit(","), F.lit(".")).try_cast("double") for c in days]
        part = part.withColumns({c: F.when(F.isnan(n), None).otherwise(n) for c, n in zip(days, number)})
    elif kind == 2:
        part = part.withColumnsRenamed({daily.COL_CODE: " Código ", daily.COL_MONTH_YEAR: "Mês/Ano "})
    elif kind == 3:
        part = part.withColumnRenamed(daily.REGION, "regiao")
    elif kind == 4:
        part = part.drop("Posto ")
    elif kind == 6:
        part = part.withColumn(daily.YEAR_TAG, F.col(daily.YEAR_TAG) + 1)
    elif kind == 8:
        part = part.withColumn(daily.YEAR_TAG, F.lit(None).cast("int"))
    elif kind == COPY:
        part = part.withColumns({days[0]: F.lit("99,9"), "name": F.concat(F.lit(COPY), "name")})
    part.repartition("name").write.partitionBy("name").parquet(f"{folder}/laid/kind={kind}")


def write_raw_files(spark: SparkSession, readings: DataFrame, folder: str) -> None:
    """Write the files described above into ``folder`` (one per region and
    year of the readings, so their number follows the regions and years)."""
    wide = B.daily_wide(readings).where(F.col(daily.REGION).isNotNull())
    region, year = F.col(daily.REGION), F.col(daily.YEAR_TAG)
    kind = (region + year) % KINDS
    name = F.concat(region.cast("string"), F.when(kind == 5, "-").otherwise("_"), year.cast("string"))
    staged = f"{folder}/staged"  # as the rows come: each kind deals them out by file, once
    wide.withColumns({"kind": kind, "name": name}).write.partitionBy("kind").parquet(staged)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: _write_kind(spark, staged, folder, k), [*range(KINDS), COPY]))
    jvm, fs = _file_system(spark, folder)
    path = jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path(f"{folder}/raw"))
    for found in fs.globStatus(path(f"{folder}/laid/kind=*/name=*/*.parquet")):  # one per region and year
        parts = dict(x.split("=") for x in found.getPath().toString().split("/") if "=" in x)
        name = parts["name"].replace("_", "[1] 100%_") if parts["kind"] == "3" else parts["name"]
        to = f"{folder}/raw/{name}.parquet"
        fs.rename(found.getPath(), path(to))
        if parts["kind"] == COPY:
            fs.setTimes(path(to), found.getModificationTime() - 86_400_000, -1)
        crc = path(re.sub(r"([^/]+)$", r".\1.crc", to))
        if fs.exists(crc):
            fs.delete(crc, False)
        if parts["kind"] == "7":
            _overwrite(to, b"\xff" * 256, at=64)
    _overwrite(f"{folder}/raw/{JUNK}", b"not a parquet file")
    fs.mkdirs(path(f"{folder}/raw/antigos"))
    _overwrite(f"{folder}/raw/antigos/{JUNK}", b"not a parquet file")
