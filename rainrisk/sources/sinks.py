"""Table sinks and views.

Tables are Parquet paths (or catalog tables when a name is given) in the
shared storage the cluster names; every write goes through Spark's commit
protocol, so a lost executor's task is retried without leaving partial
files behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS``."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet table (or marker) exists at ``path`` (lists files only)."""
    from pyspark.errors import AnalysisException
    try:
        spark.read.parquet(path).schema  # noqa: B018 - resolving lists the path
        return True
    except AnalysisException:
        return False


def partition_files(spark: SparkSession, path: str, key: str = "ano") -> DataFrame:
    """(key, path, length, written) of a partitioned table's files, from the
    listing alone (no content is read)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", True).load(path))
    year = F.regexp_extract("path", f"/{key}=([^/]+)/", 1).try_cast("int")
    return files.select(year.alias(key), "path", "length", F.col("modificationTime").alias("written"))


def rebalanced(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` dealt out by ``cols`` for a partitioned write: AQE sizes the
    partitions by bytes, so small directories get one file each and a hot
    directory is split over several writers, whatever the number of shuffle
    partitions."""
    names = ", ".join(f"`{c}`" for c in cols)
    hint = f"REBALANCE({names})" if cols else "REBALANCE"
    return df.sparkSession.sql(f"SELECT /*+ {hint} */ * FROM {{df}}", df=df)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType | str,
                 partition_by: list[str] | None = None) -> None:
    """Create an empty table with the given schema if none exists yet."""
    if path_exists(spark, path):
        return
    empty = spark.createDataFrame([], schema)
    w = empty.write.mode("ignore")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def rebuild_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Full rebuild of a table from a query (overwrite)."""
    if partition_by:
        df = rebalanced(df, *partition_by)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a frame (e.g. all landed files) under a view name."""
    df.createOrReplaceTempView(name)
    return df


def rows_per_file(df: DataFrame) -> DataFrame:
    """Row count per source file (from the file metadata column)."""
    return (df.select(F.col("_metadata.file_path").alias("file_path"))
            .groupBy("file_path").agg(F.count(F.lit(1)).alias("n_rows")))


def save_bucketed(df: DataFrame, table: str, path: str, bucket_col: str, buckets: int,
                  sort_by: list[str] | None = None,
                  partition_by: list[str] | None = None) -> DataFrame:
    """Store ``df`` as an external table bucketed (and sorted) on ``bucket_col``.

    Readers that group, window or join on ``bucket_col`` then get Spark's
    bucketed scan: each task reads one bucket and the data is already hash
    partitioned on the key, so those operators need no shuffle. Used for
    the bronze fact (bucketed by station, sorted by date) so the silver
    windows run without moving the fact at all.
    """
    w = df.write.mode("overwrite").option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.bucketBy(buckets, bucket_col)
    if sort_by:
        w = w.sortBy(*sort_by)
    w.saveAsTable(table)
    return df.sparkSession.table(table)
