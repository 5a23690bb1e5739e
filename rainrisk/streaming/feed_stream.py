"""The 15-minute feed as two Structured Streaming jobs.

T1 lands new payload files as typed rows in Parquet partitioned by the
*ingestion* date (``ano=/mes=/dia=``) and the micro-batch (``lote=``). One
stream with one checkpoint reads each file once and deals its rows: readings to
the landing, what cannot land (files that are no JSON, readings without a valid
timestamp or nested object) to a side folder with its reason, file and text. A
batch that runs again after a failure overwrites its own ``lote`` in both, so
they agree and hold each file once; the ingestion time is the batch's own, which
a replay keeps.

T2 keeps the latest reading per station current: a streaming aggregate whose
state is one row per station (not per reading), in update mode: a trigger brings
only stations with a newer reading. They are merged into a snapshot dealt to
buckets by station; only buckets with a changed station are read and rewritten.
Merging the same rows again changes nothing, so a replayed trigger is harmless.
A late or out-of-order file lands in a later ingestion partition and still ranks
by ``data_hora``, so arrival order does not matter.

Checkpoints live in the shared checkpoint folder, so a restarted driver or a
lost executor resumes from the last committed batch. T2's state is one row
per station, so it stays small; a large deployment would still pick the
RocksDB state store provider.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainrisk.functions.text import upper_trim
from rainrisk.operators.stations import latest_per_station
from rainrisk.session import scratch_path
from rainrisk.sources.feed import (
    CORRUPT,
    LANDED_SCHEMA,
    PAYLOAD_OR_CORRUPT,
    REJECT_SCHEMA,
    TOP_FIELDS,
    reject_reason,
    typed_feed,
    with_ingest_partitions,
)
from rainrisk.sources.sinks import path_exists

BUCKETS = 16  # shares of T2's snapshot

# the reference polls every 15 minutes
FEED_INTERVAL = "15 minutes"


def _trigger(writer, available_now: bool, interval: str = FEED_INTERVAL):
    return writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime=interval)


def _payload_stream(spark: SparkSession, payload_dir: str, json_array: bool,
                    max_files_per_trigger: int | None) -> DataFrame:
    reader = (spark.readStream.schema(PAYLOAD_OR_CORRUPT).option("multiLine", json_array)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(payload_dir).select("*", F.col("_metadata.file_path").alias("arquivo"))


def _replace(rows: DataFrame, path: str, *keys: str) -> None:
    """Write ``rows`` over the partitions they fall into; others stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def land_feed(spark: SparkSession, payload_dir: str, landed_dir: str, checkpoint: str,
              rejects_dir: str | None = None, json_array: bool = True, available_now: bool = True,
              max_files_per_trigger: int | None = None, interval: str = FEED_INTERVAL):
    """T1 + S8: payload files → typed rows → Parquet under ano=/mes=/dia=/lote=.

    What cannot land does not stall the feed: it goes to ``rejects_dir``
    (default: beside the landing) under ``lote=``. ``max_files_per_trigger``
    bounds a micro-batch when a backlog of files has piled up
    (``availableNow`` still drains all of it, in such batches).
    """
    side = rejects_dir or f"{landed_dir.rstrip('/')}-rejects"
    src = _payload_stream(spark, payload_dir, json_array, max_files_per_trigger) \
        .withColumn("ingestao_ts", F.current_timestamp())

    def deal(batch: DataFrame, epoch_id: int) -> None:
        rows = batch.withColumns({"motivo": reject_reason(), "lote": F.lit(epoch_id).cast("long")}).persist()  # read once
        try:
            good = typed_feed(rows.where("motivo is null"), ingest_ts=F.col("ingestao_ts"), strict=False)
            _replace(with_ingest_partitions(good).withColumn("lote", F.lit(epoch_id)), landed_dir, "ano", "mes", "dia", "lote")
            text = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*TOP_FIELDS)))
            bad = rows.where("motivo is not null").select("motivo", "arquivo", text.alias("registro"), "ingestao_ts", "lote")
            _replace(bad, side, "lote")
        finally:
            rows.unpersist()

    writer = src.writeStream.option("checkpointLocation", checkpoint).foreachBatch(deal)
    return _trigger(writer, available_now, interval).start()


def read_rejects(spark: SparkSession, rejects_dir: str) -> DataFrame:
    """What could not land: motivo, arquivo, registro (its text), ingestao_ts, lote."""
    return spark.read.schema(REJECT_SCHEMA).option("basePath", rejects_dir).parquet(rejects_dir)


def check_rejects(spark: SparkSession, rejects_dir: str, max_rejects: int | None = None) -> int:
    """How many readings and files could not land; more than ``max_rejects`` is an error."""
    n = read_rejects(spark, rejects_dir).count() if path_exists(spark, rejects_dir) else 0
    if max_rejects is not None and n > max_rejects:
        raise ValueError(f"{n} readings or files could not land, more than {max_rejects}")
    return n


def merge_snapshot(changed: DataFrame, snapshot_dir: str, buckets: int = BUCKETS) -> None:
    """Put ``changed`` (one row per station) into the snapshot: only the
    buckets that hold one of these stations are read and rewritten. The number
    of buckets is the snapshot's own once it exists."""
    spark = changed.sparkSession
    named = f"{snapshot_dir.rstrip('/')}/_BUCKETS"
    if path_exists(spark, named):
        buckets = spark.read.schema("n int").parquet(named).first()[0]
    else:
        spark.range(1).select(F.lit(buckets).alias("n")).write.mode("overwrite").parquet(named)
    changed = changed.withColumn("balde", F.pmod(F.xxhash64("codigo_gmmc"), F.lit(buckets)).cast("int"))
    path = scratch_path(spark, "snapshot-merge")
    changed.write.partitionBy("balde").parquet(f"{path}/new")
    new = spark.read.schema(changed.schema).parquet(f"{path}/new")
    touched = [r[0] for r in new.select("balde").distinct().collect()]  # at most the number of buckets
    if not touched:
        return
    merged = new
    if any(path_exists(spark, f"{snapshot_dir.rstrip('/')}/balde={b}") for b in touched):
        old = spark.read.schema(changed.schema).parquet(snapshot_dir).where(F.col("balde").isin(touched))
        same = old["codigo_gmmc"].eqNullSafe(new["codigo_gmmc"]) & (old["balde"] == new["balde"])
        merged = old.join(new, same, "left_anti").unionByName(new)
    merged.write.parquet(f"{path}/merged")  # the snapshot is read here, and written below
    _replace(spark.read.schema(changed.schema).parquet(f"{path}/merged").repartition("balde"), snapshot_dir, "balde")


def latest_snapshot_stream(spark: SparkSession, landed_dir: str, snapshot_dir: str,
                           checkpoint: str, available_now: bool = True,
                           interval: str = FEED_INTERVAL, max_files_per_trigger: int | None = None,
                           buckets: int = BUCKETS):
    """Latest reading per station; a trigger rewrites the snapshot's
    buckets that hold a station with a newer reading."""
    reader = spark.readStream.schema(LANDED_SCHEMA).option("basePath", landed_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(landed_dir)
    latest = latest_per_station(src.withColumn("municipio_nome", upper_trim(F.col("cidade"))),
                                carry=["municipio_nome", "chuva"])
    writer = (latest.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
              .foreachBatch(lambda batch, epoch_id: merge_snapshot(batch, snapshot_dir, buckets)))
    return _trigger(writer, available_now, interval).start()


def run_available_now(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
