"""Session and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a fresh session gets when this package builds it (tests, bench).
# A cluster session keeps its own values; nothing here is forced on it.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "rainrisk", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _conf_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        cp = spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        cp = None
    if cp:
        return cp
    try:
        return spark.conf.get("spark.checkpoint.dir", None)
    except Exception:
        return None


def local_scratch_allowed(master: str) -> bool:
    """A machine-local scratch folder is only seen by a single-machine session."""
    if master == "local" or master.startswith("local["):
        return True
    raise RuntimeError(f"spark.checkpoint.dir is not set and master is {master!r}: name a folder that the "
                       "driver and all executors share")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when a local session (tests) has none do we set a fresh one; on a
    cluster a missing setting is an error.
    """
    cp = _conf_checkpoint_dir(spark)
    if cp:
        return cp
    local_scratch_allowed(spark.sparkContext.master)
    cp = tempfile.mkdtemp(prefix="rainrisk-cp-")
    spark.sparkContext.setCheckpointDir(cp)
    return spark.sparkContext.getCheckpointDir() or cp


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/rainrisk/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
