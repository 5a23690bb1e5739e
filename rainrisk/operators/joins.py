"""Broadcast only behind a proven size bound; shuffles dealt into as many tasks
as their input needs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest table (bytes, as Catalyst estimates them from file sizes) we
# broadcast. A municipality gazetteer (a few thousand rows of short text) is
# far below it; a per-reading or per-station table of a large deployment is
# far above it and keeps a sort-merge join.
BROADCAST_MAX_BYTES = 32 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df``: file sizes carried through the
    optimised plan (filters and aggregates keep their input's size, joins
    multiply), so it errs on the large side. Metadata only: no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def checked_broadcast(df: DataFrame, bound: DataFrame | None = None,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` when ``bound`` (a table that bounds ``df``'s size,
    e.g. the dimension ``df`` derives from; ``df`` itself by default) is
    estimated at ``max_bytes`` or less; otherwise ``df`` unchanged, so
    Catalyst / AQE choose from what they measure.
    """
    return F.broadcast(df) if estimated_bytes(df if bound is None else bound) <= max_bytes else df


# Stored bytes that one task of a clustered exchange stands for (Parquet holds
# a reading in 4 to 20 bytes, a windowed one takes some 250 in memory), and the
# most tasks of one exchange: beyond both, tasks grow and their sorts spill.
TASK_BYTES = 8 << 20
MOST_TASKS = 20_000


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files and local rows that ``df`` reads, from metadata; what
    has no size (a stream, a Python source, a checkpoint) does not count."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(x for x in sizes if x < 1 << 60)


def _hashed_on(df: DataFrame, keys: tuple[str, ...]) -> bool:
    """Whether ``df``'s rows of one key lie together as they come (a bucketed table)."""
    found = re.findall(r"hashpartitioning\(([^()]*), \d+", str(df._jdf.queryExecution().sparkPlan().outputPartitioning()))
    return any({c.split("#")[0].strip() for c in x.split(",")} <= set(keys) for x in found)


def _tasks(df: DataFrame, keys: tuple[str, ...]) -> int:
    """Tasks that ``df``'s input asks for; 0 where it needs no exchange of its own."""
    spark, tasks = df.sparkSession, stored_bytes(df) // TASK_BYTES
    # of many shuffle partitions AQE makes as few tasks as there are cores, up to 64 MB of shuffled bytes in each
    few = tasks <= min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return 0 if few or _hashed_on(df, keys) else min(tasks, MOST_TASKS)


def clustered(df: DataFrame, *keys: str, always: bool = False) -> DataFrame:
    """``df`` dealt out by ``keys`` into tasks of about ``TASK_BYTES`` of its
    input, where that is more than the session's shuffle partitions or its
    cores, which AQE may merge them to (a fixed number of tasks would grow
    with the table), and ``df`` does not come hashed on them already. Otherwise ``df`` unchanged or, with
    ``always``, dealt out into the session's number of partitions."""
    tasks = _tasks(df, keys)
    if tasks:
        return df.repartition(tasks, *keys)
    return df.repartition(*keys) if always else df


def clustered_alike(fact: DataFrame, side: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``fact`` clustered by ``key`` and ``side``, which is joined to it on that
    key, dealt out alike: otherwise a sort-merge join takes both back to the
    session's number of partitions."""
    tasks = _tasks(fact, (key,))
    return (fact.repartition(tasks, key), side.repartition(tasks, key)) if tasks else (fact, side)
