import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from rainrisk.operators.joins import checked_broadcast
from rainrisk.session import cut_lineage, scratch_path


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_checked_broadcast_both_ways(spark):
    small = spark.range(3).withColumnRenamed("id", "k")
    big = spark.range(1000).withColumnRenamed("id", "k")
    hinted = big.join(checked_broadcast(small, max_bytes=100), "k")
    assert "BroadcastHashJoin" in _plan(hinted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        not_hinted = big.join(checked_broadcast(small, max_bytes=10), "k")
        assert "BroadcastHashJoin" not in _plan(not_hinted)
        bounded = big.join(checked_broadcast(small, bound=big, max_bytes=100), "k")
        assert "BroadcastHashJoin" not in _plan(bounded)  # the bound is too large
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_size_check_runs_no_job_and_leaves_no_single_partition(spark):
    from rainrisk.operators import match
    from rainrisk.sources import bindings as B
    from tests.conftest import SF_SMALL
    sc = spark.sparkContext
    sc.setJobGroup("plan-only", "building a plan")
    try:
        readings, mun = B.daily_readings(spark, SF_SMALL), B.municipalities(spark, SF_SMALL)
        before = len(sc.statusTracker().getJobIdsForGroup("plan-only"))
        df = match.station_municipality_map(readings, mun)
        assert len(sc.statusTracker().getJobIdsForGroup("plan-only")) == before
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert "LocalLimit" not in _plan(df) and "GlobalLimit" not in _plan(df)


def test_local_scratch_is_refused_on_a_cluster():
    import pytest

    from rainrisk.session import local_scratch_allowed
    assert local_scratch_allowed("local[4]") and local_scratch_allowed("local")
    with pytest.raises(RuntimeError):
        local_scratch_allowed("spark://host:7077")
    with pytest.raises(RuntimeError):
        local_scratch_allowed("local-cluster[2,1,1024]")


def test_scratch_paths_are_fresh_and_lineage_cut(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b
    df = spark.range(10).withColumn("y", F.col("id") * 2)
    cut = cut_lineage(df)
    assert cut.count() == 10
    plan = _plan(cut)
    assert "Scan ExistingRDD" in plan or "LogicalRDD" in plan  # read back, not recomputed


def test_json_array_payload_and_station_table(spark, scratch):
    import os

    from rainrisk.operators.stations import latest_per_station, station_table
    from rainrisk.sources import feed
    base = scratch("payload").removeprefix("file:")
    os.makedirs(base)
    with open(f"{base}/batch.json", "w") as fh:
        fh.write('[{"Data-hora": "2025-01-01 10:00:00", "Estação": "E1", "Codigo_gmmc": "G1",'
                 ' "Dados_completos": "{\\"chuva\\": 2.5, \\"cidade\\": \\"Recife\\"}"},'
                 ' {"Data-hora": "2025-01-01 11:00:00", "Estação": "E1", "Codigo_gmmc": "G1",'
                 ' "Dados_completos": "{\\"chuva\\": 1, \\"cidade\\": \\" recife\\"}"}]')
    rows = feed.typed_feed(feed.read_payload(spark, base, json_array=True))
    assert rows.count() == 2
    mun = spark.createDataFrame([(2611606, "Recife", -8.05, -34.9)],
                                "codigo_ibge int, municipio string, latitude double, "
                                "longitude double")
    as_of = F.lit(dt.datetime(2025, 1, 2, 0, 0)).cast("timestamp")
    st = station_table(latest_per_station(rows), mun, as_of=as_of).collect()
    assert [(r.estacao_codigo, r.municipio_nome, r.codigo_ibge) for r in st] == \
        [("G1", "RECIFE", 2611606)]
    assert st[0].atualizado_em is not None


def test_write_dimension(spark, scratch):
    from rainrisk.sources.gazetteer import write_dimension
    path = scratch("dim")
    df = spark.createDataFrame([(2, "b", 1.0, 1.0), (1, "a", 2.0, 2.0)],
                               "codigo_ibge int, municipio string, latitude double, "
                               "longitude double")
    write_dimension(df, path)
    assert sorted(r.codigo_ibge for r in spark.read.parquet(path).collect()) == [1, 2]
