"""Plan-shape tests: the scale properties the design relies on."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    q = E.queries()
    names = ["station_municipality_map", "silver_rainfall", "gold_grid_risk",
             "latest_per_municipality", "silver_station_latest", "backfill_plan"]
    return {n: plan_of(q[n](spark, SF_SMALL)) for n in names}


def test_matching_has_no_cross_product(plans):
    for name in ("station_municipality_map", "silver_rainfall", "gold_grid_risk"):
        p = plans[name]
        assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p, name


def test_backfill_generates_years_without_a_join(plans):
    p = plans["backfill_plan"]
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "Generate" in p


def test_silver_windows_share_one_exchange(plans):
    p = plans["silver_rainfall"]
    # the fact is hashed on the station code once; the windows add no exchange
    import re
    single_key = re.findall(r"hashpartitioning\(codigo_posto#\d+L?, \d+\)", p)
    assert len(single_key) == 2  # fact side + per-code mapping aggregate of the SMJ
    head = p.split("\n\n")[0]
    top = head[: head.index("SortMergeJoin")]
    assert "Exchange" not in top and top.count("Window") == 2


def test_reductions_are_aggregates_not_windows(plans):
    for name in ("gold_grid_risk", "silver_station_latest"):
        p = plans[name]
        assert "WindowGroupLimit" not in p, name
    # the only window in gold is the id over one row per municipality
    assert plans["gold_grid_risk"].split("\n\n")[0].count("Window") == 1


def test_latest_dates_are_broadcast(plans):
    head = plans["latest_per_municipality"].split("\n\n")[0].split("\n")
    # AdaptiveSparkPlan / Project / the join with the per-municipality maxima
    assert head[3].strip().startswith("+- BroadcastHashJoin"), head[:4]


def test_bronze_year_reads_are_partition_pruned(spark, scratch):
    from rainrisk.sources import bindings as B
    from rainrisk.sources import daily
    path = scratch("bronze")
    daily.replace_bronze_partitions(B.daily_readings(spark, SF_SMALL), path)
    p = plan_of(daily.read_bronze(spark, path, year=1996))
    assert "PartitionFilters: [isnotnull(ano" in p and "(ano#" in p and "= 1996)" in p
    p = plan_of(daily.read_bronze(spark, path, before_year=1996))
    assert "PartitionFilters: [isnotnull(ano" in p and "< 1996)" in p


def test_html_rows_are_parsed_once(spark):
    """No filter repeats the page's regexes, and the raw pivot does not sort."""
    p = plan_of(E.queries()["html_table_rows"](spark, SF_SMALL))
    assert not [x for x in p.split("\n") if x.startswith("Condition") and "regexp_extract_all" in x]
    assert "SortAggregate" not in p
    assert p.count("Exchange hashpartitioning") <= 2  # readings per day, then by station: none for months and pages


@pytest.mark.parametrize("name", ["silver_rainfall", "silver_rainfall_split", "dq_unique", "html_table_rows"])
def test_tasks_follow_the_input(spark, monkeypatch, name):
    """Where the input asks for more tasks than the session's, the exchanges of
    the fact get them, with the same rows."""
    from rainrisk.operators import joins
    want = sorted(map(str, E.queries()[name](spark, SF_SMALL).collect()))
    monkeypatch.setattr(joins, "TASK_BYTES", 4096)
    many = E.queries()[name](spark, SF_SMALL)
    found = plan_of(many).count("REPARTITION_BY_NUM")
    assert found >= 2, found
    assert sorted(map(str, many.collect())) == want


@pytest.mark.parametrize("name", ["silver_rainfall", "silver_rainfall_latest_year"])
def test_silver_windows_sort_the_readings_once(spark, name):
    """No window asks for an order of its own (each one sorted the fact again);
    the calendar, derived per row, comes after them."""
    p = plan_of(E.queries()[name](spark, SF_SMALL))
    nodes = [x.strip(" +-:*()0123456789") for x in p.split("\n\n")[0].split("\n")]
    at = [i for i, x in enumerate(nodes) if x == "Window"]
    assert len(at) == 2 and not {"Sort", "Exchange"} & set(nodes[at[0]:at[-1]])
    assert not [x for x in p.split("\n\n") if ") Window" in x and "dia_semana" in x]


def test_reading_dates_are_those_of_the_readings(spark):
    from rainrisk.sources import bindings as B
    got = B.reading_dates(spark, SF_SMALL).distinct().collect()
    assert sorted(got) == sorted(B.daily_readings(spark, SF_SMALL).select("data").distinct().collect())


def test_tasks_are_held_against_cores_too(spark, monkeypatch, scratch):
    # of 200 shuffle partitions AQE makes as few tasks as there are cores: those grew with the table
    from rainrisk.operators import joins
    path = scratch()
    spark.range(20_000).selectExpr("id % 50 codigo_posto", "id data").write.parquet(path)
    df = spark.read.parquet(path)
    spark.conf.set("spark.sql.shuffle.partitions", 200)
    try:
        monkeypatch.setattr(joins, "TASK_BYTES", joins.stored_bytes(df) // 30)
        cores = spark.sparkContext.defaultParallelism
        assert joins.clustered(df, "codigo_posto").rdd.getNumPartitions() >= 30 > cores
        monkeypatch.setattr(joins, "TASK_BYTES", joins.stored_bytes(df) // 2)
        assert joins.clustered(df, "codigo_posto") is df
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_bucketed_table_is_not_dealt_out_again(spark, monkeypatch, scratch):
    from rainrisk.operators import joins
    from rainrisk.sources import sinks
    rows = spark.range(1000).selectExpr("id % 50 AS codigo_posto", "id")
    back = sinks.save_bucketed(rows, "agrupada", scratch("bucketed"), "codigo_posto", 4)
    monkeypatch.setattr(joins, "TASK_BYTES", 16)
    assert "REPARTITION" not in plan_of(joins.clustered(back, "codigo_posto"))
    spark.sql("DROP TABLE agrupada")


def test_reload_builds_only_its_year(spark, monkeypatch):
    """The year filter of the second load lies below the pivot."""
    from rainrisk.sources import daily
    seen, write = [], daily.replace_bronze_partitions
    monkeypatch.setattr(daily, "replace_bronze_partitions", lambda long, path: (
        seen.append(str(long._jdf.queryExecution().optimizedPlan())), write(long, path)))
    E.queries()["bronze_replace_year"](spark, SF_SMALL)
    pivot = seen[1][seen[1].index("bit_or"):]
    assert "Filter" in pivot and "year(" in pivot.lower()


def test_raw_files_are_dealt_out_once(spark, scratch):
    """The rows are staged by as many tasks as they come in, not by those of (region, year) names; each name is one file."""
    import glob
    import re
    from rainrisk.plans.raw_fixture import write_raw_files
    from rainrisk.sources import bindings as B
    folder = scratch("raw-files")
    write_raw_files(spark, B.daily_readings(spark, SF_SMALL), folder)
    plain = re.sub(r"^file:/+", "/", folder)
    assert glob.glob(f"{plain}/staged/kind=0/*.parquet") and not glob.glob(f"{plain}/staged/kind=*/name=*")
    assert all(len(glob.glob(f"{x}/*.parquet")) <= 1 for x in glob.glob(f"{plain}/laid/kind=*/name=*"))
