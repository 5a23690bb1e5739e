from rainrisk.sources import sinks


def test_sinks_roundtrip(spark, scratch):
    df = spark.createDataFrame([(1, "a", 2020), (2, "b", 2020), (3, "c", 2021)],
                               "k int, v string, ano int")
    path = scratch("tbl")
    sinks.ensure_table(spark, path, "k int, v string, ano int", ["ano"])   # S9
    assert spark.read.schema("k int, v string, ano int").parquet(path).count() == 0
    sinks.rebuild_table(df, path, ["ano"])                                 # S11
    sinks.ensure_table(spark, path, "k int, v string, ano int", ["ano"])   # no-op now
    back = spark.read.parquet(path)
    assert back.count() == 3
    counts = {r.n_rows for r in sinks.rows_per_file(back).collect()}      # A6
    assert sum(r.n_rows for r in sinks.rows_per_file(back).collect()) == 3 and counts
    sinks.register_view(back, "rainrisk_test_view")                        # S13
    assert spark.sql("SELECT count(*) FROM rainrisk_test_view WHERE ano = 2020").first()[0] == 2
    sinks.ensure_namespace(spark, "rainrisk_test_ns", scratch("ns"))       # S16
    sinks.ensure_namespace(spark, "rainrisk_test_ns", scratch("ns"))
    assert spark.catalog.databaseExists("rainrisk_test_ns")
