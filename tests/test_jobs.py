from pyspark.sql import functions as F

from rainrisk import jobs
from rainrisk.sources import bindings as B
from rainrisk.sources import daily
from tests.conftest import SF_SMALL


def test_jobs_end_to_end(spark, scratch):
    raw, bronze = scratch("raw"), scratch("bronze")
    daily.land_raw_wide(B.daily_wide(B.daily_readings(spark, SF_SMALL)), raw)
    mun = scratch("mun")
    B.municipalities(spark, SF_SMALL).write.parquet(mun)
    assert jobs.main(["load", "--raw", raw, "--bronze", bronze, "--report", scratch("rep")]) == 0
    silver, gold = scratch("silver"), scratch("gold")
    assert jobs.main(["build", "--bronze", bronze, "--municipalities", mun,
                      "--silver", silver, "--gold", gold]) == 0
    n_gold = spark.read.parquet(gold).count()
    last = spark.read.parquet(silver).agg(F.max("ano")).first()[0]
    assert jobs.main(["refresh", "--bronze", bronze, "--municipalities", mun, "--silver", silver,
                      "--gold", gold, "--state", scratch("state"), "--year", str(last)]) == 0
    assert spark.read.parquet(gold).count() == n_gold > 0
    out = scratch("plan")
    assert jobs.main(["plan", "--bronze", bronze, "--out", out, "--as-of", "2026-06-30"]) == 0
    assert spark.read.parquet(out).count() > 0
