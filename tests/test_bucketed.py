import contextlib
import io
import re

from rainrisk.plans.medallion import silver_rainfall
from rainrisk.sources import bindings as B
from rainrisk.sources.sinks import save_bucketed
from tests.conftest import SF_SMALL


def test_bucketed_bronze_needs_no_fact_shuffle(spark, scratch):
    bronze = B.daily_readings(spark, SF_SMALL)
    table = save_bucketed(bronze, "bronze_bucketed_test", scratch("bronze-bkt"),
                          "codigo_posto", 8, sort_by=["codigo_posto", "data"])
    mun = B.municipalities(spark, SF_SMALL)
    silver = silver_rainfall(table, mun)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        silver.explain("formatted")
    plan = buf.getvalue()
    # no single-key hash exchange of the fact: the bucketed scan already is one
    fact_side = plan.split("\n\n")[0]
    assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan
    smj = fact_side.index("SortMergeJoin") if "SortMergeJoin" in fact_side else None
    if smj is not None:
        left = fact_side[smj:].split("\n")[1]
        assert "Exchange" not in left
    assert len(re.findall(r"Exchange hashpartitioning\(codigo_posto#\d+L?, \d+\)", plan)) <= 1
    # same rows as the unbucketed plan
    plain = silver_rainfall(bronze, mun)
    assert sorted(silver.collect()) == sorted(plain.collect())
