import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from rainrisk.session import build_session
    # codegen fallback off: a stage that fails to compile must fail the test
    s = build_session(master="local[4]", shuffle_partitions=8, app_name="rainrisk-tests",
                      extra={"spark.sql.codegen.fallback": "false"})
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from rainrisk.session import scratch_path
    return lambda label="t": scratch_path(spark, label)
