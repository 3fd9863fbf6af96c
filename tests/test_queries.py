"""Every query of the core against its DuckDB SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from sparkloom.plans import queries as plans
from tests.conftest import same_rows

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_oracle(spark, duck, name):
    same_rows(plans.queries()[name](spark, SF).toPandas(), duck.execute(plans.oracle_sql()[name]).df())


def test_requests_hold_the_limits(spark):
    rows = plans.sub_batches(spark, SF).collect()
    assert rows and all(r.n_docs <= 500 and (r.n_bytes <= 1 << 16 or r.n_docs == 1) for r in rows)
