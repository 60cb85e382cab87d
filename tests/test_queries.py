import pytest

import __spark_entry__ as contract
import registry
from compare import database, difference
from registry.sources import SOURCES
from tablesync import SPECS

SF = "/root/testdata/sf0.001"
OWN, SETTLED = registry.QUERIES, contract.queries()
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    with database(SF) as con:
        yield con


@pytest.mark.parametrize("name", OWN)
def test_same_rows_as_sql(spark, con, name):
    assert difference(SETTLED[name](spark, SF), con, ORACLE[name]) is None


def test_every_query_has_sql_and_every_table_a_query():
    assert set(OWN) == set(registry.ORACLE)
    assert {f"job_{name}" for name in SPECS} <= set(OWN)
    used = {s.source for s in SPECS.values()} | {j.table for s in SPECS.values() for j in s.joins}
    assert used == set(SOURCES)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == 1500 and "order_id" in df.columns
