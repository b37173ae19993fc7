"""The registered queries of this folder against their SQL on the second engine."""

import duckdb
import pytest

import __spark_entry__ as driver
from compare import assert_same
from helpers import SAMPLE
from metricloom.llm import queries


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark"):
        con.execute(f"create view {name} as select * from read_parquet('{SAMPLE}/{name}.parquet')")
    return con


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.REGISTRY)
    assert numbers == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.REGISTRY)
    assert set(queries.REGISTRY) | {"pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, con, name):
    assert_same(driver.queries()[name](spark, SAMPLE), con, driver.oracle_sql()[name])


NATIVE = ["op1_secret_scan", "op2_quality_rules", "op4_line_dedup", "op9_url_filter"]


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, name):
    plan = driver.queries()[name](spark, SAMPLE)._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "NestedLoop", "Python", "Arrow", "Pandas"):
        assert slow not in plan
