"""Every registered query against its SQL on a second engine."""

import pytest

import __spark_entry__ as driver
from compare import TABLES, assert_same, connect
from metricloom.plans.oracle import ORACLE
from metricloom.plans.registry import REGISTRY

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    df = REGISTRY[name](spark, FOLDER)
    assert_same(df, con, ORACLE[name])


# Rows of the sample tables with a third on one user, day and customer, and
# with nulls, duplicate customers, unknown keys and days without rows.
UNEVEN = {
    "events": """
        select event_id,
               case when event_id % 97 = 0 then null
                    when event_id % 3 = 0 then timestamp '2024-01-09 11:00:00' else ts end as ts,
               case when event_id % 101 = 0 then null when event_id % 103 = 0 then 999999
                    when event_id % 3 = 1 then 7 else user_id end as user_id,
               if(event_id % 89 = 0, null, event_type) as event_type,
               if(event_id % 83 = 0, null, value) as value, props
        from events where day(ts) not in (10, 11, 12, 25)""",
    "orders": """
        select o_orderkey,
               case when o_orderkey % 101 = 0 then null when o_orderkey % 103 = 0 then 888888
                    when o_orderkey % 3 = 1 then 42 else o_custkey end as o_custkey,
               if(o_orderkey % 107 = 0, null, o_orderstatus) as o_orderstatus,
               if(o_orderkey % 109 = 0, null, o_totalprice) as o_totalprice,
               case when o_orderkey % 113 = 0 then null
                    when o_orderkey % 3 = 2 then timestamp '1998-03-03 23:30:00'
                    else o_orderdate end as o_orderdate,
               if(o_orderkey % 127 = 0, null, o_orderpriority) as o_orderpriority
        from orders""",
    "customer": """
        select c_custkey, if(c_custkey % 11 = 0, null, c_name) as c_name, c_nationkey,
               if(c_custkey % 13 = 0, null, c_acctbal) as c_acctbal,
               if(c_custkey % 17 = 0, null, c_mktsegment) as c_mktsegment
        from customer
        union all select * from customer where c_custkey in (3, 42)""",
}
# Keys must be unique to be numbered.
UNIQUE_ONLY = {"synth_events", "synth_payments"}


@pytest.fixture(scope="module")
def uneven(con, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("uneven"))
    for name in TABLES:
        rows = UNEVEN.get(name, f"select * from {name}")
        con.execute(f"copy ({rows}) to '{folder}/{name}.parquet' (format parquet)")
    return folder


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - UNIQUE_ONLY))
def test_query_on_uneven_data(spark, uneven, name):
    df = REGISTRY[name](spark, uneven)
    assert_same(df, connect(uneven), ORACLE[name])


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["date_day", "dau", "wau", "mau", "dau_mau_ratio"]
    assert df.count() == 43
