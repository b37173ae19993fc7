"""The order of results that exist for their order, against the SQL's."""

import pytest

from compare import connect
from metricloom.plans.oracle import ORACLE
from metricloom.plans.registry import REGISTRY

FOLDER = "/root/testdata/sf0.01"
# Query and the columns that give its order.
ORDERED = {
    "revenue_series": ("month_start", "segment"),
    "kpi_revenue_recent": ("month_start", "segment"),
    "kpi_funnel_recent": ("cohort_month",),
    "latest_days_topk": ("date_day",),
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_rows_come_in_the_same_order(spark, name):
    got = [tuple(r[c] for c in ORDERED[name]) for r in REGISTRY[name](spark, FOLDER).collect()]
    result = connect(FOLDER).execute(ORACLE[name])
    names = [c[0] for c in result.description]
    at = [names.index(c) for c in ORDERED[name]]
    expected = [tuple(r[i] for i in at) for r in result.fetchall()]
    assert len(got) > 5 and len(set(got)) == len(got)
    assert got == expected


VARIED = {
    "wau_rolling": ["wau"],
    "mau_rolling": ["mau"],
    "calendar_gap_fill": ["refunds", "customers", "unrated"],
    "latest_days_topk": ["dau", "mau"],
    "dq_relationships_payments": ["failures"],
}


@pytest.mark.parametrize("name", sorted(VARIED))
def test_values_are_neither_constant_nor_all_zero(spark, name):
    rows = REGISTRY[name](spark, FOLDER).collect()
    for column in VARIED[name]:
        assert len({r[column] for r in rows}) > 1


def test_reports_have_every_outcome(spark):
    tiles = {r.tile: r.value for r in REGISTRY["headline_tiles"](spark, FOLDER).collect()}
    assert all(v > 0 for v in tiles.values())
    status = {r.status for r in REGISTRY["source_freshness"](spark, FOLDER).collect()}
    assert status == {"pass", "warn", "error"}
    failures = {r.check_name: r.failures for r in REGISTRY["dq_report"](spark, FOLDER).collect()}
    assert failures["no orphan event customer_sk"] > 0
