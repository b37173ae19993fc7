"""A full-size synthetic run lands where the known snapshot of such data does.

The draws differ from the ones behind the snapshot, so values agree within
sampling noise and not to the digit.
"""

import pytest
from pyspark.sql import functions as F

from metricloom.operators import staging, star
from metricloom.plans import marts
from metricloom.sources import files, synthetic


@pytest.fixture(scope="module")
def tables(spark):
    raw = synthetic.customers(spark)
    customers = star.dim_customers(staging.stage_customers(raw))
    events = staging.stage_events(synthetic.events(files.customer_ids(raw)))
    payments = staging.stage_payments(synthetic.payments(files.paying_customers(raw)))
    return customers, events, payments


def test_active_users(spark, tables):
    customers, events, _ = tables
    kpi = marts.kpi_daily_active_users(
        star.fct_events(events, customers), "2026-04-26", "2026-04-30"
    )
    rows = kpi.collect()
    assert len(rows) == 5
    for row in rows:
        assert abs(row.dau - 312) < 50
        assert abs(row.mau - 4258) < 80
        assert abs(row.dau_mau_ratio - 0.073) < 0.012
        assert row.dau < row.wau < row.mau


def test_revenue(spark, tables):
    customers, _, payments = tables
    kpi = marts.kpi_revenue_by_segment_of(payments, customers)
    months = kpi.where("month_start between date '2026-01-01' and date '2026-04-01'")
    mean = {
        r.segment: float(r.usd)
        for r in months.groupBy("segment").agg(F.avg("revenue_usd").alias("usd")).collect()
    }
    assert set(mean) == {"Pro", "Business", "Enterprise"}
    assert abs(mean["Pro"] / 80_838 - 1) < 0.15
    assert abs(mean["Business"] / 118_200 - 1) < 0.15
    assert abs(mean["Enterprise"] / 170_042 - 1) < 0.25


def test_funnel(spark, tables):
    customers, events, _ = tables
    cohorts = marts.kpi_funnel_conversion(customers, events)
    rows = cohorts.where(
        "cohort_month between date '2025-10-01' and date '2025-12-01'"
    ).collect()
    assert len(rows) == 3
    for row in rows:
        assert abs(row.cohort_size - 220) < 60
        assert abs(row.pct_completed - 0.90) < 0.06
        assert abs(row.pct_activated - 0.954) < 0.05
        assert abs(row.pct_upgraded - 0.69) < 0.09
