"""The three KPI marts, composed from the operators. Sort when reading, not here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricloom import fixed_values as fixed
from metricloom.functions import ratio, within_days
from metricloom.operators import activity, funnel, revenue, star

REVENUE_COLUMNS = [
    "month_start", "segment", "revenue_usd", "paying_customers", "txn_count",
    "prev_month_revenue", "mom_growth_pct", "arpu_usd",
]


def with_stickiness(active: DataFrame) -> DataFrame:
    """Add the share of the month's users that were active on the day."""
    return active.withColumn("dau_mau_ratio", ratio("dau", "mau", 4, 0))


def kpi_daily_active_users(
    events: DataFrame,
    start: str = fixed.REPORT_START,
    end: str | None = None,
    day: str = "event_date",
    key: str = "customer_id",
    anchors: str = activity.EVENT_DAYS,
    moment: str | None = None,
) -> DataFrame:
    """Daily, weekly and monthly active users of every calendar day start … end.

    The days are the report's own, so no calendar table can cut them short.
    Only events that some reported window can see are read, so on facts
    partitioned by day the scan is cut to the report's days and one month more.
    On events that are not, name the time behind the day as ``moment`` to prune
    row groups by it.
    """
    first = F.lit(start).cast("date")
    last = F.current_date() if end is None else F.lit(end).cast("date")
    days = star.day_spine(events.sparkSession, first, last)
    earliest = F.date_sub(first, fixed.MONTH_DAYS - 1)
    if moment is None:
        seen = events.where(F.col(day).between(earliest, last))
    else:
        seen = events.where(within_days(moment, earliest, last))
    windows = {"dau": 1, "wau": fixed.WEEK_DAYS, "mau": fixed.MONTH_DAYS}
    return with_stickiness(
        activity.rolling_distinct(seen, day, key, windows, days, anchors)
    )


def revenue_kpi(monthly: DataFrame) -> DataFrame:
    """Growth and revenue per customer on top of monthly revenue."""
    grown = revenue.with_growth(revenue.with_previous_month(monthly))
    return revenue.with_arpu(grown).select(*REVENUE_COLUMNS)


def kpi_revenue_by_segment(payment_facts: DataFrame) -> DataFrame:
    """Revenue KPI from the payment facts."""
    return revenue_kpi(revenue.monthly_revenue(payment_facts))


def kpi_revenue_by_segment_of(payments: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue KPI straight from staged payments and the customer dimension."""
    return revenue_kpi(revenue.monthly_revenue_of(payments, customers))


def kpi_funnel_conversion(customers: DataFrame, events: DataFrame) -> DataFrame:
    """Cohort funnel from the customer dimension and events."""
    milestones = funnel.customer_milestones(customers, events)
    return funnel.with_funnel_rates(funnel.cohort_rollup(milestones))
