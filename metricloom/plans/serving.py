"""Dashboard queries over the marts. Those printed have a size by their own definition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricloom.operators.quality import union_all


def latest_days(active_users: DataFrame, days: int = 30) -> DataFrame:
    """The newest days, newest first."""
    return active_users.orderBy(F.desc("date_day")).limit(days)


def revenue_by_month(revenue: DataFrame) -> DataFrame:
    """Revenue of all segments together, per month."""
    return revenue.groupBy("month_start").agg(
        F.sum("revenue_usd").cast("decimal(38,6)").alias("revenue")
    )


def revenue_series(revenue: DataFrame) -> DataFrame:
    """The revenue mart in the order a chart draws it."""
    return revenue.orderBy(F.asc_nulls_last("month_start"), F.asc_nulls_last("segment"))


def headline_tiles(active_users: DataFrame, by_month: DataFrame) -> DataFrame:
    """One row per headline number: its name and value.

    ``by_month`` has ``month_start`` and ``revenue``, a row per month.
    """
    names = ["dau", "mau", "dau_mau_ratio"]
    newest_day = active_users.agg(
        F.max_by(F.struct(*names), "date_day").alias("newest")
    ).select("newest.*")
    tiles = [
        F.struct(F.lit(name).alias("tile"), F.col(name).cast("double").alias("value"))
        for name in names
    ]
    newest_month = by_month.agg(
        F.max_by("revenue", "month_start").cast("double").alias("value")
    )
    return union_all(
        [
            newest_day.select(F.explode(F.array(*tiles)).alias("t")).select("t.*"),
            newest_month.select(F.lit("revenue_latest_month").alias("tile"), "value"),
        ]
    )


def newest_revenue(revenue: DataFrame, rows: int = 12) -> DataFrame:
    """The newest rows of the revenue mart, newest month first."""
    newest = (F.desc_nulls_last("month_start"), F.asc_nulls_last("segment"))
    return revenue.orderBy(*newest).limit(rows)


def funnel_latest_cohort(funnel: DataFrame) -> DataFrame:
    """Size and rates of the newest cohort."""
    return (
        funnel.orderBy(F.desc("cohort_month"))
        .limit(1)
        .select("cohort_month", "cohort_size", "pct_completed", "pct_activated", "pct_upgraded")
    )


def revenue_since(revenue: DataFrame, first_month: str) -> DataFrame:
    """Revenue rows from a month on, in order."""
    return revenue_series(
        revenue.where(F.col("month_start") >= F.lit(first_month).cast("date"))
    )


def funnel_since(funnel: DataFrame, first_month: str) -> DataFrame:
    """Cohorts from a month on, in order."""
    return (
        funnel.where(F.col("cohort_month") >= F.lit(first_month).cast("date"))
        .select("cohort_month", "cohort_size", "pct_completed", "pct_activated", "pct_upgraded")
        .orderBy("cohort_month")
    )
