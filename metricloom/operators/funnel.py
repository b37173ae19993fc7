"""Signup cohorts and how far their customers got."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricloom.functions import event_flag, ratio

# Milestone flag, the event type that sets it, and the cohort's count of it.
MILESTONES = {
    "did_start": ("sign_up_started", "started"),
    "did_complete": ("sign_up_completed", "completed"),
    "did_activate": ("activated", "activated"),
    "did_upgrade": ("upgraded", "upgraded"),
}


def customer_milestones(customers: DataFrame, events: DataFrame) -> DataFrame:
    """Whether each customer ever reached each milestone, in any order.

    Events are cut to the milestone types and reduced to one row per customer
    before the join, so a customer with a third of the events is one row in it.
    Customers without events keep zeros.
    """
    types = [event_type for event_type, _ in MILESTONES.values()]
    reached = (
        events.where(F.col("event_type").isin(types) & F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            *[
                F.max(event_flag("event_type", event_type)).alias(flag)
                for flag, (event_type, _) in MILESTONES.items()
            ]
        )
    )
    cohorts = customers.select("customer_id", "signup_month")
    return (
        cohorts.join(reached, "customer_id", "left")
        .groupBy("customer_id", "signup_month")
        .agg(*[F.coalesce(F.max(flag), F.lit(0)).alias(flag) for flag in MILESTONES])
    )


def cohort_rollup(milestones: DataFrame) -> DataFrame:
    """Size of each signup month and how many reached each milestone."""
    return milestones.groupBy(F.col("signup_month").alias("cohort_month")).agg(
        F.count("*").alias("cohort_size"),
        *[F.sum(flag).alias(count) for flag, (_, count) in MILESTONES.items()],
    )


def with_funnel_rates(cohorts: DataFrame) -> DataFrame:
    """Add rates against the cohort and against the step before."""
    counts = [count for _, count in MILESTONES.values()]
    return cohorts.select(
        "*",
        *[ratio(count, "cohort_size", 4).alias(f"pct_{count}") for count in counts],
        ratio("activated", "completed", 4).alias("completion_to_activation"),
        ratio("upgraded", "activated", 4).alias("activation_to_upgrade"),
    )
