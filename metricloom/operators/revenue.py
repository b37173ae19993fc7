"""Monthly recognised revenue, growth and revenue per paying customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricloom.functions import month_of, ratio
from metricloom.operators.star import is_recognised

TOTAL = "decimal(38,6)"


def monthly_revenue(payment_facts: DataFrame) -> DataFrame:
    """Revenue, paying customers and payments of each month and segment."""
    return (
        payment_facts.where("is_recognized_revenue")
        .groupBy(
            month_of("payment_date").alias("month_start"),
            F.col("customer_segment").alias("segment"),
        )
        .agg(
            F.sum("recognized_amount_usd").cast(TOTAL).alias("revenue_usd"),
            F.countDistinct("customer_id").alias("paying_customers"),
            F.count("*").alias("txn_count"),
        )
    )


def monthly_revenue_of(payments: DataFrame, customers: DataFrame) -> DataFrame:
    """The same from staged payments, without building the facts first.

    Payments are summed per customer and month before the join, so the join
    moves a row per customer-month instead of every payment, and a customer
    with a third of the payments is a few rows like any other.
    """
    per_customer = (
        payments.where(is_recognised(F.col("status")))
        .groupBy("customer_id", month_of(F.col("paid_at").cast("date")).alias("month_start"))
        .agg(F.sum("amount_usd").alias("amount_usd"), F.count("*").alias("payments"))
    )
    return (
        per_customer.join(customers.select("customer_id", "segment"), "customer_id", "left")
        .groupBy("month_start", "segment")
        .agg(
            F.sum("amount_usd").cast(TOTAL).alias("revenue_usd"),
            F.countDistinct("customer_id").alias("paying_customers"),
            F.sum("payments").alias("txn_count"),
        )
    )


def revenue_by_month_of(payments: DataFrame) -> DataFrame:
    """Revenue per month straight from staged payments; no customer is needed for it."""
    return (
        payments.where(is_recognised(F.col("status")))
        .groupBy(month_of(F.col("paid_at").cast("date")).alias("month_start"))
        .agg(F.sum("amount_usd").cast(TOTAL).alias("revenue"))
    )


def with_previous_month(monthly: DataFrame) -> DataFrame:
    """Add the revenue of the segment's previous month that has any."""
    of_segment = Window.partitionBy("segment").orderBy(F.asc_nulls_last("month_start"))
    return monthly.withColumn("prev_month_revenue", F.lag("revenue_usd").over(of_segment))


def with_growth(monthly: DataFrame) -> DataFrame:
    """Add growth over ``prev_month_revenue``; null without a usable baseline."""
    gain = F.col("revenue_usd") - F.col("prev_month_revenue")
    return monthly.withColumn("mom_growth_pct", ratio(gain, "prev_month_revenue", 4))


def with_arpu(monthly: DataFrame) -> DataFrame:
    """Add revenue per paying customer."""
    return monthly.withColumn("arpu_usd", ratio("revenue_usd", "paying_customers", 2, 0))
