"""Star schema: calendar and customer dimensions, event and payment facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom import fixed_values as fixed
from metricloom.functions import event_flag, month_of, surrogate_key, tenure_days
from metricloom.operators.staging import USD


def day_spine(spark: SparkSession, first: str | Column, last: str | Column) -> DataFrame:
    """Every day from ``first`` to ``last``, both included."""
    first, last = (F.lit(day).cast("date") for day in (first, last))
    bounds = spark.range(0, 1, 1, numPartitions=1).select(
        first.alias("first"), last.alias("last")
    )
    return _days_between(bounds)


def day_spine_of(df: DataFrame, day: Column) -> DataFrame:
    """Every day between the earliest and the latest ``day`` of the data."""
    bounds = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return _days_between(bounds)


def _days_between(bounds: DataFrame) -> DataFrame:
    return bounds.select(F.explode(F.sequence("first", "last")).alias("date_day"))


def describe_days(days: DataFrame) -> DataFrame:
    """Calendar attributes of each ``date_day``, other columns kept; Sunday is weekday 0."""
    day = F.col("date_day")
    weekday = F.dayofweek(day) - 1
    return days.select(
        "date_day",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        month_of(day).alias("month_start"),
        F.trunc(day, "quarter").alias("quarter_start"),
        F.trunc(day, "year").alias("year_start"),
        weekday.isin(0, 6).alias("is_weekend"),
        *[c for c in days.columns if c != "date_day"],
    )


def dim_date(
    spark: SparkSession,
    first: str = fixed.CALENDAR_FIRST_DAY,
    last: str = fixed.CALENDAR_LAST_DAY,
) -> DataFrame:
    """Calendar dimension, one row per day."""
    return describe_days(day_spine(spark, first, last))


def dim_customers(customers: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Customer dimension as of now or of a given time; latest values only."""
    as_of = F.current_timestamp() if as_of is None else as_of
    signup_date = F.col("signup_at").cast("date")
    return customers.select(
        surrogate_key("customer_id").alias("customer_sk"),
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "signup_at",
        signup_date.alias("signup_date"),
        month_of(signup_date).alias("signup_month"),
        "country_code",
        "acquisition_channel",
        "segment",
        F.coalesce(F.col("segment").isin(fixed.PAYING_SEGMENTS), F.lit(False)).alias("is_paying"),
        "is_active",
        tenure_days("signup_at", as_of).alias("days_since_signup"),
    )


def fct_events(events: DataFrame, customers: DataFrame, spread: bool = False) -> DataFrame:
    """Event facts; events of unknown customers keep a null ``customer_sk``.

    The join carries no hint. A customer table under the broadcast limit avoids
    the shuffle; a larger one is sort-merged, where the adaptive planner splits
    the partition of a customer (or of null) that holds most of the events.
    The key is a function of the id, so the join only has to tell whether the
    customer exists.
    """
    known = customers.select("customer_id", F.lit(True).alias("is_known"))
    joined = events.join(known, "customer_id", "left")
    return _event_facts(joined, F.col("is_known"), spread)


def unknown_customers(events: DataFrame, customers: DataFrame) -> DataFrame:
    """Ids that have events and no customer; moves ids only, each once."""
    ids = events.where(F.col("customer_id").isNotNull()).select("customer_id").distinct()
    return ids.join(customers.select("customer_id"), "customer_id", "left_anti")


def fct_events_except(events: DataFrame, unknown: DataFrame, spread: bool = False) -> DataFrame:
    """The same facts, told which customers are unknown; customer ids must be unique.

    For a customer table too large to broadcast. Give it the *written* result of
    ``unknown_customers``: normally next to nothing, so the events are joined
    where they are instead of being shuffled whole. Spark sees the size of the
    files, and a set beyond its broadcast limit is sort-merged as above.
    """
    listed = unknown.select("customer_id", F.lit(False).alias("is_known"))
    joined = events.join(listed, "customer_id", "left")
    return _event_facts(joined, F.coalesce("is_known", F.lit(True)), spread)


def _event_facts(joined: DataFrame, is_known: Column, spread: bool) -> DataFrame:
    """Derived columns of the event facts.

    ``spread`` lays the rows out by day for a partitioned write: few files for
    a small day, many tasks for a day with a third of the rows. It does so
    before the derived columns exist, so they are not moved.
    """
    joined = joined.withColumn("event_date", F.col("event_at").cast("date"))
    if spread:
        joined = joined.hint("rebalance", F.col("event_date"))
    event_type = F.col("event_type")
    return joined.select(
        "event_id",
        F.when(is_known, surrogate_key("customer_id")).alias("customer_sk"),
        "customer_id",
        "event_date",
        "event_at",
        "event_type",
        "platform",
        "session_id",
        "funnel_step",
        event_flag(event_type, "page_view").alias("is_page_view"),
        event_flag(event_type, "sign_up_completed").alias("is_signup"),
        event_flag(event_type, "activated").alias("is_activation"),
        event_flag(event_type, "upgraded").alias("is_upgrade"),
    )


def is_recognised(status: Column) -> Column:
    """Only succeeded payments count as revenue."""
    return F.coalesce(status == "succeeded", F.lit(False))


def fct_payments(payments: DataFrame, customers: DataFrame, spread: bool = False) -> DataFrame:
    """Payment facts with the customer's current segment and country.

    ``spread`` adds the ``payment_month`` to partition by and lays the rows out
    for it, as for the event facts.
    """
    attributes = customers.select(
        "customer_id",
        F.lit(True).alias("is_known"),
        F.col("segment").alias("customer_segment"),
        "country_code",
    )
    joined = payments.join(attributes, "customer_id", "left").withColumn(
        "payment_date", F.col("paid_at").cast("date")
    )
    month = []
    if spread:
        joined = joined.withColumn("payment_month", month_of("payment_date")).hint(
            "rebalance", F.col("payment_month")
        )
        month = ["payment_month"]
    recognised = is_recognised(F.col("status"))
    return joined.select(
        "payment_id",
        F.when(F.col("is_known"), surrogate_key("customer_id")).alias("customer_sk"),
        "customer_id",
        "payment_date",
        "paid_at",
        "amount_local",
        "currency",
        "amount_usd",
        "status",
        "plan",
        "customer_segment",
        "country_code",
        recognised.alias("is_recognized_revenue"),
        F.when(recognised, F.col("amount_usd"))
        .otherwise(F.lit(0).cast(USD))
        .alias("recognized_amount_usd"),
        *month,
    )
