"""Typed, cleaned staging tables, one row per source row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom import fixed_values as fixed
from metricloom.functions import (
    capitalise,
    funnel_step,
    lower_code,
    normal_segment,
    parse_flag,
    strict_segment,
    upper_code,
)

MONEY = "decimal(12,2)"
USD = "decimal(18,6)"
RATE = "decimal(5,4)"


def _with_load_time(df: DataFrame, loaded_at: Column | None) -> DataFrame:
    return df if loaded_at is None else df.withColumn("_loaded_at", loaded_at)


def stage_customers(
    raw: DataFrame, strict: bool = False, loaded_at: Column | None = None
) -> DataFrame:
    """Customer master. ``strict`` maps unknown segments to null."""
    segment = strict_segment("segment") if strict else normal_segment("segment")
    staged = raw.select(
        F.col("customer_id").cast("string").alias("customer_id"),
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        lower_code("email").alias("email"),
        F.col("signup_date").cast("timestamp_ntz").alias("signup_at"),
        upper_code("country").alias("country_code"),
        lower_code("acquisition_channel").alias("acquisition_channel"),
        segment.alias("segment"),
        parse_flag("is_active").alias("is_active"),
    )
    return _with_load_time(staged, loaded_at)


def stage_events(raw: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """App events with the position of their type in the signup funnel."""
    event_type = lower_code("event_type")
    staged = raw.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("event_timestamp").cast("timestamp_ntz").alias("event_at"),
        event_type.alias("event_type"),
        lower_code("platform").alias("platform"),
        F.col("session_id").cast("string").alias("session_id"),
        funnel_step(event_type).alias("funnel_step"),
    )
    return _with_load_time(staged, loaded_at)


def fx_rates(spark: SparkSession) -> DataFrame:
    """The fixed rates as a relation.

    Five literal rows: the planner knows the size and broadcasts it by itself.
    """
    rows = ", ".join(
        f"('{code}', CAST('{rate}' AS {RATE}))" for code, rate in fixed.USD_RATES.items()
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS fx(currency, usd_rate)")


def fixed_rate(currency: Column) -> Column:
    """The fixed rate of a clean currency code, null for an unknown one."""
    return F.coalesce(
        *[
            F.when(currency == code, F.lit(rate).cast(RATE))
            for code, rate in fixed.USD_RATES.items()
        ]
    )


# A rate table of up to this many rows is sent to every task; a larger one is joined.
BROADCAST_RATES = 10_000


def _with_rates(cleaned: DataFrame, fx: DataFrame) -> DataFrame:
    """Rates by a join with a table of one row per currency; anything else is refused."""
    rates = fx.select(F.col("currency").alias("fx_currency"), "usd_rate")
    n, n_currencies = rates.agg(F.count("fx_currency"), F.count_distinct("fx_currency")).first()
    if n != n_currencies:
        raise ValueError("a currency has more than one rate")
    rates = F.broadcast(rates) if n <= BROADCAST_RATES else rates
    return cleaned.join(rates, F.col("currency") == F.col("fx_currency"), "left")


def stage_payments(
    raw: DataFrame, fx: DataFrame | None = None, loaded_at: Column | None = None
) -> DataFrame:
    """Payments with their amount in US dollars, null for an unknown currency.

    The fixed rates are part of the expression: nothing is joined, and a query
    that does not ask for dollars reads neither amount nor currency. ``fx``
    (currency, usd_rate) replaces them by a table.
    """
    cleaned = raw.select(
        F.col("payment_id").cast("string").alias("payment_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("payment_timestamp").cast("timestamp_ntz").alias("paid_at"),
        F.col("amount").cast(MONEY).alias("amount_local"),
        upper_code("currency").alias("currency"),
        lower_code("status").alias("status"),
        capitalise("plan").alias("plan"),
    )
    if fx is None:
        rated = cleaned.withColumn("usd_rate", fixed_rate(F.col("currency")))
    else:
        rated = _with_rates(cleaned, fx)
    staged = rated.select(
        "payment_id",
        "customer_id",
        "paid_at",
        "amount_local",
        "currency",
        (F.col("amount_local") * F.col("usd_rate")).cast(USD).alias("amount_usd"),
        "status",
        "plan",
    )
    return _with_load_time(staged, loaded_at)
