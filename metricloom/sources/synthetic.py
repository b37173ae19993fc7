"""Synthetic customers, events and payments with fixed distributions.

Every draw is a hash of (seed, row), so a row is the same on any number of
partitions and after a lost task is run again.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metricloom import fixed_values as fixed
from metricloom.functions import numbered_key

# A draw has 52 bits, all that a double between 0 and 1 can tell apart evenly.
DRAW_DIGITS, DRAW_VALUES = 13, float(1 << 52)
DRAWS_PER_DIGEST = 2


def _number(digest: Column, draw: int) -> Column:
    """One of the two 52-bit numbers in the hex digits of an md5."""
    digits = F.substring(digest, 1 + DRAW_DIGITS * draw, DRAW_DIGITS)
    return F.conv(digits, 16, 10).cast("long")


def with_draws(df: DataFrame, seed: int, row: str, n: int) -> DataFrame:
    """Adds u0 … u(n-1), uniform in [0, 1) and repeatable for the same seed and row.

    Digests, numbers and what is chosen by them are projections of their own, so
    each digest is computed once however many choices look at its numbers.
    """
    text = F.col(row).cast("string")
    digests = {
        f"digest{i}": F.md5(F.concat_ws(":", F.lit(f"{seed}.{i}"), text))
        for i in range(-(-n // DRAWS_PER_DIGEST))
    }
    numbers = {
        f"u{i}": _number(F.col(f"digest{i // DRAWS_PER_DIGEST}"), i % DRAWS_PER_DIGEST)
        / F.lit(DRAW_VALUES)
        for i in range(n)
    }
    return df.withColumns(digests).withColumns(numbers).drop(*digests)


def whole(u: Column, n: Column | int) -> Column:
    """Uniform whole number in 0 … n - 1."""
    return F.floor(u * n).cast("long")


def pick(u: Column, values: list) -> Column:
    """One of the values, each with the same chance."""
    return F.element_at(
        F.array(*[F.lit(v) for v in values]), (whole(u, len(values)) + 1).cast("int")
    )


def weighted_pick(u: Column, values: list[str], weights: list[float]) -> Column:
    """One of the values with the given chances."""
    chain, reached = None, 0.0
    for value, weight in zip(values[:-1], weights[:-1], strict=True):
        reached = round(reached + weight, 10)
        chain = (F if chain is None else chain).when(u < reached, F.lit(value))
    return chain.otherwise(F.lit(values[-1]))


def seconds_after(start: str, seconds: Column) -> Column:
    return F.timestamp_add(
        "SECOND", seconds.cast("int"), F.lit(start).cast("timestamp_ntz")
    )


def _placed(df: DataFrame, key: str, buckets: int | None) -> DataFrame:
    """Adds the place of each key, a draw of its digest, and the bucket it falls into."""
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = _number(F.md5(F.col(key)), 0)
    bucket = F.floor(F.col("place") / F.lit(DRAW_VALUES) * buckets).cast("long")
    return df.withColumn("place", place).withColumn("bucket", bucket)


def _offsets(placed: DataFrame) -> DataFrame:
    """Rows before each bucket and rows in all; a row per bucket."""
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("size"))
    return sizes.select(
        "bucket",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"),
        F.sum("size").over(every).alias("total"),
    )


def dense_index(df: DataFrame, key: str, buckets: int | None = None) -> DataFrame:
    """Adds row_index 0 … n - 1, in the order of each key's digest, and total = n.

    Buckets are ranges of the digest and are numbered in parallel; only their
    sizes are summed up in one place. The numbering is that of one global sort,
    so it is the same for any number of buckets.
    """
    placed = _placed(df, key, buckets)
    in_bucket = Window.partitionBy("bucket").orderBy("place", key)
    numbered = placed.withColumn("position", F.row_number().over(in_bucket) - 1)
    return numbered.join(_offsets(placed), "bucket").select(
        *df.columns, (F.col("offset") + F.col("position")).alias("row_index"), "total"
    )


def _drawn_rows(
    numbered: DataFrame, n: int | None, per_id: int | None, usual: int
) -> DataFrame:
    """(id, total): row numbers from 1 on, ``n`` of them or ``per_id`` for each numbered row."""
    if n is not None and per_id is not None:
        raise ValueError("either n or per_id")
    if per_id is None:
        n = usual if n is None else n
        total = numbered.select(F.max("total")).scalar()
        return numbered.sparkSession.range(1, n + 1).withColumn("total", total)
    steps = F.sequence(F.lit(1), F.lit(per_id))
    # A fixed number of parts: each numbered row becomes many, so a few small
    # partitions must not be merged into one task.
    parts = int(numbered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = numbered.select("total", "row_index").repartition(parts, "row_index")
    return spread.select("total", "row_index", F.explode(steps).alias("step")).select(
        (F.col("row_index") * per_id + F.col("step")).alias("id"), "total"
    )


def customers_numbered(numbers: DataFrame, seed: int = fixed.CUSTOMER_SEED) -> DataFrame:
    """A raw customer for every ``id`` of ``numbers``."""
    row, u = F.col("id"), [F.col(f"u{i}") for i in range(8)]
    hours = whole(u[0], fixed.SIGNUP_MAX_DAYS + 1) * 24 + whole(u[1], 24)
    inactive = F.when(
        F.col("segment") == "Free", F.lit(fixed.INACTIVE_SHARE_FREE)
    ).otherwise(F.lit(fixed.INACTIVE_SHARE_OTHER))
    return with_draws(numbers.select("id"), seed, "id", 8).select(
        numbered_key(fixed.CUSTOMER_KEY, row).alias("customer_id"),
        pick(u[3], fixed.FIRST_NAMES).alias("first_name"),
        pick(u[4], fixed.LAST_NAMES).alias("last_name"),
        F.concat(F.lit("user"), row.cast("string"), F.lit("@example.com")).alias("email"),
        seconds_after(fixed.SIGNUP_START, hours * 3600).alias("signup_date"),
        pick(u[5], fixed.COUNTRIES).alias("country"),
        pick(u[6], fixed.CHANNELS).alias("acquisition_channel"),
        weighted_pick(u[2], fixed.SEGMENTS, fixed.SEGMENT_WEIGHTS).alias("segment"),
        u[7].alias("activity_draw"),
    ).select(
        "customer_id", "first_name", "last_name", "email", "signup_date", "country",
        "acquisition_channel", "segment",
        (F.col("activity_draw") > inactive).alias("is_active"),
    )


def customers(
    spark: SparkSession, n: int = fixed.SYNTHETIC_CUSTOMERS, seed: int = fixed.CUSTOMER_SEED
) -> DataFrame:
    """``n`` raw customers."""
    return customers_numbered(spark.range(1, n + 1), seed)


def _activity_time(u: Column) -> Column:
    first, end = map(datetime.fromisoformat, (fixed.ACTIVITY_START, fixed.ACTIVITY_END))
    span = int((end - first).total_seconds())
    return seconds_after(fixed.ACTIVITY_START, whole(u, span))


def events(
    ids: DataFrame,
    n: int | None = None,
    seed: int = fixed.EVENT_SEED,
    per_id: int | None = None,
) -> DataFrame:
    """Raw events spread evenly over the ``customer_id`` of ``ids``.

    ``n`` events, or ``per_id`` for each id on average; without either the usual
    number. No job runs to build it.
    """
    indexed = dense_index(ids.select("customer_id"), "customer_id")
    u = [F.col(f"u{i}") for i in range(5)]
    rows = _drawn_rows(indexed, n, per_id, fixed.SYNTHETIC_EVENTS)
    drawn = with_draws(rows, seed, "id", 5).select(
        numbered_key(fixed.EVENT_KEY, F.col("id")).alias("event_id"),
        whole(u[0], F.col("total")).alias("row_index"),
        _activity_time(u[1]).alias("event_timestamp"),
        weighted_pick(u[2], fixed.EVENT_TYPES, fixed.EVENT_WEIGHTS).alias("event_type"),
        weighted_pick(u[3], fixed.PLATFORMS, fixed.PLATFORM_WEIGHTS).alias("platform"),
        numbered_key(fixed.SESSION_KEY, whole(u[4], fixed.SESSION_COUNT) + 1).alias("session_id"),
    )
    return drawn.join(indexed, "row_index").select(
        "event_id", "customer_id", "event_timestamp", "event_type", "platform", "session_id"
    )


def payments(
    paying: DataFrame,
    n: int | None = None,
    seed: int = fixed.PAYMENT_SEED,
    per_id: int | None = None,
) -> DataFrame:
    """Raw payments spread evenly over paying customers (id and segment), counted like events."""
    named = paying.select("customer_id", F.col("segment").alias("plan"))
    indexed = dense_index(named, "customer_id")
    u = [F.col(f"u{i}") for i in range(5)]
    rows = _drawn_rows(indexed, n, per_id, fixed.SYNTHETIC_PAYMENTS)
    drawn = with_draws(rows, seed, "id", 5).select(
        numbered_key(fixed.PAYMENT_KEY, F.col("id")).alias("payment_id"),
        whole(u[0], F.col("total")).alias("row_index"),
        _activity_time(u[1]).alias("payment_timestamp"),
        pick(u[2], fixed.PRICE_MULTIPLES).alias("multiple"),
        weighted_pick(u[3], fixed.CURRENCIES, fixed.CURRENCY_WEIGHTS).alias("currency"),
        weighted_pick(u[4], fixed.STATUSES, fixed.STATUS_WEIGHTS).alias("status"),
    )
    price = F.coalesce(
        *[F.when(F.col("plan") == plan, F.lit(usd)) for plan, usd in fixed.PLAN_PRICES.items()]
    )
    return drawn.join(indexed, "row_index").select(
        "payment_id",
        "customer_id",
        "payment_timestamp",
        (price * F.col("multiple")).cast("decimal(12,2)").alias("amount"),
        "currency",
        "status",
        "plan",
    )
