"""Trailing distinct counts carried forward from a small state, day by day.

The state holds, for each key active in the widest window, only its last active day
and the last day on which each flag held. That is all that later windows can see of
the days before: a key is in the window of a later day if its last day is. So the
state's rows and the new days' pairs together give the counts of the new days, by
the same pass as counting all days anew, and no earlier event is read again.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricloom.operators import activity


def next_state(pairs: DataFrame, last: datetime.date, widest: int, flags: list[str]) -> DataFrame:
    """(on_day, key, flags): of each key's pairs in the window that ends on last, the latest.

    One row per key, and one more for each flag that last held on another day. Null
    keys are never counted and not carried.
    """
    of_key = Window.partitionBy("key")
    latest = F.col("on_day") == F.max("on_day").over(of_key)
    for name in flags:
        held = F.max(F.when(F.col(name), F.col("on_day"))).over(of_key)
        latest = latest | (F.col(name) & (F.col("on_day") == held))
    first = last - datetime.timedelta(days=widest - 1)
    return (
        pairs.where(F.col("key").isNotNull() & F.col("on_day").between(F.lit(first), F.lit(last)))
        .withColumn("_kept", latest)
        .where("_kept")
        .drop("_kept")
    )


def counts_after(
    pairs: DataFrame,
    first: datetime.date,
    last: datetime.date,
    windows: dict[str, int],
    only: dict[str, str],
    anchors: str = activity.EVENT_DAYS,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """(on_day, windows): counts of the days first … last from state and new pairs together.

    ``only`` maps columns of ``windows`` to the flag that they count by.
    """
    conditions: dict[str, Column] = {name: F.col(flag) for name, flag in only.items()}
    counts = activity.rolling_distinct(
        pairs, "on_day", "key", windows, calendar, anchors, conditions
    )
    day = counts.columns[0]
    return counts.where(F.col(day).between(F.lit(first), F.lit(last))).withColumnRenamed(
        day, "on_day"
    )
