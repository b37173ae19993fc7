"""Exact distinct keys per day and over trailing windows of days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EVENT_DAYS = "event_days"
CALENDAR = "calendar"


def distinct_days(df: DataFrame, day: str) -> DataFrame:
    """The days that occur in the data."""
    return df.select(day).distinct()


def daily_distinct(df: DataFrame, day: str, key: str, name: str) -> DataFrame:
    """Distinct keys of each day."""
    return df.groupBy(day).agg(F.countDistinct(key).alias(name))


def rolling_distinct(
    df: DataFrame,
    day: str,
    key: str,
    windows: dict[str, int],
    calendar: DataFrame | None = None,
    anchors: str = EVENT_DAYS,
    only: dict[str, Column] | None = None,
) -> DataFrame:
    """Distinct keys active in the trailing ``n`` days, for every window at once.

    ``windows`` maps an output column to its width; width 1 is the daily count.
    ``only`` maps some of these columns to a condition on the rows: they count keys
    with such a row in the window, from the same pass over the same pairs.
    Without a calendar the result has one row per day of the data
    (``anchors='event_days'``) or per day from the first to the last day of the
    data (``anchors='calendar'``), found in the same pass. With one (a DataFrame
    of ``date_day``), it has one row per calendar day, and days without data show
    0 (``anchors='event_days'``) or the true trailing count
    (``anchors='calendar'``).

    A key enters a window on an active day that no earlier active day still
    covers and leaves it ``n`` days after one that no later active day
    prolongs, so a trailing count is entries so far minus exits so far. That
    needs each key's active days in order and nothing else: no range join and
    no row per (event, window day). Rows are reduced to distinct (key, day)
    before they are moved, so a key or a day holding a third of the rows is
    no larger than any other; from the daily counters on there is at most a
    handful of rows per calendar day.
    """
    if anchors not in (EVENT_DAYS, CALENDAR):
        raise ValueError(f"anchors must be {EVENT_DAYS!r} or {CALENDAR!r}, not {anchors!r}")

    counters = _daily_counters(df, day, key, windows, only or {})
    changes = counters.select(F.explode(_changes(windows)).alias("change")).select("change.*")
    if calendar is not None:
        changes = changes.unionByName(_quiet_days(calendar, windows))

    # One row per day and window by now: the running sum in a single task is
    # bounded by the length of the calendar, whatever the number of events or
    # keys. The range frames take all rows of a day together.
    by_day = Window.orderBy("on_day")
    so_far = by_day.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    same_day = by_day.rangeBetween(Window.currentRow, Window.currentRow)
    counts = {name: F.sum(name).over(so_far) for name in windows}
    if calendar is None and anchors == CALENDAR:
        return _every_day(changes, counts, by_day)
    if calendar is None:
        running = changes.select("on_day", "has_data", *_named(counts))
        return running.where("has_data").select(F.col("on_day").alias(day), *windows)

    if anchors == EVENT_DAYS:
        any_data = F.max("has_data").over(same_day)
        counts = {
            name: F.when(any_data, count).otherwise(F.lit(0).cast("long"))
            for name, count in counts.items()
        }
    running = changes.select("on_day", "in_calendar", *_named(counts))
    return running.where("in_calendar").select(F.col("on_day").alias("date_day"), *windows)


def _every_day(changes: DataFrame, counts: dict[str, Column], by_day) -> DataFrame:
    """Counts of each day of the data's span: a day's hold until the next change."""
    whole = by_day.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = F.max(F.when(F.col("has_data"), F.col("on_day"))).over(whole)
    held = changes.select(
        "on_day",
        F.lead("on_day").over(by_day).alias("next_day"),
        last.alias("last_day"),
        *_named(counts),
    )
    until = F.least(F.date_sub("next_day", 1), F.col("last_day"))
    return held.where(F.col("on_day") <= until).select(
        F.explode(F.sequence("on_day", until)).alias("date_day"), *counts
    )


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def active_pairs(
    df: DataFrame, day: str, key: str, flags: dict[str, Column] | None = None
) -> DataFrame:
    """(on_day, key): the distinct pairs of the data; each flag holds if it does in some row."""
    pairs = df.select(
        F.col(day).alias("on_day"),
        F.col(key).alias("key"),
        *[F.coalesce(flag, F.lit(False)).alias(name) for name, flag in (flags or {}).items()],
    ).where(F.col("on_day").isNotNull())
    if not flags:
        return pairs.distinct()
    return pairs.groupBy("on_day", "key").agg(*[F.max(name).alias(name) for name in flags])


def _daily_counters(
    df: DataFrame, day: str, key: str, windows: dict[str, int], only: dict[str, Column]
) -> DataFrame:
    """Per day and window: keys that start and keys that end a covered stretch.

    For a window with a condition, the days before and after are those that meet it:
    lag and lead pass over the others, in the same sort.
    """
    active = active_pairs(df, day, key, {f"only_{name}": flag for name, flag in only.items()})
    of_key = Window.partitionBy("key").orderBy("on_day")
    today = F.col("on_day")
    in_order = "IGNORE NULLS OVER (PARTITION BY key ORDER BY on_day)"
    # A null key is never counted, but its days still are days with data.
    gaps = active.select(
        "on_day",
        F.col("key").isNotNull().alias("counted"),
        F.datediff(today, F.lag(today).over(of_key)).alias("since"),
        F.datediff(F.lead(today).over(of_key), today).alias("until"),
        *[F.col(f"only_{name}") for name in only],
        *[
            F.expr(f"abs(datediff(on_day, {step}(if(only_{name}, on_day, null)) {in_order}))").alias(
                f"{gap}_{name}"
            )
            for name in only
            for gap, step in (("since", "lag"), ("until", "lead"))
        ],
    )

    def outside(gap: str, name: str, width: int) -> Column:
        counted = F.col("counted")
        if name in only:
            gap, counted = f"{gap}_{name}", counted & F.col(f"only_{name}")
        return F.count_if(counted & (F.col(gap).isNull() | (F.col(gap) >= F.lit(width))))

    return gaps.groupBy("on_day").agg(
        *[outside("since", name, n).alias(f"enter_{name}") for name, n in windows.items()],
        *[outside("until", name, n).alias(f"leave_{name}") for name, n in windows.items()],
    )


def _change(day: Column, amounts: dict[str, Column], has_data: bool, in_calendar: bool) -> Column:
    return F.struct(
        day.alias("on_day"),
        *[amount.cast("long").alias(name) for name, amount in amounts.items()],
        F.lit(has_data).alias("has_data"),
        F.lit(in_calendar).alias("in_calendar"),
    )


def _changes(windows: dict[str, int]) -> Column:
    """A day's entries on that day, and its exits on the day each window ends."""
    today, none = F.col("on_day"), F.lit(0)
    entries = {name: F.col(f"enter_{name}") for name in windows}
    exits = [
        _change(
            F.date_add(today, width),
            {other: -F.col(f"leave_{name}") if other == name else none for other in windows},
            has_data=False,
            in_calendar=False,
        )
        for name, width in windows.items()
    ]
    return F.array(_change(today, entries, has_data=True, in_calendar=False), *exits)


def _quiet_days(calendar: DataFrame, windows: dict[str, int]) -> DataFrame:
    row = _change(
        F.col("date_day"), {name: F.lit(0) for name in windows}, has_data=False, in_calendar=True
    )
    return calendar.select(row.alias("change")).select("change.*")


def fill_calendar(
    calendar: DataFrame, measures: list[tuple[DataFrame, str]], fill: int = 0
) -> DataFrame:
    """Left join daily measures to the calendar; missing values become ``fill``.

    Each measure is a DataFrame and the name of its day column. Both sides have
    at most one row per day.
    """
    filled = calendar.select("date_day")
    for measure, day in measures:
        names = [c for c in measure.columns if c != day]
        right = measure.withColumnRenamed(day, "date_day")
        filled = filled.join(right, "date_day", "left").fillna(fill, subset=names)
    return filled
