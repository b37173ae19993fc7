"""Active users kept up to date: each run reads its own days and the state before them.

Runs are accepted by one line in a log, as in the publishing job, so a run that stopped
halfway leaves nothing behind that a reader or the next run sees; it may be repeated.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom import fixed_values as fixed
from metricloom.operators import activity, star, trailing
from metricloom.sources import tables as store

WINDOWS = {"dau": 1, "wau": fixed.WEEK_DAYS, "mau": fixed.MONTH_DAYS}


def home_of(root: str) -> str:
    return f"{root.rstrip('/')}/active_users"


def _through(run_id: str) -> datetime.date:
    return datetime.date.fromisoformat(run_id.removeprefix("through-"))


def counted_through(spark: SparkSession, root: str) -> datetime.date | None:
    """The last day that an accepted run has counted."""
    run_id = store.current_run(spark, home_of(root))
    return None if run_id is None else _through(run_id)


def run_days(
    spark: SparkSession,
    events: DataFrame,
    root: str,
    first: datetime.date,
    last: datetime.date,
    windows: dict[str, int] | None = None,
    flags: dict[str, Column] | None = None,
    only: dict[str, str] | None = None,
    anchors: str = activity.EVENT_DAYS,
    day: str = "event_date",
    key: str = "customer_id",
) -> DataFrame:
    """Count the days first … last and carry the state on; returns their counts.

    The days must follow those counted before without a gap (``first`` is free for the
    first run). Of ``events`` only these days are read, so on facts partitioned by day
    only their files. Rows that turn up later for a day already counted are not counted:
    a day is final once accepted. ``only`` maps columns of ``windows`` to names of
    ``flags``, conditions on the rows; they and the windows must stay the same from run
    to run. Counts have one row per day with events or, with
    ``anchors='calendar'``, per day.
    """
    windows, flags, only = windows or WINDOWS, flags or {}, only or {}
    if last < first:
        raise ValueError(f"the run ends on {last}, before it starts on {first}")
    home, run_id = home_of(root), f"through-{last.isoformat()}"
    before = counted_through(spark, root)
    if before is not None and first != before + datetime.timedelta(days=1):
        raise ValueError(f"days are counted through {before}; a run may not start on {first}")

    seen = events.where(F.col(day).between(F.lit(first), F.lit(last)))
    pairs = activity.active_pairs(seen, day, key, flags)
    if before is not None:
        state = store.published(spark, home, "state", f"through-{before.isoformat()}")
        pairs = pairs.unionByName(state)
    # Read by the counts and by the next state.
    pairs = store.write_run_table(pairs, home, run_id, "pairs")
    calendar = None
    if anchors == activity.CALENDAR:
        calendar = star.day_spine(spark, F.lit(first), F.lit(last))
    counts = trailing.counts_after(pairs, first, last, windows, only, anchors, calendar)
    counts = store.write_run_table(counts, home, run_id, "counts")
    state = trailing.next_state(pairs, last, max(windows.values()), list(flags))
    store.write_run_table(state, home, run_id, "state")
    store.accept(spark, home, run_id)
    return counts


def daily_counts(spark: SparkSession, root: str) -> DataFrame:
    """The counts of all accepted runs: a row per day."""
    home = home_of(root)
    # One line per run, and a run counts whole days.
    ids = [r.run_id for r in store.accepted_runs(spark, home).select("run_id").collect()]
    if not ids:
        raise LookupError(f"no accepted run under {home}")
    return spark.read.parquet(*[store.run_path(home, i, "counts") for i in sorted(ids)])
