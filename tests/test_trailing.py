"""Trailing counts carried forward against counting all days anew and by hand."""

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from metricloom.operators import activity
from metricloom.plans import daily_users
from metricloom.sources import tables as store

FIRST = datetime.date(2024, 2, 20)
SCHEMA = "event_date date, customer_id string, step int"
WINDOWS = {"dau": 1, "wau": 7, "mau": 30, "engaged": 1, "engaged_wau": 7, "engaged_mau": 30}
ONLY = {"engaged": "paid", "engaged_wau": "paid", "engaged_mau": "paid"}


def on(n):
    return FIRST + datetime.timedelta(days=n)


def flags():
    return {"paid": F.col("step") >= 4}


def made_up(seed, days=45, uneven=False):
    """Users that come and go, quiet days, null users and steps, one user with a third of the rows."""
    draw = random.Random(seed)
    rows = []
    for d in range(days):
        if d in (10, 11, 12, 25):
            continue
        for _ in range(draw.randint(1, 12)):
            who = draw.choice([None, *(f"u{i}" for i in range(15))])
            rows.append((on(d), who, draw.choice([None, 1, 2, 4, 5])))
        if uneven:
            rows += [(on(d), "hot", draw.choice([1, 5]))] * draw.randint(0, 10)
    return rows + rows[:20]


def by_hand(rows, days, calendar=False):
    with_data = {d for d, _, _ in rows}
    out = {}
    for n in range(days):
        if on(n) not in with_data and not calendar:
            continue
        row = []
        for name, width in WINDOWS.items():
            seen = [r for r in rows if on(n - width) < r[0] <= on(n) and r[1] is not None]
            if name in ONLY:
                seen = [r for r in seen if r[2] is not None and r[2] >= 4]
            row.append(len({r[1] for r in seen}))
        out[on(n)] = tuple(row)
    return out


def result(df):
    return {r[0]: tuple(r[1:]) for r in df.select("on_day", *WINDOWS).collect()}


@pytest.mark.parametrize("seed", [1, 3])
def test_conditions_from_one_pass(spark, seed):
    rows = made_up(seed, uneven=seed == 3)
    events = spark.createDataFrame(rows, SCHEMA)
    only = {name: F.col("step") >= 4 for name in ONLY}
    got = activity.rolling_distinct(events, "event_date", "customer_id", WINDOWS, only=only)
    assert result(got.withColumnRenamed("event_date", "on_day")) == by_hand(rows, 45)


@pytest.mark.parametrize(
    "anchors,uneven", [(activity.EVENT_DAYS, True), (activity.CALENDAR, False)]
)
def test_folded_equals_counting_by_hand(spark, tmp_path, anchors, uneven):
    rows = made_up(7, uneven=uneven)
    events = spark.createDataFrame(rows, SCHEMA)
    root, at = str(tmp_path), 0
    for days in (1, 1, 11, 22, 10):
        counts = daily_users.run_days(
            spark, events, root, on(at), on(at + days - 1), WINDOWS, flags(), ONLY, anchors
        )
        part = {r[0] for r in counts.collect()}
        assert part <= {on(n) for n in range(at, at + days)}
        at += days
    assert daily_users.counted_through(spark, root) == on(44)
    expected = by_hand(rows, 45, calendar=anchors == activity.CALENDAR)
    assert result(daily_users.daily_counts(spark, root)) == expected


def run(spark, events, root, first, last, **more):
    return daily_users.run_days(spark, events, root, on(first), on(last), WINDOWS, flags(), ONLY, **more)


def test_a_run_reads_its_own_days_and_a_small_state(spark, tmp_path):
    rows = made_up(5, uneven=True)
    events = spark.createDataFrame(rows, SCHEMA)
    events.write.partitionBy("event_date").parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    root = str(tmp_path / "root")
    run(spark, facts, root, 0, 39)
    home = daily_users.home_of(root)
    state = store.published(spark, home, "state")
    # One row per key, and at most one more for the flag.
    assert state.count() <= 2 * len({r[1] for r in rows if r[1]})
    assert state.agg(F.min("on_day")).first()[0] >= on(10)
    # With all other days' files gone the next day's run still gives the same.
    for folder in (tmp_path / "facts").glob("event_date=*"):
        if folder.name != f"event_date={on(40)}":
            for file in folder.iterdir():
                file.unlink()
            folder.rmdir()
    facts = spark.read.schema(facts.schema).parquet(str(tmp_path / "facts"))
    got = result(run(spark, facts, root, 40, 40))
    assert got == {on(40): by_hand(rows, 45)[on(40)]}


def test_only_the_days_partitions_are_planned(spark, tmp_path):
    events = spark.createDataFrame(made_up(5), SCHEMA)
    events.write.partitionBy("event_date").parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    seen = facts.where(F.col("event_date").between(F.lit(on(40)), F.lit(on(40))))
    plan = activity.active_pairs(seen, "event_date", "customer_id", flags())
    text = plan._jdf.queryExecution().executedPlan().toString()
    (filters,) = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", text)
    assert f">= {on(40)}" in filters and f"<= {on(40)}" in filters


def test_days_follow_each_other(spark, tmp_path):
    events = spark.createDataFrame(made_up(6), SCHEMA)
    root = str(tmp_path)
    with pytest.raises(LookupError):
        daily_users.daily_counts(spark, root)
    run(spark, events, root, 3, 9)
    for first, last in ((9, 10), (11, 12), (0, 2), (10, 9)):
        with pytest.raises(ValueError):
            run(spark, events, root, first, last)
    # Days without events carry the state on.
    assert run(spark, events, root, 10, 12).collect() == []
    assert daily_users.counted_through(spark, root) == on(12)


def test_a_run_that_stopped_halfway_may_be_repeated(spark, tmp_path, monkeypatch):
    rows = made_up(8)
    events = spark.createDataFrame(rows, SCHEMA)
    root = str(tmp_path)
    run(spark, events, root, 0, 20)

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(store, "accept", stop)
        with pytest.raises(RuntimeError):
            run(spark, events.limit(3), root, 21, 21)
    assert daily_users.counted_through(spark, root) == on(20)
    run(spark, events, root, 21, 44)
    assert result(daily_users.daily_counts(spark, root)) == by_hand(rows, 45)


def test_no_events_at_all(spark, tmp_path):
    events = spark.createDataFrame([], SCHEMA)
    assert run(spark, events, str(tmp_path), 0, 3).collect() == []
    empty = run(spark, events, str(tmp_path), 4, 5, anchors=activity.CALENDAR)
    assert result(empty) == {on(4): (0,) * 6, on(5): (0,) * 6}
