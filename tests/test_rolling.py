"""Trailing distinct counts against counting by hand."""

import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from metricloom.operators import activity, star

FIRST = datetime.date(2024, 2, 20)
SCHEMA = "day date, who string"


def on(n):
    return FIRST + datetime.timedelta(days=n)


def frame(spark, pairs):
    return spark.createDataFrame([(None if d is None else on(d), w) for d, w in pairs], SCHEMA)


def by_hand(pairs, anchor, width):
    return len(
        {w for d, w in pairs if w and d is not None and anchor - width < d <= anchor}
    )


def result(df):
    return {row[0]: tuple(row[1:]) for row in df.collect()}


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(0, 45)), st.sampled_from([None, "a", "b", "c", "d"])
        ),
        max_size=40,
    ),
    st.integers(1, 31),
)
def test_any_data_any_width(spark, pairs, width):
    df = frame(spark, pairs)
    windows = {"one": 1, "many": width}
    days = {d for d, _ in pairs if d is not None}
    plain = activity.rolling_distinct(df, "day", "who", windows)
    expected = {on(d): (by_hand(pairs, d, 1), by_hand(pairs, d, width)) for d in days}
    assert result(plain) == expected

    calendar = star.day_spine(spark, str(on(-5)), str(on(60)))
    trailing = activity.rolling_distinct(
        df, "day", "who", windows, calendar, activity.CALENDAR
    )
    assert result(trailing) == {
        on(d): (by_hand(pairs, d, 1), by_hand(pairs, d, width)) for d in range(-5, 61)
    }
    on_event_days = activity.rolling_distinct(df, "day", "who", windows, calendar)
    assert result(on_event_days) == {on(d): expected.get(on(d), (0, 0)) for d in range(-5, 61)}


@pytest.mark.parametrize("width, last_in", [(7, 6), (30, 29)])
def test_window_edges(spark, width, last_in):
    calendar = star.day_spine(spark, str(on(0)), str(on(40)))
    df = frame(spark, [(0, "a"), (last_in, "b"), (last_in + 1, "b")])
    counts = result(
        activity.rolling_distinct(df, "day", "who", {"n": width}, calendar, activity.CALENDAR)
    )
    assert counts[on(last_in)] == (2,)
    assert counts[on(last_in + 1)] == (1,)


def test_calendar_may_start_inside_the_data(spark):
    df = frame(spark, [(0, "a"), (3, "b"), (9, "a")])
    calendar = star.day_spine(spark, str(on(5)), str(on(8)))
    counts = result(
        activity.rolling_distinct(df, "day", "who", {"n": 7}, calendar, activity.CALENDAR)
    )
    assert counts == {on(5): (2,), on(6): (2,), on(7): (1,), on(8): (1,)}


def test_null_keys_mark_days_and_count_nothing(spark):
    df = frame(spark, [(0, "a"), (3, None), (None, "z")])
    assert result(activity.rolling_distinct(df, "day", "who", {"dau": 1, "wau": 7})) == {
        on(0): (1, 1),
        on(3): (0, 1),
    }


def test_width_one_is_the_daily_count(spark):
    pairs = [(d % 11, f"u{d * 7 % 5}") for d in range(100)]
    df = frame(spark, pairs)
    daily = activity.daily_distinct(df, "day", "who", "n")
    assert result(activity.rolling_distinct(df, "day", "who", {"n": 1})) == result(daily)


def test_unknown_anchor_rule(spark):
    df = frame(spark, [(0, "a")])
    with pytest.raises(ValueError):
        activity.rolling_distinct(df, "day", "who", {"n": 7}, anchors="weekly")


def test_every_day_of_the_data_in_one_pass(spark):
    pairs = [(d, f"u{d * 7 % 5}") for d in (0, 1, 1, 9, 9, 10, 30, 31, 50)] + [(40, None), (9, "u1")]
    df = frame(spark, pairs)
    windows = {"dau": 1, "wau": 7, "mau": 30}
    spine = star.day_spine(spark, str(on(0)), str(on(50)))
    expected = activity.rolling_distinct(df, "day", "who", windows, spine, activity.CALENDAR)
    got = activity.rolling_distinct(df, "day", "who", windows, anchors=activity.CALENDAR)
    assert result(got) == result(expected) and len(result(got)) == 51
    assert activity.rolling_distinct(
        df.limit(0), "day", "who", windows, anchors=activity.CALENDAR
    ).collect() == []


def test_gap_fill_keeps_every_day(spark):
    calendar = star.day_spine(spark, str(on(0)), str(on(2)))
    measure = frame(spark, [(1, "a"), (1, "b")]).groupBy("day").agg(F.count("*").alias("n"))
    assert result(activity.fill_calendar(calendar, [(measure, "day")])) == {
        on(0): (0,), on(1): (2,), on(2): (0,),
    }
