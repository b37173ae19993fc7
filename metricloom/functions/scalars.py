"""Scalar expressions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from metricloom import fixed_values as fixed

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower_code(c: ColumnLike) -> Column:
    """Trimmed lower-case code."""
    return F.lower(F.trim(_col(c)))


def upper_code(c: ColumnLike) -> Column:
    """Trimmed upper-case code."""
    return F.upper(F.trim(_col(c)))


def capitalise(c: ColumnLike) -> Column:
    """First letter upper, the rest lower, spaces kept as they are."""
    c = _col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def normal_segment(c: ColumnLike) -> Column:
    """Title-case segment; unknown names survive so a check can report them."""
    return F.initcap(F.trim(_col(c)))


def strict_segment(c: ColumnLike) -> Column:
    """The known segment equal to ``c`` in any case, spaces counted, else null."""
    c = _col(c)
    return F.coalesce(*[F.when(c.ilike(name), F.lit(name)) for name in fixed.SEGMENTS])


def parse_flag(c: ColumnLike) -> Column:
    """True for the accepted true words in any case; everything else is false."""
    word = F.lower(_col(c).cast("string"))
    return F.coalesce(word.isin(fixed.TRUE_WORDS), F.lit(False))


def surrogate_key(c: ColumnLike) -> Column:
    """Hex md5 of the key's text."""
    return F.md5(_col(c).cast("string"))


def numbered_key(pattern: str, number: ColumnLike) -> Column:
    """Formatted key of a number; null stays null."""
    number = _col(number)
    return F.when(number.isNotNull(), F.format_string(pattern, number))


def funnel_step(event_type: ColumnLike) -> Column:
    """Position of a cleaned event type in the signup funnel, else null."""
    event_type = _col(event_type)
    steps = list(fixed.FUNNEL_STEPS.items())
    first_type, first_step = steps[0]
    return reduce(
        lambda chain, step: chain.when(event_type == step[0], F.lit(step[1])),
        steps[1:],
        F.when(event_type == first_type, F.lit(first_step)),
    )


def event_flag(event_type: ColumnLike, wanted: str) -> Column:
    """1 where the event is of the wanted type, else 0 (also for null)."""
    return F.coalesce((_col(event_type) == wanted).cast("int"), F.lit(0))


def within_days(moment: ColumnLike, first: ColumnLike, last: ColumnLike) -> Column:
    """Whether a time falls on the days first … last, as a range the files can be pruned by."""
    moment = _col(moment)
    start = _col(first).cast("date").cast("timestamp_ntz")
    end = F.date_add(_col(last).cast("date"), 1).cast("timestamp_ntz")
    return (moment >= start) & (moment < end)


def month_of(day: ColumnLike) -> Column:
    """First day of the month, as a date."""
    return F.trunc(_col(day), "month")


def tenure_days(start: ColumnLike, as_of: ColumnLike) -> Column:
    """Calendar days between two times: 23:00 to 01:00 next day is one day."""
    return F.datediff(_col(as_of).cast("date"), _col(start).cast("date"))


def ratio(
    part: ColumnLike, whole: ColumnLike, digits: int, when_zero: float | None = None
) -> Column:
    """``part / whole`` in double precision, rounded; ``when_zero`` if whole is 0."""
    part, whole = _col(part).cast("double"), _col(whole).cast("double")
    return F.when(whole == 0, F.lit(when_zero).cast("double")).otherwise(
        F.round(part / whole, digits)
    )
