"""Small column helpers shared by the operators that stay in DataFrame functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space between words, and line-end stripping.
SPACE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

TOTAL_BLOCK = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def running_totals(numbers: Column) -> Column:
    """Sums up to and with each element, by sums of blocks, not by a growing list."""

    def summed(xs: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor(F.size(xs) / TOTAL_BLOCK).cast("int")),
            lambda b: total(F.slice(xs, b * TOTAL_BLOCK + 1, TOTAL_BLOCK)),
        )
        return let(
            blocks,
            lambda sums: F.transform(
                xs,
                lambda _, i: total(F.slice(sums, F.lit(1), F.floor(i / TOTAL_BLOCK).cast("int")))
                + total(
                    F.slice(
                        xs,
                        (F.floor(i / TOTAL_BLOCK) * TOTAL_BLOCK + 1).cast("int"),
                        i % TOTAL_BLOCK + 1,
                    )
                ),
            ),
        )

    return let(numbers, summed)


def without_places(items: Column, places: Column) -> Column:
    """The items, in order, that are not at one of the places; linear in both."""
    every = F.filter(F.sequence(F.lit(0), F.size(items)), lambda i: i < F.size(items))
    return F.transform(F.array_except(every, places), lambda i: F.get(items, i))


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """The wanted names, lengthened until no column has them (names differ in more than case)."""
    have, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in have:
            name += "_"
        have.add(name.lower())
        out.append(name)
    return out


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words between white space, in order; empty for a text without words."""
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")
