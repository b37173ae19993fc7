"""Rows with values that have no typed form: set apart with their reasons, not lost.

``files.typed`` keeps a text that it could not cast beside its column, and a reader
that keeps bad rows leaves the text of a row that did not parse. Both are split off
here; a gate bounds their share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The text of a row with too few or too many values, as the CSV reader keeps it.
BAD_ROW = "_corrupt_record"
# Reason of such a row; other reasons are names of columns.
WHOLE_ROW = "row"


def _reasons(df: DataFrame, types: dict[str, str]) -> dict[str, Column]:
    """Reason to its condition, for the columns that the table has."""
    found = {
        name: F.col(f"{name}_text").isNotNull() for name in types if f"{name}_text" in df.columns
    }
    if BAD_ROW in df.columns:
        found[WHOLE_ROW] = F.col(BAD_ROW).isNotNull()
    return found


def _helpers(df: DataFrame, types: dict[str, str]) -> list[str]:
    names = [f"{name}_text" for name in types] + [BAD_ROW]
    return [name for name in names if name in df.columns]


def can_reject(df: DataFrame, types: dict[str, str]) -> bool:
    """Whether the table carries anything that a row may be rejected by."""
    return bool(_reasons(df, types))


def accepted_rows(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The rows without a leftover text, without the columns for leftovers."""
    good = F.lit(True)
    for bad in _reasons(df, types).values():
        good = good & ~bad
    return df.where(good).drop(*_helpers(df, types))


def rejected_rows(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The other rows, all columns as they are, and their reasons in order of name."""
    reasons = _reasons(df, types)
    named = [F.when(reasons[name], F.lit(name)) for name in sorted(reasons)]
    listed = F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")
    return df.withColumn("reasons", listed).where(F.size("reasons") > 0)
