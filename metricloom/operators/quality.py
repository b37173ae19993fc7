"""Data-quality checks, source freshness and the publishing gate."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Unique:
    """No value occurs twice; nulls are ignored."""

    table: str
    column: str

    @property
    def name(self) -> str:
        return f"unique_{self.table}_{self.column}"


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str

    @property
    def name(self) -> str:
        return f"not_null_{self.table}_{self.column}"

    def fails(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedValues:
    """Every value is one of the list; null passes."""

    table: str
    column: str
    values: Sequence[str]

    @property
    def name(self) -> str:
        return f"accepted_values_{self.table}_{self.column}"

    def fails(self) -> Column:
        return ~F.col(self.column).isin(list(self.values))


@dataclass(frozen=True)
class RateMissing:
    """Every row with an amount has one in US dollars too."""

    table: str
    column: str = "amount_usd"

    @property
    def name(self) -> str:
        return f"fx_rate_missing_{self.table}"

    def fails(self) -> Column:
        return F.col("amount_local").isNotNull() & F.col(self.column).isNull()


@dataclass(frozen=True)
class Typed:
    """No text was left over when the column was landed with a type."""

    table: str
    column: str

    @property
    def text(self) -> str:
        return f"{self.column}_text"

    @property
    def name(self) -> str:
        return f"typed_{self.table}_{self.column}"

    def fails(self) -> Column:
        return F.col(self.text).isNotNull()


@dataclass(frozen=True)
class Relationship:
    """Every non-null value exists in the parent table."""

    table: str
    column: str
    parent: str
    parent_column: str

    @property
    def name(self) -> str:
        return f"relationships_{self.table}_{self.column}__{self.parent}_{self.parent_column}"


Check = Unique | NotNull | AcceptedValues | RateMissing | Typed | Relationship


def duplicated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .where("n_records > 1")
    )


@dataclass(frozen=True)
class Keyed:
    """Rows of a table to count by key: all of them, or those of a condition, by name."""

    df: DataFrame
    key: str
    counts: dict[str, Column | None]


def counted_by_key(parts: Sequence[Keyed]) -> DataFrame:
    """``key_value`` and, per named count, the rows that have the key.

    The tables are put below each other and grouped once: each is scanned once, keys are
    summed where they stand, and one shuffle moves a row per key and task. Children and
    parents, unique and missing keys can all be told from the counts.
    """
    names = [name for part in parts for name in part.counts]

    def rows(part: Keyed) -> DataFrame:
        own = {
            name: F.lit(1) if condition is None else F.coalesce(condition, F.lit(False)).cast("int")
            for name, condition in part.counts.items()
        }
        return part.df.select(
            F.col(part.key).alias("key_value"),
            *[own.get(name, F.lit(0)).cast("long").alias(name) for name in names],
        )

    return (
        union_all(rows(part) for part in parts)
        .groupBy("key_value")
        .agg(*[F.sum(name).alias(name) for name in names])
    )


def _rows_without(child: str, parent: str, with_nulls: bool) -> Column:
    """Child rows whose key no parent row has; a null key has no parent."""
    missing = F.col("key_value").isNotNull() & (F.col(parent) == 0)
    if with_nulls:
        missing = F.col("key_value").isNull() | (F.col(parent) == 0)
    return F.coalesce(F.sum(F.when(missing, F.col(child))), F.lit(0))


def excess(name: str) -> Column:
    """From counts by key: rows minus distinct values; a null counts as excess."""
    value = F.col("key_value").isNotNull() & (F.col(name) > 0)
    return F.coalesce(F.sum(name), F.lit(0)) - F.count_if(value)


def lines_of(counted: DataFrame, lines: dict[str, Column]) -> DataFrame:
    """One named line of a report for each aggregate of a table, from one pass."""
    row = counted.agg(*[value.alias(f"c{i}") for i, value in enumerate(lines.values())])
    pairs = [
        F.struct(F.lit(name).alias("check_name"), F.col(f"c{i}").cast("long").alias("failures"))
        for i, name in enumerate(lines)
    ]
    return row.select(F.explode(F.array(*pairs)).alias("line")).select("line.*")


def parentless_rows(child: str, parent: str) -> Column:
    """From counts by key: child rows a left join would leave without a parent."""
    return _rows_without(child, parent, with_nulls=True)


def unmatched_rows(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child rows without a parent row: what a left join would leave without a key."""
    counted = counted_by_key(
        [Keyed(child, column, {"child": None}), Keyed(parent, parent_column, {"parent": None})]
    )
    return counted.agg(parentless_rows("child", "parent").alias("failures"))


def orphan_rows(child: str, parent: str) -> Column:
    """From counts by key: child rows with a key that the parent lacks."""
    return _rows_without(child, parent, with_nulls=False)


def relationship_lines(tables: dict[str, DataFrame], checks: Sequence[Relationship]) -> DataFrame:
    """The lines of relationships that share a child's key, in one grouped pass."""
    child = checks[0]
    parents = list(dict.fromkeys((c.parent, c.parent_column) for c in checks))
    at = {parent: f"parent_{i}" for i, parent in enumerate(parents)}
    parts = [Keyed(tables[child.table], child.column, {"child": None})]
    parts += [Keyed(tables[p], column, {at[p, column]: None}) for p, column in parents]
    return lines_of(
        counted_by_key(parts),
        {c.name: orphan_rows("child", at[c.parent, c.parent_column]) for c in checks},
    )


def excess_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows minus distinct values; a null counts as excess."""
    return df.agg((F.count("*") - F.countDistinct(column)).alias("failures"))


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.agg(
        F.coalesce(F.sum(F.col(column).isNull().cast("int")), F.lit(0)).alias("failures")
    )


def report_line(check: str, counted: DataFrame) -> DataFrame:
    """One named line of a report from a one-row count."""
    return counted.select(F.lit(check).alias("check_name"), F.col("failures").cast("long"))


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def run_checks(tables: dict[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """``check_name, failures`` for every check.

    Row conditions on one table share a single scan and a single aggregate;
    relationships of one column share a grouped pass; uniqueness takes one each.
    """
    checks = list(checks)
    row_checks: dict[str, list[NotNull | AcceptedValues | RateMissing | Typed]] = {}
    related: dict[tuple[str, str], list[Relationship]] = {}
    lines = []
    for check in checks:
        match check:
            case Unique():
                failing = duplicated_values(tables[check.table], check.column)
                lines.append(report_line(check.name, failing.agg(F.count("*").alias("failures"))))
            case Relationship():
                related.setdefault((check.table, check.column), []).append(check)
            case _:
                row_checks.setdefault(check.table, []).append(check)
    for table, group in row_checks.items():
        lines.append(lines_of(tables[table], {c.name: F.count_if(c.fails()) for c in group}))
    lines += [relationship_lines(tables, group) for group in related.values()]
    return union_all(lines)


def source_freshness(
    df: DataFrame, source: str, loaded_at: str, hours: tuple[int, int], as_of: Column
) -> DataFrame:
    """Age of the newest row and pass, warn or error; an empty source is an error."""
    warn_hours, error_hours = hours
    now = as_of.cast("timestamp_ntz")
    age = now - F.col("max_loaded_at")
    seconds = (
        F.extract(F.lit("DAY"), age) * 86400
        + F.extract(F.lit("HOUR"), age) * 3600
        + F.extract(F.lit("MINUTE"), age) * 60
        + F.extract(F.lit("SECOND"), age)
    )
    newest = df.agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("max_loaded_at"))
    return newest.select(
        F.lit(source).alias("source_name"),
        "max_loaded_at",
        F.round(seconds.cast("double") / 3600, 4).alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull(), "error")
        .when(age > F.make_dt_interval(hours=F.lit(error_hours)), "error")
        .when(age > F.make_dt_interval(hours=F.lit(warn_hours)), "warn")
        .otherwise("pass")
        .alias("status"),
    )


class QualityError(RuntimeError):
    """A check failed; nothing was published."""


def require_no_failures(report: DataFrame) -> None:
    """Stop when any check failed. The report has one row per check."""
    failed = report.where("failures > 0").orderBy("check_name").collect()
    if failed:
        detail = ", ".join(f"{row.check_name}: {row.failures}" for row in failed)
        raise QualityError(f"failed checks: {detail}")


def require_fresh(report: DataFrame) -> None:
    """Stop when a source is in error; a warning goes on."""
    late = report.where("status = 'error'").orderBy("source_name").collect()
    if late:
        detail = ", ".join(f"{row.source_name}: newest {row.max_loaded_at}" for row in late)
        raise QualityError(f"sources too old: {detail}")
