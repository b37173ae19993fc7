"""Allow and block rules for addresses, found by a sort-merge range join.

A rule names a host and the start of a path; it fits the host and its subdomains.
With labels reversed (org.example.www) a rule is the interval of keys that start
with it. Per reversed host, rules and addresses are sorted together by path; the
sweep carries the last rule seen with the stack of rules around it, and an
address takes the innermost rule of that stack that its path starts with. The
stack of a rule does not depend on the addresses, so it is made once, from the
rules alone, and a busy host's sweep can be cut into as many parts as its
addresses need, each with that host's rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricloom.llm.columns import lower_ascii
from metricloom.llm.storage import stored

ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
ROWS_PER_SWEEP = 1000
DEFAULT_VERDICT = "allow"

# Verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, ADDRESS, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, ADDRESS, 2), F.lit(""))


def _reversed(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def rule_stacks(rules: DataFrame) -> DataFrame:
    """Per rule its reversed host, path, and the stack of rules it lies in, innermost last.

    Rules without a host are left out, a null path is the empty one, and of rules
    for the same host and path block wins.
    """
    clean = (
        rules.where(F.col("host").isNotNull() & F.col("verdict").isNotNull())
        .select(
            F.col("verdict"),
            lower_ascii(F.col("host")).alias("host"),
            F.coalesce("path", F.lit("")).alias("path"),
        )
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            _reversed(F.col("host")).alias("key"),
            "path",
            F.struct(
                (F.length("host") + F.length("path")).alias("size"),
                F.length("host").alias("host_size"),
                "path",
                F.concat("host", "path").alias("rule"),
                "verdict",
            ).alias("entry"),
        )
    )
    around = clean.select("key", F.col("path").alias("outer"), F.col("entry").alias("above"))
    starts = clean.withColumn(
        "outer",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.length("path")),
                lambda n: F.substring(F.col("path"), F.lit(1), n),
            )
        ),
    )
    return (
        starts.join(around, ["key", "outer"])
        .groupBy("key", "path")
        .agg(F.array_sort(F.collect_list("above")).alias("stack"))
    )


def judge(
    addresses: DataFrame, rules: DataFrame, rows_per_sweep: int = ROWS_PER_SWEEP
) -> DataFrame:
    """(host, path, rule, verdict) of each distinct address that a rule fits."""
    stacks = stored(rule_stacks(rules), "rule-stacks")
    deepest = stacks.agg(F.max(F.size(F.split("key", r"\.")))).first()[0] or 0
    labels = F.reverse(F.split("host", r"\."))
    keys = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(deepest, 1)))),
        lambda n: F.array_join(F.slice(labels, F.lit(1), n), "."),
    )
    # Written tables on both sides leave each join free to split a busy host.
    near = stored(
        addresses.select("host", "path")
        .distinct()
        .withColumn("key", F.explode(keys))
        .join(stacks.select("key").distinct(), "key", "left_semi"),
        "addresses-near-rules",
    )
    parts = stored(
        near.groupBy("key").agg(
            F.ceil(F.count("*") / rows_per_sweep).cast("int").alias("parts")
        ),
        "sweep-parts",
    )
    sized = near.join(parts, "key")
    points = sized.select(
        "key",
        F.pmod(F.xxhash64("host", "path"), F.col("parts")).cast("int").alias("part"),
        "path",
        F.lit(1).alias("is_address"),
        "host",
        F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"),
    )
    starts = stacks.join(parts, "key").select(
        "key",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        "path",
        F.lit(0).alias("is_address"),
        F.lit(None).cast("string").alias("host"),
        "stack",
    )
    sweep = (
        Window.partitionBy("key", "part")
        .orderBy("path", "is_address")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    fits = F.filter("open", lambda e: F.startswith(F.col("path"), e["path"]))
    return (
        points.unionByName(starts)
        .withColumn("open", F.last("stack", ignorenulls=True).over(sweep))
        .where("is_address = 1")
        .withColumn("fit", F.array_max(fits))
        .where(F.col("fit").isNotNull())
        .groupBy("host", "path")
        .agg(F.max("fit").alias("fit"))
        .select("host", "path", "fit.rule", "fit.verdict")
    )


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    default: str = DEFAULT_VERDICT,
    rows_per_sweep: int = ROWS_PER_SWEEP,
) -> DataFrame:
    """Per row of pages: page_id, host, path, rule and verdict.

    A null url or one without `://` has empty host and path; where no rule fits,
    rule is null and verdict the default. Of several fitting rules the longest
    text wins, then the longer host. Null page ids and repeated rows stay rows of
    their own; other columns are left out. An empty rule table gives the default.
    """
    placed = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    # A written table on this side leaves the join free to split a repeated address.
    judged = stored(judge(placed, rules, rows_per_sweep), "judged-addresses")
    return placed.join(judged, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )
