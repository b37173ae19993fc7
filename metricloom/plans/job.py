"""One run: freshness, staging, star schema, marts, checks, publish.

Every table is written to the run's own folder and read back by the next step.
The checks read the written tables; only when all pass is the run accepted, which
makes it the one that readers find. A failed run changes nothing a reader sees and
may be run again under the same id.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom import fixed_values as fixed
from metricloom.operators import activity, quality, staging, star
from metricloom.plans import marts
from metricloom.sources import files, quarantine, schemas
from metricloom.sources import tables as store

RAW_CHECKS: list[quality.Check] = [
    quality.Unique("raw_crm_customers", "customer_id"),
    quality.NotNull("raw_crm_customers", "customer_id"),
    quality.NotNull("raw_crm_customers", "email"),
    quality.Unique("raw_app_events", "event_id"),
    quality.NotNull("raw_app_events", "event_id"),
    quality.NotNull("raw_app_events", "customer_id"),
    quality.Unique("raw_payments", "payment_id"),
    quality.NotNull("raw_payments", "payment_id"),
    *[
        quality.Typed(table, column)
        for table, types in schemas.TYPES.items()
        for column in types
    ],
]
MODEL_CHECKS: list[quality.Check] = [
    quality.Unique("dim_customers", "customer_sk"),
    quality.NotNull("dim_customers", "customer_sk"),
    quality.Unique("dim_customers", "customer_id"),
    quality.NotNull("dim_customers", "customer_id"),
    quality.AcceptedValues("dim_customers", "segment", fixed.SEGMENTS),
    quality.Unique("fct_payments", "payment_id"),
    quality.NotNull("fct_payments", "payment_id"),
    quality.Relationship("fct_payments", "customer_sk", "dim_customers", "customer_sk"),
    quality.Unique("kpi_daily_active_users", "date_day"),
    quality.NotNull("kpi_daily_active_users", "date_day"),
]
# Checks of our own that report without stopping a run.
EXTRA_CHECKS: list[quality.Check] = [
    quality.NotNull("fct_events", "customer_sk"),
    quality.NotNull("fct_payments", "customer_sk"),
    # A key is only set where the customer exists; this one can fail.
    quality.Relationship("fct_payments", "customer_id", "dim_customers", "customer_id"),
    quality.RateMissing("fct_payments"),
]

TAGS = {"kpi": ["dashboard", "executive"]}


def load_raw(
    spark: SparkSession,
    folder: str,
    root: str,
    ds: str,
    keep_bad: bool = False,
    quoted_line_ends: bool = False,
) -> dict[str, DataFrame]:
    """Land one run date's CSV extracts as Parquet and read them back.

    The text is parsed and typed once; staging, checks and freshness then read
    only the columns they need. ``keep_bad`` lands rows that do not parse as well, for
    a run that sets bad rows apart; ``quoted_line_ends`` takes values that hold line ends.
    """
    raw = {}
    for name, df in files.read_raw(spark, folder, keep_bad, quoted_line_ends).items():
        path = f"{root.rstrip('/')}/raw/{name}"
        files.land(files.typed(df, schemas.TYPES[name]), path, ds)
        raw[name] = files.read_landed(spark, path, ds, ds).drop("ds")
    return raw


def check_freshness(raw: dict[str, DataFrame], as_of: Column) -> DataFrame:
    """Age and status of the event and payment sources."""
    return quality.union_all(
        [
            quality.source_freshness(
                raw["raw_app_events"], "events", "event_timestamp",
                fixed.FRESHNESS_HOURS["events"], as_of,
            ),
            quality.source_freshness(
                raw["raw_payments"], "payments", "payment_timestamp",
                fixed.FRESHNESS_HOURS["payments"], as_of,
            ),
        ]
    )


def run(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    root: str,
    run_id: str,
    as_of: datetime.datetime | None = None,
    start: str = fixed.REPORT_START,
    anchors: str = activity.EVENT_DAYS,
    strict_segments: bool = False,
    freshness: bool = True,
    max_rejected_share: float | None = None,
) -> DataFrame:
    """Build, check and publish every table; returns the check report.

    A raw value without a typed form stops the run. With ``max_rejected_share`` such rows
    are set apart in ``raw_rejected.<source>`` with their reasons and the run goes on with
    the others, unless they are a larger share of a source; the report has their number.

    ``root`` is a folder that all executors share. ``as_of`` stands for now; with
    a zone it is turned into UTC, in which all times are.
    """
    if not re.fullmatch(r"[A-Za-z0-9_\-]+", run_id):
        raise ValueError(f"run_id may hold letters, digits, - and _ only: {run_id!r}")
    if store.was_accepted(spark, root, run_id):
        raise ValueError(f"run {run_id!r} is accepted; its files stay as they are")
    now = utc(as_of or datetime.datetime.now(datetime.timezone.utc))
    moment = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    if freshness:
        quality.require_fresh(check_freshness(raw, moment))

    def write(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        return store.write_run_table(df, root, run_id, name, partition_by)

    rejected = None
    if max_rejected_share is not None:
        raw, rejected = set_apart(spark, raw, max_rejected_share, write)

    customers = staging.stage_customers(raw["raw_crm_customers"], strict_segments, moment)
    events = staging.stage_events(raw["raw_app_events"], moment)
    payments = staging.stage_payments(raw["raw_payments"], loaded_at=moment)
    customers = write(customers, "staging.stg_crm_customers")
    events = write(events, "staging.stg_app_events")
    payments = write(payments, "staging.stg_payments")

    dim_customers = write(star.dim_customers(customers, moment), "core.dim_customers")
    today = now.date().isoformat()
    write(
        star.dim_date(
            spark,
            min(fixed.CALENDAR_FIRST_DAY, start),
            max(fixed.CALENDAR_LAST_DAY, today),
        ),
        "core.dim_date",
    )
    unknown = write(star.unknown_customers(events, dim_customers), "unknown_customers")
    fct_events = write(
        star.fct_events_except(events, unknown, spread=True), "core.fct_events", "event_date"
    )
    fct_payments = write(
        star.fct_payments(payments, dim_customers, spread=True),
        "core.fct_payments",
        "payment_month",
    )

    active_users = write(
        marts.kpi_daily_active_users(fct_events, start, today, anchors=anchors),
        "kpi.kpi_daily_active_users",
    )
    write(marts.kpi_revenue_by_segment(fct_payments), "kpi.kpi_revenue_by_segment")
    write(marts.kpi_funnel_conversion(dim_customers, fct_events), "kpi.kpi_funnel_conversion")

    checked = {
        **raw,
        "dim_customers": dim_customers,
        "fct_events": fct_events,
        "fct_payments": fct_payments,
        "kpi_daily_active_users": active_users,
    }
    gating = [
        check
        for check in RAW_CHECKS + MODEL_CHECKS
        if not isinstance(check, quality.Typed) or check.text in raw[check.table].columns
    ]
    lines = quality.run_checks(checked, gating + EXTRA_CHECKS)
    if rejected is not None:
        lines = lines.unionByName(rejected)
    report = write(lines, "checks")
    quality.require_no_failures(
        report.where(F.col("check_name").isin([check.name for check in gating]))
    )

    publish_run(spark, root, run_id)
    return report


def set_apart(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    max_share: float,
    write: Callable[[DataFrame, str], DataFrame],
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The sources without their bad rows, and a report line for each with their number.

    Bad rows are written first and counted from there. A source of which more than
    ``max_share`` is bad stops the run.
    """
    if not 0 <= max_share <= 1:
        raise ValueError(f"a share is between 0 and 1: {max_share!r}")
    kept, counts, above = dict(raw), [], []
    for name, types in schemas.TYPES.items():
        source = raw[name]
        if not quarantine.can_reject(source, types):
            continue
        bad = write(quarantine.rejected_rows(source, types), f"raw_rejected.{name}")
        n_bad, n = bad.count(), source.count()
        counts.append((f"rejected_{name}", n_bad))
        if n_bad > max_share * n:
            above.append(f"{name}: {n_bad} of {n}")
        kept[name] = quarantine.accepted_rows(source, types)
    if above:
        raise quality.QualityError(f"too many rejected rows: {', '.join(above)}")
    return kept, spark.createDataFrame(counts, "check_name string, failures long")


def utc(moment: datetime.datetime) -> datetime.datetime:
    """A moment without zone, in UTC."""
    if moment.tzinfo is None:
        return moment
    return moment.astimezone(datetime.timezone.utc).replace(tzinfo=None)


PUBLISHED = [
    "staging.stg_crm_customers",
    "staging.stg_app_events",
    "staging.stg_payments",
    "core.dim_customers",
    "core.dim_date",
    "core.fct_events",
    "core.fct_payments",
    "kpi.kpi_daily_active_users",
    "kpi.kpi_revenue_by_segment",
    "kpi.kpi_funnel_conversion",
]


def publish_run(spark: SparkSession, root: str, run_id: str) -> None:
    """Make a run the current one; also the way back to an earlier one.

    The catalog's names are moved first, table by table; readers of ``published``
    and ``attach`` follow the log, whose line comes last and holds for the whole run.
    """
    _name_tables(spark, root, run_id)
    store.accept(spark, root, run_id)


def attach(spark: SparkSession, root: str) -> str:
    """Name the current run's tables in this session's catalog; returns the run's id."""
    run_id = store.current_run(spark, root)
    if run_id is None:
        raise LookupError(f"no accepted run under {root}")
    _name_tables(spark, root, run_id)
    return run_id


def _name_tables(spark: SparkSession, root: str, run_id: str) -> None:
    store.ensure_layers(spark)
    for name in PUBLISHED:
        store.name_table(spark, root, run_id, name, TAGS.get(name.split(".")[0], ()))
