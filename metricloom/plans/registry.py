"""Every checked query: a name and a function of (session, table folder).

Each reads whole tables. Money is computed in decimals and shown as double, so
that results of two engines can be compared value by value.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom import fixed_values as fixed
from metricloom import functions as fn
from metricloom.operators import activity, funnel, quality, revenue, staging, star
from metricloom.plans import daily_users, marts, serving
from metricloom.sources import files, quarantine, schemas, synthetic
from metricloom.sources import sample_tables as sample
from metricloom.sources import tables as store

Query = Callable[[SparkSession, str], DataFrame]

# Fixed report parameters; the sample events run over January 2024.
AS_OF = "2024-01-31 12:00:00"
AS_OF_EARLIER = "2024-01-31 06:00:00"
# Steps of the funnel from which on a user counts as engaged.
ENGAGED_STEP = 4
# Runs that the folded count is made in.
FOLDS = 3
REPORT_FIRST = "2023-12-25"
REPORT_LAST = "2024-02-05"
RANGE_FIRST, RANGE_LAST = "1997-03-01", "1998-02-28"
RECENT_MONTH = "2000-01-01"
RECENT_COHORT = "1996-01-01"
EVENTS_PER_CUSTOMER = 30
PAYMENTS_PER_PAYING_CUSTOMER = 18

REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    REGISTRY[build.__name__] = build
    return build


def _as_of(moment: str = AS_OF):
    return F.lit(moment).cast("timestamp_ntz")


def _plain_money(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if f.dataType.typeName() == "decimal"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return star.dim_customers(
        staging.stage_customers(sample.raw_customers(spark, folder)), _as_of()
    )


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return staging.stage_events(sample.raw_events(spark, folder))


def _dated_events(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).withColumn("event_date", F.col("event_at").cast("date"))


def _payments(spark: SparkSession, folder: str) -> DataFrame:
    return staging.stage_payments(sample.raw_payments(spark, folder))


def _dated_payments(spark: SparkSession, folder: str) -> DataFrame:
    return _payments(spark, folder).withColumn("payment_date", F.col("paid_at").cast("date"))


def _payment_facts(spark: SparkSession, folder: str) -> DataFrame:
    return star.fct_payments(_payments(spark, folder), _customers(spark, folder))


def _monthly(spark: SparkSession, folder: str) -> DataFrame:
    return revenue.monthly_revenue_of(_payments(spark, folder), _customers(spark, folder))


def _active_users(spark: SparkSession, folder: str, anchors: str) -> DataFrame:
    return marts.kpi_daily_active_users(
        _dated_events(spark, folder),
        start=REPORT_FIRST,
        end=REPORT_LAST,
        anchors=anchors,
        moment="event_at",
    )


# --- sources -----------------------------------------------------------------


@query
def row_counts(spark, folder):
    sources = {
        "raw_crm_customers": sample.raw_customers(spark, folder),
        "raw_app_events": sample.raw_events(spark, folder),
        "raw_payments": sample.raw_payments(spark, folder),
    }
    return quality.union_all(
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in sources.items()
    )


@query
def filter_paying_customers(spark, folder):
    return files.paying_customers(
        staging.stage_customers(sample.raw_customers(spark, folder))
    )


@query
def fx_literal_relation(spark, folder):
    """The rates with the payments made in each currency."""
    used = (
        _payments(spark, folder)
        .groupBy("currency")
        .agg(F.count("*").alias("txn_count"), F.sum("amount_local").alias("amount_local"))
    )
    return _plain_money(staging.fx_rates(spark).join(used, "currency", "left"))


@query
def synth_keys(spark, folder):
    """Formatted keys and email for every order."""
    orders = sample.table(spark, folder, "orders")
    return orders.select(
        "o_orderkey",
        fn.numbered_key(fixed.CUSTOMER_KEY, "o_custkey").alias("customer_key"),
        fn.numbered_key(fixed.EVENT_KEY, "o_orderkey").alias("event_key"),
        fn.numbered_key(fixed.SESSION_KEY, "o_custkey").alias("session_key"),
        fn.numbered_key(fixed.PAYMENT_KEY, "o_orderkey").alias("payment_key"),
        F.concat(F.lit("user"), F.col("o_custkey").cast("string"), F.lit("@example.com")).alias(
            "email"
        ),
    )


def _synthetic_customers(spark: SparkSession, folder: str) -> DataFrame:
    customer = sample.table(spark, folder, "customer")
    return synthetic.customers_numbered(customer.select(F.col("c_custkey").alias("id")))


@query
def synth_customers(spark, folder):
    """A synthetic customer for every row of the customer table."""
    return _synthetic_customers(spark, folder)


@query
def synth_events(spark, folder):
    """Synthetic events of the synthetic customers, thirty for each on average."""
    ids = files.customer_ids(_synthetic_customers(spark, folder))
    return synthetic.events(ids, per_id=EVENTS_PER_CUSTOMER)


@query
def synth_payments(spark, folder):
    """Synthetic payments of the paying synthetic customers."""
    paying = files.paying_customers(_synthetic_customers(spark, folder))
    return _plain_money(synthetic.payments(paying, per_id=PAYMENTS_PER_PAYING_CUSTOMER))


# --- scalars and staging -------------------------------------------------------


@query
def scalar_strings(spark, folder):
    return sample.raw_customers(spark, folder).select(
        "customer_id",
        F.trim("first_name").alias("trimmed"),
        fn.lower_code("email").alias("lowered"),
        fn.upper_code("country").alias("uppered"),
        fn.normal_segment("segment").alias("title_case"),
        fn.capitalise("acquisition_channel").alias("capitalised"),
    )


@query
def scalar_casts(spark, folder):
    raw = sample.raw_payments(spark, folder)
    amount = F.col("amount").cast(staging.MONEY)
    return raw.select(
        F.col("payment_id").cast("bigint").alias("payment_number"),
        F.col("payment_timestamp").cast("date").alias("payment_date"),
        F.col("payment_timestamp").cast("date").cast("string").alias("date_text"),
        F.col("payment_timestamp").cast("date").cast("timestamp_ntz").alias("day_start"),
        amount.cast("double").alias("amount_local"),
        (amount >= 100000).cast("int").alias("is_large"),
    )


@query
def bool_parse(spark, folder):
    return sample.raw_customers(spark, folder).select(
        "customer_id",
        F.col("is_active").alias("raw_text"),
        fn.parse_flag("is_active").alias("is_active"),
    )


@query
def segment_ilike_case(spark, folder):
    return sample.raw_customers(spark, folder).select(
        "customer_id", fn.strict_segment("segment").alias("segment")
    )


@query
def event_funnel_step(spark, folder):
    event_type = fn.lower_code("event_type")
    return sample.raw_events(spark, folder).select(
        "event_id", event_type.alias("event_type"), fn.funnel_step(event_type).alias("funnel_step")
    )


@query
def event_flags(spark, folder):
    return _events(spark, folder).select(
        "event_id",
        fn.event_flag("event_type", "page_view").alias("is_page_view"),
        fn.event_flag("event_type", "sign_up_completed").alias("is_signup"),
        fn.event_flag("event_type", "activated").alias("is_activation"),
        fn.event_flag("event_type", "upgraded").alias("is_upgrade"),
    )


@query
def stg_customers(spark, folder):
    return staging.stage_customers(sample.raw_customers(spark, folder))


@query
def stg_customers_strict(spark, folder):
    """Staging that maps unknown segments to null."""
    return staging.stage_customers(sample.raw_customers(spark, folder), strict=True)


@query
def stg_events(spark, folder):
    return _events(spark, folder)


@query
def stg_payments(spark, folder):
    return _plain_money(_payments(spark, folder))


@query
def payments_fx_usd(spark, folder):
    return _plain_money(
        _payments(spark, folder).select("payment_id", "currency", "amount_local", "amount_usd")
    )


# --- star schema -----------------------------------------------------------------


@query
def dim_date(spark, folder):
    """Calendar over the order dates, with the orders of each day."""
    per_day = (
        sample.table(spark, folder, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("order_day"))
        .agg(F.count("*").alias("orders"))
    )
    spine = star.day_spine_of(per_day, F.col("order_day"))
    return star.describe_days(activity.fill_calendar(spine, [(per_day, "order_day")]))


@query
def dim_customers(spark, folder):
    return _customers(spark, folder)


@query
def surrogate_key(spark, folder):
    return sample.raw_payments(spark, folder).select(
        "payment_id", fn.surrogate_key("customer_id").alias("customer_sk")
    )


@query
def tenure_days(spark, folder):
    return sample.raw_customers(spark, folder).select(
        "customer_id", fn.tenure_days("signup_date", _as_of()).alias("days_since_signup")
    )


@query
def fct_events(spark, folder):
    return star.fct_events(_events(spark, folder), _customers(spark, folder))


@query
def fct_payments(spark, folder):
    return _plain_money(_payment_facts(spark, folder))


@query
def filter_recognized_payments(spark, folder):
    return _plain_money(
        _payment_facts(spark, folder)
        .where("is_recognized_revenue")
        .select("payment_id", "customer_segment", "payment_date", "recognized_amount_usd")
    )


@query
def filter_date_between(spark, folder):
    days = fn.within_days("paid_at", F.lit(RANGE_FIRST), F.lit(RANGE_LAST))
    return _plain_money(
        _dated_payments(spark, folder)
        .where(days)
        .select("payment_id", "payment_date", "amount_local")
    )


# --- quarantine ---------------------------------------------------------------------


def _typed_payments(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[str, str]]:
    types = schemas.TYPES["raw_payments"]
    return files.typed(sample.payment_texts(spark, folder), types), types


@query
def quarantine_accepted(spark, folder):
    """Payments of which every text has a typed value."""
    return quarantine.accepted_rows(*_typed_payments(spark, folder)).withColumn(
        "amount", F.col("amount").cast("double")
    )


@query
def quarantine_rejected(spark, folder):
    """The others, with the texts that have none and the columns they stand in."""
    rejected = quarantine.rejected_rows(*_typed_payments(spark, folder))
    return rejected.select(
        "payment_id",
        "payment_timestamp_text",
        "amount_text",
        F.array_join("reasons", ",").alias("reasons"),
    )


# --- activity ----------------------------------------------------------------------


@query
def distinct_anchor_days(spark, folder):
    return activity.distinct_days(_dated_events(spark, folder), "event_date")


@query
def dau(spark, folder):
    return activity.daily_distinct(
        _dated_events(spark, folder), "event_date", "customer_id", "dau"
    )


def _rolling(spark: SparkSession, folder: str, windows: dict[str, int]) -> DataFrame:
    return activity.rolling_distinct(
        _dated_events(spark, folder), "event_date", "customer_id", windows
    )


def _with_engaged(spark: SparkSession, folder: str, name: str, width: int) -> DataFrame:
    """All users, and beside them those who activated or upgraded; from one pass."""
    engaged = f"engaged_{name}"
    return activity.rolling_distinct(
        _dated_events(spark, folder),
        "event_date",
        "customer_id",
        {name: width, engaged: width},
        only={engaged: F.col("funnel_step") >= ENGAGED_STEP},
    )


@query
def wau_rolling(spark, folder):
    return _with_engaged(spark, folder, "wau", fixed.WEEK_DAYS)


@query
def mau_rolling(spark, folder):
    return _with_engaged(spark, folder, "mau", fixed.MONTH_DAYS)


@query
def active_users_folded(spark, folder):
    """The events' days counted in three runs, each from the state the last one left."""
    events = _dated_events(spark, folder)
    first, last = events.agg(F.min("event_date"), F.max("event_date")).first()
    engaged = {"engaged_wau": fixed.WEEK_DAYS, "engaged_mau": fixed.MONTH_DAYS}
    root = store.new_root(spark, "folded")
    start = first
    for fold in range(1, FOLDS + 1):
        end = first + (last - first) * fold // FOLDS
        if end < start:
            continue
        daily_users.run_days(
            spark,
            events,
            root,
            start,
            end,
            daily_users.WINDOWS | engaged,
            {"engaged": F.col("funnel_step") >= ENGAGED_STEP},
            dict.fromkeys(engaged, "engaged"),
        )
        start = end + datetime.timedelta(days=1)
    return daily_users.daily_counts(spark, root).withColumnRenamed("on_day", "event_date")


@query
def dau_mau_joined(spark, folder):
    """Daily and monthly users side by side; one pass yields both, nothing to join."""
    both = _rolling(spark, folder, {"dau": 1, "mau": fixed.MONTH_DAYS})
    return marts.with_stickiness(both)


@query
def dau_mau_stickiness(spark, folder):
    both = _rolling(spark, folder, {"dau": 1, "mau": fixed.MONTH_DAYS})
    return both.select("event_date", fn.ratio("dau", "mau", 4, 0).alias("dau_mau_ratio"))


@query
def calendar_gap_fill(spark, folder):
    """Refunds, and payments without a dollar rate, on every day of the order dates."""
    payments = _dated_payments(spark, folder)
    refunds = (
        payments.where("status = 'refunded'")
        .groupBy("payment_date")
        .agg(F.count("*").alias("refunds"), F.countDistinct("customer_id").alias("customers"))
    )
    unrated = (
        payments.where("amount_usd is null")
        .groupBy("payment_date")
        .agg(F.count("*").alias("unrated"))
    )
    spine = star.day_spine_of(payments, F.col("payment_date"))
    return activity.fill_calendar(spine, [(refunds, "payment_date"), (unrated, "payment_date")])


@query
def kpi_daily_active_users(spark, folder):
    return _active_users(spark, folder, activity.EVENT_DAYS)


@query
def kpi_daily_active_users_calendar(spark, folder):
    """The same with true trailing counts on days without events."""
    return _active_users(spark, folder, activity.CALENDAR)


@query
def active_buyers(spark, folder):
    """Customers paying on the day and in the trailing 7 and 30 days; days with payments."""
    windows = {"buyers_1d": 1, "buyers_7d": fixed.WEEK_DAYS, "buyers_30d": fixed.MONTH_DAYS}
    return activity.rolling_distinct(
        _dated_payments(spark, folder), "payment_date", "customer_id", windows
    )


@query
def active_buyers_calendar(spark, folder):
    """The same on every day from the first to the last order."""
    windows = {"buyers_1d": 1, "buyers_7d": fixed.WEEK_DAYS, "buyers_30d": fixed.MONTH_DAYS}
    return activity.rolling_distinct(
        _dated_payments(spark, folder), "payment_date", "customer_id", windows,
        anchors=activity.CALENDAR,
    )


# --- revenue -------------------------------------------------------------------------


@query
def monthly_revenue(spark, folder):
    """From the payment facts, as a mart built on the stored facts does it."""
    return _plain_money(revenue.monthly_revenue(_payment_facts(spark, folder)))


@query
def revenue_prev_month(spark, folder):
    monthly = revenue.with_previous_month(_monthly(spark, folder))
    return _plain_money(
        monthly.select("month_start", "segment", "revenue_usd", "prev_month_revenue")
    )


@query
def revenue_mom_growth(spark, folder):
    grown = revenue.with_growth(revenue.with_previous_month(_monthly(spark, folder)))
    return grown.select("month_start", "segment", "mom_growth_pct")


@query
def arpu(spark, folder):
    return revenue.with_arpu(_monthly(spark, folder)).select(
        "month_start", "segment", "paying_customers", "arpu_usd"
    )


def _revenue_kpi(spark: SparkSession, folder: str) -> DataFrame:
    return marts.kpi_revenue_by_segment_of(_payments(spark, folder), _customers(spark, folder))


@query
def kpi_revenue_by_segment(spark, folder):
    return _plain_money(_revenue_kpi(spark, folder))


@query
def revenue_series(spark, folder):
    return _plain_money(serving.revenue_series(_revenue_kpi(spark, folder)))


@query
def revenue_by_month(spark, folder):
    return _plain_money(serving.revenue_by_month(_monthly(spark, folder)))


@query
def kpi_revenue_recent(spark, folder):
    return _plain_money(serving.revenue_since(_revenue_kpi(spark, folder), RECENT_MONTH))


# --- funnel ----------------------------------------------------------------------------


def _milestones(spark: SparkSession, folder: str) -> DataFrame:
    return funnel.customer_milestones(_customers(spark, folder), _events(spark, folder))


def _funnel_kpi(spark: SparkSession, folder: str) -> DataFrame:
    return marts.kpi_funnel_conversion(_customers(spark, folder), _events(spark, folder))


@query
def customer_milestones(spark, folder):
    return _milestones(spark, folder)


@query
def cohort_rollup(spark, folder):
    return funnel.cohort_rollup(_milestones(spark, folder))


@query
def funnel_rates(spark, folder):
    rated = funnel.with_funnel_rates(funnel.cohort_rollup(_milestones(spark, folder)))
    return rated.select(
        "cohort_month", "pct_started", "pct_completed", "pct_activated", "pct_upgraded",
        "completion_to_activation", "activation_to_upgrade",
    )


@query
def kpi_funnel_conversion(spark, folder):
    return _funnel_kpi(spark, folder)


@query
def kpi_funnel_recent(spark, folder):
    return serving.funnel_since(_funnel_kpi(spark, folder), RECENT_COHORT)


@query
def funnel_latest_cohort(spark, folder):
    return serving.funnel_latest_cohort(_funnel_kpi(spark, folder))


# --- quality -----------------------------------------------------------------------------


@query
def dq_unique(spark, folder):
    """Customers with more than one payment: the values a unique check would list."""
    return quality.duplicated_values(_payments(spark, folder), "customer_id")


@query
def dq_unique_summary(spark, folder):
    payments = _payments(spark, folder)
    return quality.union_all(
        quality.report_line(f"unique {c}", quality.excess_rows(payments, c))
        for c in ("payment_id", "customer_id")
    )


@query
def dq_not_null(spark, folder):
    tables = {"stg_payments": _payments(spark, folder), "stg_events": _events(spark, folder)}
    checks = [
        quality.NotNull("stg_payments", "payment_id"),
        quality.NotNull("stg_payments", "amount_usd"),
        quality.NotNull("stg_events", "event_id"),
        quality.NotNull("stg_events", "funnel_step"),
    ]
    return quality.run_checks(tables, checks)


@query
def dq_accepted_values(spark, folder):
    tables = {"dim_customers": _customers(spark, folder)}
    check = quality.AcceptedValues("dim_customers", "segment", fixed.SEGMENTS)
    return quality.run_checks(tables, [check])


@query
def dq_relationships_payments(spark, folder):
    """Payments without a customer, without a paying one, and without any event."""
    customers = _customers(spark, folder)
    tables = {
        "stg_payments": _payments(spark, folder),
        "dim_customers": customers,
        "paying_customers": customers.where("is_paying"),
        "stg_events": _events(spark, folder),
    }
    parents = ("dim_customers", "paying_customers", "stg_events")
    checks = [
        quality.Relationship("stg_payments", "customer_id", parent, "customer_id")
        for parent in parents
    ]
    return quality.run_checks(tables, checks)


@query
def dq_orphan_event_sk(spark, folder):
    """Events whose facts have no key, against all and against paying customers."""
    counted = quality.counted_by_key(
        [
            quality.Keyed(_events(spark, folder), "customer_id", {"events": None}),
            quality.Keyed(
                _customers(spark, folder), "customer_id", {"all": None, "paying": F.col("is_paying")}
            ),
        ]
    )
    return quality.lines_of(
        counted,
        {
            f"no orphan event customer_sk ({name})": quality.parentless_rows("events", name)
            for name in ("all", "paying")
        },
    )


@query
def source_freshness(spark, folder):
    events, payments = sample.raw_events(spark, folder), sample.raw_payments(spark, folder)
    late = fixed.FRESHNESS_HOURS
    return quality.union_all(
        [
            quality.source_freshness(
                events, "events", "event_timestamp", late["events"], _as_of()
            ),
            quality.source_freshness(
                events, "events, earlier", "event_timestamp", late["events"],
                _as_of(AS_OF_EARLIER),
            ),
            quality.source_freshness(
                payments, "payments", "payment_timestamp", late["payments"], _as_of()
            ),
        ]
    )


@query
def dq_report(spark, folder):
    """The summary lines; events are held against paying customers, so that one line fails."""
    by_customer = quality.counted_by_key(
        [
            quality.Keyed(
                _customers(spark, folder), "customer_id",
                {"customers": None, "paying": F.col("is_paying")},
            ),
            quality.Keyed(_events(spark, folder), "customer_id", {"events": None}),
        ]
    )
    payments = quality.excess_rows(_payments(spark, folder), "payment_id")
    names = fixed.REPORT_LINES
    lines = quality.lines_of(
        by_customer,
        {
            names["customers"]: quality.excess("customers"),
            names["events"]: quality.parentless_rows("events", "paying"),
        },
    )
    return lines.unionByName(quality.report_line(names["payments"], payments))


# --- serving --------------------------------------------------------------------------------


def _every_data_day(spark: SparkSession, folder: str, windows: dict[str, int]) -> DataFrame:
    """Trailing users with stickiness, on every day from the first event to the last."""
    users = activity.rolling_distinct(
        _dated_events(spark, folder), "event_date", "customer_id", windows,
        anchors=activity.CALENDAR,
    )
    return marts.with_stickiness(users)


@query
def latest_days_topk(spark, folder):
    windows = {"dau": 1, "wau": fixed.WEEK_DAYS, "mau": fixed.MONTH_DAYS}
    return serving.latest_days(_every_data_day(spark, folder, windows), 30)


@query
def headline_tiles(spark, folder):
    active = _every_data_day(spark, folder, {"dau": 1, "mau": fixed.MONTH_DAYS})
    return serving.headline_tiles(active, revenue.revenue_by_month_of(_payments(spark, folder)))
