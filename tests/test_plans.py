"""The shapes the plans must keep, and behaviour with a hot key."""

import pytest
from pyspark.sql import functions as F

from metricloom.operators import activity, funnel, revenue, staging, star
from metricloom.plans.registry import REGISTRY
from metricloom.sources import files

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_slow_operators(spark, name):
    text = plan(REGISTRY[name](spark, FOLDER))
    for slow in ("CartesianProduct", "NestedLoop", "PythonUDF", "ArrowEval", "InPandas"):
        assert slow not in text


def test_scans_read_only_needed_columns(spark):
    text = plan(REGISTRY["dau"](spark, FOLDER))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text
    text = plan(REGISTRY["kpi_daily_active_users"](spark, FOLDER))
    assert text.count("FileScan") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text


def test_day_ranges_reach_the_files(spark):
    text = plan(REGISTRY["filter_date_between"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate,1997-03-01T00:00)" in text
    assert "LessThan(o_orderdate,1998-03-01T00:00)" in text
    text = plan(REGISTRY["kpi_daily_active_users"](spark, FOLDER))
    assert "GreaterThanOrEqual(ts,2023-11-26" in text and "LessThan(ts,2024-02-06" in text


def test_one_date_lands_without_a_shuffle(spark, tmp_path):
    files.land(spark.range(0, 100, 1, 3).toDF("n"), str(tmp_path / "l"), "2026-01-01")
    assert len(files.read_landed(spark, str(tmp_path / "l")).inputFiles()) == 3


def test_signup_join_goes_away_when_unused(spark):
    text = plan(REGISTRY["fct_events"](spark, FOLDER))
    assert "orders.parquet" not in text


def test_stored_facts_push_filters_down(spark, tmp_path):
    facts = REGISTRY["fct_payments"](spark, FOLDER)
    facts.write.parquet(str(tmp_path / "f"))
    text = plan(revenue.monthly_revenue(spark.read.parquet(str(tmp_path / "f"))))
    assert "EqualTo(is_recognized_revenue,true)" in text


def test_payments_are_summed_before_the_join(spark):
    text = plan(REGISTRY["kpi_revenue_by_segment"](spark, FOLDER))
    join = text.index("Join [customer_id")
    assert "partial_sum(amount_usd" in text[join:]


@pytest.mark.parametrize(
    "name", ["dq_unique", "dq_unique_summary", "dq_not_null", "filter_date_between", "stg_payments"]
)
def test_rates_need_no_join(spark, name):
    assert "Join" not in plan(REGISTRY[name](spark, FOLDER))


def test_unused_dollars_are_not_read(spark):
    text = plan(REGISTRY["dq_unique"](spark, FOLDER))
    assert "ReadSchema: struct<o_custkey:bigint>" in text
    assert "currency" not in plan(REGISTRY["dq_relationships_payments"](spark, FOLDER))


def _executed(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_number_of_scans_and_shuffles(spark):
    text = _executed(REGISTRY["active_buyers_calendar"](spark, FOLDER))
    assert text.count("FileScan") == 1
    text = _executed(REGISTRY["headline_tiles"](spark, FOLDER))
    assert text.count("FileScan") <= 2
    assert text.count("Exchange ") - text.count("ReusedExchange ") <= 7
    text = _executed(REGISTRY["dq_relationships_payments"](spark, FOLDER))
    assert text.count("FileScan") - text.count("ReusedExchange") <= 4


def test_relationships_of_a_key_take_one_shuffle(spark):
    for name, scans in (("dq_relationships_payments", 4), ("dq_orphan_event_sk", 2), ("dq_report", 3)):
        text = _executed(REGISTRY[name](spark, FOLDER))
        assert text.count("FileScan") <= scans, name
        assert "Join" not in text
        by_key = [x for x in text.splitlines() if "hashpartitioning(key_value" in x]
        assert len(by_key) == 1, name


def test_synthetic_rows_are_planned_without_a_job(spark):
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "")
    REGISTRY["synth_events"](spark, FOLDER)
    REGISTRY["synth_payments"](spark, FOLDER)
    started = jobs.getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Reading the files' schema is a job of its own; counting rows would be a second.
    assert len(started) <= 2


def test_a_table_of_rates_is_checked(spark):
    payments = spark.range(3).selectExpr(
        "id as payment_id", "id as customer_id", "'2024-01-01' as payment_timestamp",
        "'2' as amount", "' eur' as currency", "'x' as status", "'pro' as plan",
    )
    good = spark.createDataFrame([("EUR", 2), ("USD", 1)], "currency string, n int").selectExpr(
        "currency", "cast(n as decimal(5,4)) as usd_rate"
    )
    staged = staging.stage_payments(payments, good)
    assert {str(r.amount_usd) for r in staged.collect()} == {"4.000000"}
    with pytest.raises(ValueError):
        staging.stage_payments(payments, good.unionByName(good))
    assert str(staging.stage_payments(payments).first().amount_usd) == "2.160000"


@pytest.fixture
def no_broadcast(spark):
    keep = {
        name: spark.conf.get(name)
        for name in (
            "spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.shuffle.partitions",
        )
    }
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "100KB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    for name, value in keep.items():
        spark.conf.set(name, value)


def _hot_events(spark, rows=120_000):
    """Half of the events belong to one customer, half of them to one day."""
    n = F.col("id")
    return spark.range(0, rows, 1, 16).select(
        n.cast("string").alias("event_id"),
        F.when(n % 2 == 0, "hot").otherwise(F.concat(F.lit("c"), n % 5000)).alias("customer_id"),
        F.timestamp_add(
            "SECOND",
            F.when(n % 3 == 0, 0).otherwise((n % 40) * 86400).cast("int"),
            F.lit("2024-01-01").cast("timestamp_ntz"),
        ).alias("event_at"),
        F.when(n % 5 == 0, "activated").otherwise("page_view").alias("event_type"),
        F.lit("web").alias("platform"),
        F.md5(n.cast("string")).alias("session_id"),
        F.lit(1).alias("funnel_step"),
    )


def _dim(spark):
    n = F.col("id")
    ids = F.when(n == 0, "hot").otherwise(F.concat(F.lit("c"), n))
    return spark.range(0, 5000).select(
        ids.alias("customer_id"), F.md5(ids).alias("customer_sk"),
        F.lit("2024-01-01").cast("date").alias("signup_month"),
    )


def test_hot_customer_is_split_in_the_fact_join(spark, no_broadcast):
    facts = star.fct_events(_hot_events(spark), _dim(spark))
    assert len(facts.collect()) == 120_000
    assert "SortMergeJoin(skew=true)" in plan(facts)


def test_told_the_unknown_customers_events_stay_where_they_are(spark, tmp_path):
    events = _hot_events(spark, 6000)
    dim = _dim(spark).where("customer_id not in ('c1', 'c2001', 'c3')")
    events = events.unionByName(events.limit(5).withColumn("customer_id", F.lit(None)))
    unknown = star.unknown_customers(events, dim)
    unknown.write.parquet(str(tmp_path / "u"))
    listed = spark.read.parquet(str(tmp_path / "u"))
    assert sorted(r[0] for r in listed.collect()) == ["c1", "c2001", "c3"]
    facts = star.fct_events_except(events, listed)
    assert "BroadcastHashJoin [customer_id" in plan(facts)
    expected = star.fct_events(events, dim)
    assert facts.exceptAll(expected).count() == 0 and expected.exceptAll(facts).count() == 0


def test_many_unknown_customers_are_split_too(spark, no_broadcast):
    facts = star.fct_events_except(_hot_events(spark), _dim(spark).select("customer_id"))
    assert sum(row.customer_sk is None for row in facts.collect()) == 120_000
    assert "SortMergeJoin(skew=true)" in plan(facts)


def test_hot_day_is_split_before_a_partitioned_write(spark, no_broadcast):
    facts = star.fct_events(_hot_events(spark), _dim(spark), spread=True)
    assert len(facts.collect()) == 120_000
    assert "AQEShuffleRead coalesced and skewed" in plan(facts) or "AQEShuffleRead skewed" in plan(
        facts
    )


def test_hot_key_results_are_whole(spark, no_broadcast):
    events = _hot_events(spark).withColumn("event_date", F.col("event_at").cast("date"))
    windows = {"dau": 1, "wau": 7}
    rolled = activity.rolling_distinct(events, "event_date", "customer_id", windows)
    pairs = {(r[0], r[1]) for r in events.select("event_date", "customer_id").distinct().collect()}
    for row in rolled.collect():
        assert row.dau == sum(d == row.event_date for d, _ in pairs)
        seen = {c for d, c in pairs if 0 <= (row.event_date - d).days < 7}
        assert row.wau == len(seen)
    reached = funnel.customer_milestones(_dim(spark), events)
    assert reached.count() == 5000
    assert reached.where("did_activate = 1 and customer_id = 'hot'").count() == 1
