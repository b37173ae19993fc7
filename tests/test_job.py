"""The whole run, from CSV files to published tables."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from metricloom.operators import quality
from metricloom.plans import job, marts, serving
from metricloom.sources import files, synthetic

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
AS_OF = datetime.datetime(2026, 5, 1, 2, 0)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("csv"))
    customers = synthetic.customers(spark, 400)
    events = synthetic.events(files.customer_ids(customers), 6000)
    payments = synthetic.payments(files.paying_customers(customers), 2000)
    # A wide last day keeps the small sources fresh whatever the draws were.
    late = F.lit("2026-04-30 23:30:00").cast("timestamp_ntz")
    events = events.withColumn(
        "event_timestamp",
        F.when(F.col("event_id") == "E000000001", late).otherwise(F.col("event_timestamp")),
    )
    payments = payments.withColumn(
        "payment_timestamp",
        F.when(F.col("payment_id") == "PAY000000001", late).otherwise(F.col("payment_timestamp")),
    )
    files.write_csv(customers, f"{folder}/raw_crm_customers.csv")
    files.write_csv(events, f"{folder}/raw_app_events.csv")
    files.write_csv(payments, f"{folder}/raw_payments.csv")
    raw = job.load_raw(spark, folder, str(tmp_path_factory.mktemp("landing")), "2026-05-01")
    assert {name: df.count() for name, df in raw.items()} == {
        "raw_crm_customers": 400,
        "raw_app_events": 6000,
        "raw_payments": 2000,
    }
    return raw


def test_publish_and_serve(spark, raw, tmp_path):
    report = job.run(spark, raw, str(tmp_path), "first", AS_OF)
    assert report.where("failures > 0").count() == 0
    assert report.count() == len(job.RAW_CHECKS + job.MODEL_CHECKS + job.EXTRA_CHECKS)

    users = spark.table("kpi.kpi_daily_active_users")
    assert users.count() == 486  # 2025-01-01 … 2026-05-01
    assert users.where("dau > wau or wau > mau").count() == 0
    facts = spark.table("core.fct_events")
    assert facts.count() == 6000
    per_day = facts.groupBy("event_date").agg(F.countDistinct("customer_id").alias("n"))
    wrong = users.join(per_day, users.date_day == per_day.event_date).where("dau <> n")
    assert wrong.count() == 0

    revenue = spark.table("kpi.kpi_revenue_by_segment")
    total = revenue.agg(F.sum("revenue_usd")).first()[0]
    facts_total = (
        spark.table("core.fct_payments").agg(F.sum("recognized_amount_usd")).first()[0]
    )
    assert total == facts_total
    cohorts = spark.table("kpi.kpi_funnel_conversion")
    assert cohorts.agg(F.sum("cohort_size")).first()[0] == 400
    assert serving.headline_tiles(users, serving.revenue_by_month(revenue)).count() == 4
    assert serving.funnel_latest_cohort(cohorts).count() == 1
    assert spark.table("staging.stg_payments").count() == 2000
    assert len(spark.table("core.dim_date").columns) == 12
    assert serving.latest_days(users).count() == 30
    assert serving.newest_revenue(revenue).count() == 12


def test_date_filter_reads_only_its_partitions(spark, raw, tmp_path):
    job.run(spark, raw, str(tmp_path), "pruned", AS_OF)
    day = spark.table("core.fct_events").where("event_date = date '2025-06-01'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan

    report = marts.kpi_daily_active_users(
        spark.table("core.fct_events"), "2026-03-01", "2026-03-31"
    )
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "(event_date#" in plan and ">= 2026-01-31)" in plan.split("PartitionFilters")[1]
    whole = spark.table("kpi.kpi_daily_active_users")
    days = whole.where("date_day between date '2026-03-01' and date '2026-03-31'")
    assert sorted(report.collect()) == sorted(days.collect())


def test_failed_check_publishes_nothing(spark, raw, tmp_path):
    job.run(spark, raw, str(tmp_path), "good", AS_OF)
    before = spark.table("kpi.kpi_funnel_conversion").collect()
    twice = {**raw, "raw_payments": raw["raw_payments"].unionByName(raw["raw_payments"])}
    with pytest.raises(quality.QualityError, match="unique_fct_payments_payment_id: 2000"):
        job.run(spark, twice, str(tmp_path), "bad", AS_OF)
    assert spark.table("core.fct_payments").count() == 2000
    assert spark.table("kpi.kpi_funnel_conversion").collect() == before

    job.run(spark, raw, str(tmp_path), "next", AS_OF)
    job.publish_run(spark, str(tmp_path), "good")
    assert "/runs/good/" in spark.table("core.dim_customers").inputFiles()[0]


def test_unknown_segment_stops_unless_strict(spark, raw, tmp_path):
    odd = F.when(F.col("customer_id") == "C000007", "gold").otherwise(F.col("segment"))
    customers = raw["raw_crm_customers"].withColumn("segment", odd)
    changed = {**raw, "raw_crm_customers": customers}
    with pytest.raises(quality.QualityError, match="accepted_values_dim_customers_segment: 1"):
        job.run(spark, changed, str(tmp_path), "normal", AS_OF)
    job.run(spark, changed, str(tmp_path), "strict", AS_OF, strict_segments=True)
    row = spark.table("core.dim_customers").where("customer_id = 'C000007'").first()
    assert row.segment is None and row.is_paying is False


def test_late_source_stops_the_run(spark, raw, tmp_path):
    late = AS_OF + datetime.timedelta(hours=11)
    with pytest.raises(quality.QualityError, match="payments: newest 2026-04-30 23:30:00"):
        job.run(spark, raw, str(tmp_path), "late", late)
    warned = AS_OF + datetime.timedelta(hours=7)
    status = job.check_freshness(raw, F.lit(str(warned)).cast("timestamp_ntz"))
    assert {r.source_name: r.status for r in status.collect()} == {
        "events": "pass",
        "payments": "warn",
    }


def test_run_id_is_checked_and_accepted_once(spark, raw, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError):
        job.run(spark, raw, root, "../x", AS_OF)
    twice = {**raw, "raw_payments": raw["raw_payments"].unionByName(raw["raw_payments"])}
    with pytest.raises(quality.QualityError):
        job.run(spark, twice, root, "again", AS_OF)
    # A failed id may be used again, an accepted one not.
    job.run(spark, raw, root, "again", AS_OF)
    assert job.store.published(spark, root, "core.fct_payments").count() == 2000
    with pytest.raises(ValueError, match="accepted"):
        job.run(spark, raw, root, "again", AS_OF)


def test_readers_see_accepted_runs_only(spark, raw, tmp_path, monkeypatch):
    root = str(tmp_path)
    with pytest.raises(LookupError):
        job.store.published(spark, root, "core.dim_customers")
    job.run(spark, raw, root, "one", AS_OF)
    whole = job.store.write_run_table

    def stops(df, root, run_id, name, partition_by=()):
        if name == "kpi.kpi_revenue_by_segment":
            raise OSError("lost")
        return whole(df, root, run_id, name, partition_by)

    monkeypatch.setattr(job.store, "write_run_table", stops)
    with pytest.raises(OSError):
        job.run(spark, raw, root, "two", AS_OF)
    monkeypatch.undo()
    assert job.store.current_run(spark, root) == "one"
    with pytest.raises(LookupError):
        job.store.published(spark, root, "core.dim_customers", "two")
    # Stopped between two names of the catalog: the log still holds the first run.
    monkeypatch.setattr(job.store, "accept", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        job.run(spark, raw, root, "two", AS_OF)
    monkeypatch.undo()
    assert job.store.current_run(spark, root) == "one"
    job.run(spark, raw, root, "two", AS_OF)
    assert job.store.current_run(spark, root) == "two"
    job.publish_run(spark, root, "one")
    assert job.attach(spark, root) == "one"


def test_another_process_reads_the_published_tables(spark, raw, tmp_path):
    import subprocess
    import sys

    job.run(spark, raw, str(tmp_path), "here", AS_OF)
    code = (
        "import sys; from metricloom.session import local_session; from metricloom.plans import job\n"
        "spark = local_session(2, 'reader')\n"
        "assert job.attach(spark, sys.argv[1]) == 'here'\n"
        "print('rows', spark.sql('select * from kpi.kpi_daily_active_users').count())\n"
    )
    done = subprocess.run(
        [sys.executable, "-c", code, str(tmp_path)], capture_output=True, text=True,
        cwd=tmp_path, env={**__import__("os").environ, "PYTHONPATH": ROOT}, timeout=300,
    )
    assert "rows 486" in done.stdout, done.stderr[-2000:]


def test_calendar_follows_the_run(spark, raw, tmp_path):
    later = datetime.datetime(2028, 6, 1, 3, 0)
    job.run(spark, raw, str(tmp_path), "later", later, start="2022-06-01", freshness=False)
    for name in ("core.dim_date", "kpi.kpi_daily_active_users"):
        day = job.store.published(spark, str(tmp_path), name).agg(F.min("date_day"), F.max("date_day"))
        first, last = day.first()
        assert first == datetime.date(2022, 6, 1) and last >= datetime.date(2028, 6, 1)
    users = job.store.published(spark, str(tmp_path), "kpi.kpi_daily_active_users")
    assert users.count() == (datetime.date(2028, 6, 1) - datetime.date(2022, 6, 1)).days + 1


def test_times_with_a_zone_become_utc():
    east = datetime.datetime.fromisoformat("2026-05-01T05:00:00+02:00")
    assert job.utc(east) == datetime.datetime(2026, 5, 1, 3)
    assert job.utc(AS_OF) == AS_OF


def test_text_without_a_type_stops_the_run(spark, raw, tmp_path):
    odd = raw["raw_payments"].withColumn(
        "amount_text", F.when(F.col("payment_id") == "PAY000000002", "ten")
    )
    with pytest.raises(quality.QualityError, match="typed_raw_payments_amount: 1"):
        job.run(spark, {**raw, "raw_payments": odd}, str(tmp_path), "odd", AS_OF)
