"""Files, landing and synthetic data."""

import datetime

import pytest
from pyspark.sql import functions as F

from metricloom import fixed_values as fixed
from metricloom.sources import files, schemas, synthetic


def test_csv_comes_back_unchanged(spark, tmp_path):
    rows = [
        ("C1", "Al", "O'Brien", 'a"q"@x.y', "2024-01-01 05:00:00", " us", "a,b", "Free", "True"),
        ("C2", " Lé ", None, "line\\slash", "2024-02-29 23:00:00", "GB", None, "pro", "f"),
    ]
    df = spark.createDataFrame(rows, schemas.CUSTOMERS)
    files.write_csv(df, str(tmp_path / "c"))
    back = files.read_csv(spark, str(tmp_path / "c"), schemas.CUSTOMERS)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_csv_with_wrong_header_is_an_error(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("payment_id,customer_id\n1,2\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(path), schemas.PAYMENTS).collect()


def test_landing_twice_replaces_one_date(spark, tmp_path):
    path = str(tmp_path / "landed")
    files.land(spark.range(5).toDF("n"), path, "2026-01-01")
    files.land(spark.range(7).toDF("n"), path, "2026-01-02")
    files.land(spark.range(3).toDF("n"), path, "2026-01-02")
    counts = dict(files.read_landed(spark, path).groupBy("ds").count().collect())
    assert counts == {datetime.date(2026, 1, 1): 5, datetime.date(2026, 1, 2): 3}
    one = files.read_landed(spark, path, "2026-01-02", "2026-01-02")
    assert one.count() == 3
    assert "PartitionFilters: [isnotnull(ds" in one._jdf.queryExecution().toString()


def test_landing_several_dates_at_once(spark, tmp_path):
    path = str(tmp_path / "landed")
    day = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 3).cast("int"))
    files.land(spark.range(30), path, day)
    assert files.read_landed(spark, path).groupBy("ds").count().count() == 3


def test_synthetic_customers_do_not_depend_on_partitions(spark):
    a = synthetic.customers_numbered(spark.range(1, 501, numPartitions=1))
    b = synthetic.customers_numbered(spark.range(1, 501, numPartitions=7))
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.select("customer_id").distinct().count() == 500


def _shares(df, column):
    n = df.count()
    return {r[0]: r[1] / n for r in df.groupBy(column).count().collect()}


def _close(shares, names, weights, within=0.02):
    assert set(shares) == set(names)
    for name, weight in zip(names, weights, strict=True):
        assert abs(shares[name] - weight) < within, (name, shares[name])


def test_synthetic_distributions(spark):
    customers = synthetic.customers(spark, 5000)
    _close(_shares(customers, "segment"), fixed.SEGMENTS, fixed.SEGMENT_WEIGHTS)
    _close(_shares(customers, "country"), fixed.COUNTRIES, [0.1] * 10)
    _close(_shares(customers, "acquisition_channel"), fixed.CHANNELS, [1 / 6] * 6)
    inactive = customers.groupBy(F.col("segment") == "Free").agg(
        F.avg((~F.col("is_active")).cast("int"))
    )
    by_free = dict(inactive.collect())
    assert abs(by_free[True] - 0.15) < 0.02 and abs(by_free[False] - 0.05) < 0.02

    events = synthetic.events(customers.select("customer_id"), 20_000)
    assert events.count() == 20_000
    _close(_shares(events, "event_type"), fixed.EVENT_TYPES, fixed.EVENT_WEIGHTS)
    _close(_shares(events, "platform"), fixed.PLATFORMS, fixed.PLATFORM_WEIGHTS)
    bounds = events.agg(F.min("event_timestamp"), F.max("event_timestamp")).first()
    assert bounds[0] >= datetime.datetime(2025, 1, 1)
    assert bounds[1] < datetime.datetime(2026, 5, 1)
    # 20,000 picks among 5,000 leave about exp(-4) of them out.
    assert abs(events.select("customer_id").distinct().count() / 5000 - 0.982) < 0.01

    paying = files.paying_customers(customers)
    payments = synthetic.payments(paying, 10_000)
    assert payments.count() == 10_000
    _close(_shares(payments, "status"), fixed.STATUSES, fixed.STATUS_WEIGHTS)
    _close(_shares(payments, "currency"), fixed.CURRENCIES, fixed.CURRENCY_WEIGHTS)
    prices = {
        (r.plan, int(r.amount)) for r in payments.select("plan", "amount").distinct().collect()
    }
    assert prices == {
        (plan, usd * m) for plan, usd in fixed.PLAN_PRICES.items() for m in (1, 12)
    }
    wrong_plan = payments.join(paying, "customer_id").where("plan <> segment")
    assert wrong_plan.count() == 0


def test_dense_index_numbers_every_row_once(spark):
    ids = synthetic.customers(spark, 1000).select("customer_id")
    numbered = synthetic.dense_index(ids, "customer_id")
    got = [r.row_index for r in numbered.orderBy("row_index").collect()]
    assert got == list(range(1000))
    assert {r.total for r in numbered.collect()} == {1000}
    for buckets in (1, 7, 300):
        again = synthetic.dense_index(ids, "customer_id", buckets)
        assert sorted(again.collect()) == sorted(numbered.collect())


def test_draws_have_52_bits(spark):
    drawn = synthetic.with_draws(spark.range(2000), 3, "id", 5)
    values = {r[f"u{i}"] for r in drawn.collect() for i in range(5)}
    assert len(values) == 10_000 and all(0 <= v < 1 for v in values)
    assert all((v * 2**52).is_integer() for v in values)
    assert sum((v * 2**32).is_integer() for v in values) < 10


def test_rows_per_id_are_as_many_as_asked(spark):
    ids = synthetic.customers(spark, 100).select("customer_id")
    by_id = synthetic.events(ids, per_id=4)
    assert sorted(by_id.collect()) == sorted(synthetic.events(ids, 400).collect())
    with pytest.raises(ValueError):
        synthetic.events(ids, 400, per_id=4)


def test_landing_with_types_keeps_what_does_not_fit(spark):
    raw = spark.createDataFrame(
        [("P1", "2024-02-30", "1.005"), ("P2", "2024-02-29 01:02:03", "ten"), ("P3", None, None)],
        "payment_id string, payment_timestamp string, amount string",
    )
    rows = {r.payment_id: r for r in files.typed(raw, schemas.TYPES["raw_payments"]).collect()}
    assert rows["P1"].payment_timestamp is None and rows["P1"].payment_timestamp_text == "2024-02-30"
    assert str(rows["P1"].amount) == "1.01" and rows["P1"].amount_text is None
    assert rows["P2"].payment_timestamp == datetime.datetime(2024, 2, 29, 1, 2, 3)
    assert rows["P2"].amount_text == "ten" and rows["P3"].amount_text is None
