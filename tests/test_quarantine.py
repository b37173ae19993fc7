"""Bad rows set apart: whole split, reasons, and the gate on their share."""

import pytest
from pyspark.sql import functions as F

from metricloom.operators import quality
from metricloom.plans import job
from metricloom.sources import files, quarantine, schemas
from metricloom.sources import tables as store
from test_job import AS_OF, raw  # noqa: F401  the landed sources


def test_wrong_rows_of_a_file_are_kept_with_their_text(spark, tmp_path):
    head = ",".join(schemas.PAYMENTS.fieldNames())
    rows = [
        "P1,C1,2024-01-01 00:00:00,10.00,USD,succeeded,pro",
        "P2,C1,2024-01-01",
        "P3,C1,2024-01-01 00:00:00,10.00,USD,succeeded,pro,more",
        'P4,C1,yesterday,"1,5",USD,succeeded,pro',
        "P5,,,,,,",
    ]
    (tmp_path / "p.csv").write_text("\n".join([head, *rows]) + "\n")
    types = schemas.TYPES["raw_payments"]
    read = files.read_csv(spark, str(tmp_path / "p.csv"), schemas.PAYMENTS, keep_bad=True)
    # Read back, as a run does: the reader gives a row's text only with all its columns.
    files.land(files.typed(read, types), str(tmp_path / "landed"), "2024-01-02")
    landed = files.read_landed(spark, str(tmp_path / "landed")).drop("ds")
    good = quarantine.accepted_rows(landed, types)
    assert sorted(r.payment_id for r in good.collect()) == ["P1", "P5"]
    assert good.columns == schemas.PAYMENTS.fieldNames()
    bad = {r.payment_id: r for r in quarantine.rejected_rows(landed, types).collect()}
    assert {k: r.reasons for k, r in bad.items()} == {
        "P2": ["row"],
        "P3": ["row"],
        "P4": ["amount", "payment_timestamp"],
    }
    assert bad["P2"][quarantine.BAD_ROW] == rows[1] and bad["P4"].amount_text == "1,5"
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        files.read_csv(spark, str(tmp_path / "p.csv"), schemas.PAYMENTS).collect()


@pytest.fixture(scope="module")
def damaged(raw):  # noqa: F811
    """One event in a thousand with a time that is none."""
    events = raw["raw_app_events"]
    bad = F.substring("event_id", 2, 9).cast("int") % 1000 == 500
    return raw | {
        "raw_app_events": events.withColumn(
            "event_timestamp_text", F.when(bad, F.lit("soon"))
        ).withColumn("event_timestamp", F.when(~bad, F.col("event_timestamp")))
    }


def test_a_run_with_few_bad_rows_is_published(spark, damaged, tmp_path):
    root = str(tmp_path)
    report = job.run(spark, damaged, root, "set-apart", AS_OF, max_rejected_share=0.001)
    lines = {r.check_name: r.failures for r in report.collect()}
    assert lines["rejected_raw_app_events"] == 6
    assert lines["rejected_raw_payments"] == lines["rejected_raw_crm_customers"] == 0
    assert store.published(spark, root, "core.fct_events").count() == 5994
    rejected = store.published(spark, root, "raw_rejected.raw_app_events")
    assert {tuple(r.reasons) for r in rejected.collect()} == {("event_timestamp",)}
    assert rejected.count() == 6


def test_above_the_share_and_without_one_the_run_stops(spark, damaged, tmp_path):
    with pytest.raises(quality.QualityError, match="raw_app_events: 6 of 6000"):
        job.run(spark, damaged, str(tmp_path), "above", AS_OF, max_rejected_share=0.0009)
    with pytest.raises(ValueError):
        job.run(spark, damaged, str(tmp_path), "share", AS_OF, max_rejected_share=2)
    assert store.current_run(spark, str(tmp_path)) is None


def test_tables_without_leftovers(spark):
    plain = spark.createDataFrame([("a", 1)], "reason string, n int")
    assert not quarantine.can_reject(plain, {"n": "int"})
    assert quarantine.accepted_rows(plain, {"n": "int"}).collect() == plain.collect()
    assert quarantine.rejected_rows(plain, {"n": "int"}).collect() == []
