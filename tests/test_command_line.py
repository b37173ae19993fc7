"""The three commands, on small data."""

import argparse
import datetime

from metricloom import __main__ as cli
from metricloom.operators import activity


def test_generate_run_show(spark, tmp_path, capsys):
    csv, lake = str(tmp_path / "csv"), str(tmp_path / "lake")
    cli.generate(spark, csv, customers=80, events=500, payments=200)
    args = argparse.Namespace(
        csv=csv, root=lake, run_id="one", as_of=datetime.datetime(2026, 5, 1, 5),
        start="2026-04-01", anchors=activity.CALENDAR, strict_segments=False, skip_freshness=True,
    )
    cli.run(spark, args)
    report = capsys.readouterr().out
    assert "unique_raw_payments_payment_id" in report

    cli.show(spark, lake, "one")
    shown = capsys.readouterr().out
    for title in ("Headline", "Active users", "Revenue by segment", "Funnel", "Checks"):
        assert title in shown
    assert "revenue_latest_month" in shown
    users = spark.table("kpi.kpi_daily_active_users")
    assert users.count() == 31
