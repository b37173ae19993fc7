"""Command line: generate sample CSV files, run and publish, show the headline.

    python -m metricloom generate --csv FOLDER
    python -m metricloom run --csv FOLDER --root SHARED_FOLDER --run-id ID
    python -m metricloom show --root SHARED_FOLDER [--run-id ID]

``--root`` is a folder every executor can reach.
"""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import SparkSession

from metricloom import fixed_values as fixed
from metricloom.operators import activity, quality
from metricloom.plans import job, serving
from metricloom.session import SETTINGS
from metricloom.sources import files, schemas, synthetic, tables


def generate(spark: SparkSession, folder: str, customers: int, events: int, payments: int) -> None:
    """The three raw sources as CSV, with the usual sizes unless told otherwise."""
    path = f"{folder}/raw_crm_customers.csv"
    files.write_csv(synthetic.customers(spark, customers), path)
    written = files.read_csv(spark, path, schemas.CUSTOMERS)
    files.write_csv(
        synthetic.events(files.customer_ids(written), events), f"{folder}/raw_app_events.csv"
    )
    files.write_csv(
        synthetic.payments(files.paying_customers(written), payments),
        f"{folder}/raw_payments.csv",
    )


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    as_of = job.utc(args.as_of or datetime.datetime.now(datetime.timezone.utc))
    share = getattr(args, "max_rejected_share", None)
    raw = job.load_raw(
        spark, args.csv, args.root, as_of.date().isoformat(), share is not None,
        getattr(args, "quoted_line_ends", False),
    )
    report = job.run(
        spark, raw, args.root, args.run_id, as_of, args.start, args.anchors,
        args.strict_segments, not args.skip_freshness, share,
    )
    print(report.orderBy("check_name").toPandas().to_string(index=False))


def show(spark: SparkSession, root: str, run_id: str | None = None) -> None:
    """Snapshots of the current run: newest days, newest revenue, newest cohort, checks.

    Another run may be named if it was accepted. Everything printed is a few rows
    by its own definition.
    """
    run_id = run_id or tables.current_run(spark, root)

    def table(name: str):
        return tables.published(spark, root, name, run_id)

    users = table("kpi.kpi_daily_active_users")
    revenue = table("kpi.kpi_revenue_by_segment")
    cohorts = table("kpi.kpi_funnel_conversion")
    summary = quality.union_all(
        [
            quality.report_line(
                fixed.REPORT_LINES["customers"],
                quality.excess_rows(table("core.dim_customers"), "customer_id"),
            ),
            quality.report_line(
                fixed.REPORT_LINES["payments"],
                quality.excess_rows(table("core.fct_payments"), "payment_id"),
            ),
            quality.report_line(
                fixed.REPORT_LINES["events"],
                quality.null_rows(table("core.fct_events"), "customer_sk"),
            ),
        ]
    )
    for title, df in {
        "Headline": serving.headline_tiles(users, serving.revenue_by_month(revenue)),
        "Active users, newest days": serving.latest_days(users, 5),
        "Revenue by segment, newest rows": serving.newest_revenue(revenue),
        "Funnel, newest cohort": serving.funnel_latest_cohort(cohorts),
        "Checks": summary,
    }.items():
        print(f"\n{title}\n{df.toPandas().to_string(index=False)}")


def main() -> None:
    parser = argparse.ArgumentParser(prog="metricloom")
    commands = parser.add_subparsers(dest="command", required=True)
    sub = commands.add_parser("generate")
    sub.add_argument("--csv", required=True)
    sub.add_argument("--customers", type=int, default=fixed.SYNTHETIC_CUSTOMERS)
    sub.add_argument("--events", type=int, default=fixed.SYNTHETIC_EVENTS)
    sub.add_argument("--payments", type=int, default=fixed.SYNTHETIC_PAYMENTS)
    sub = commands.add_parser("run")
    sub.add_argument("--csv", required=True)
    sub.add_argument("--root", required=True)
    sub.add_argument("--run-id", required=True)
    sub.add_argument("--as-of", type=datetime.datetime.fromisoformat)
    sub.add_argument("--start", default=fixed.REPORT_START)
    sub.add_argument(
        "--anchors", choices=[activity.EVENT_DAYS, activity.CALENDAR], default=activity.EVENT_DAYS
    )
    sub.add_argument("--strict-segments", action="store_true")
    sub.add_argument("--skip-freshness", action="store_true")
    sub.add_argument("--max-rejected-share", type=float)
    sub.add_argument("--quoted-line-ends", action="store_true")
    sub = commands.add_parser("show")
    sub.add_argument("--root", required=True)
    sub.add_argument("--run-id")
    args = parser.parse_args()

    builder = SparkSession.builder.appName("metricloom")
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    match args.command:
        case "generate":
            generate(spark, args.csv, args.customers, args.events, args.payments)
        case "run":
            run(spark, args)
        case "show":
            show(spark, args.root, args.run_id)


if __name__ == "__main__":
    main()
