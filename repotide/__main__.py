"""Command line jobs.

    python -m repotide backfill --landing s3a://bucket/ --out s3a://tables/ -y 2019 -m 06
    python -m repotide ingest --landing s3a://bucket/ --out s3a://tables/ --checkpoint s3a://state/ingest
    python -m repotide event-time --landing s3a://bucket/ --out s3a://times/ --checkpoint s3a://state/times
    python -m repotide export --out s3a://tables/ --url jdbc:... --since 2019-06-01
"""

from __future__ import annotations

import argparse
import os
from datetime import timedelta

from pyspark.sql import functions as F

from repotide.functions.calendar import as_date, month_bounds
from repotide.plans.backfill import backfill_month
from repotide.plans.export import export_changes
from repotide.plans.refresh import Settings
from repotide.session import build_session
from repotide.sources.arrivals import passed_over
from repotide.sources.jdbc import JdbcTarget
from repotide.sources.landing import stream_events
from repotide.sources.tables import TableStore
from repotide.streaming.event_time import upsert_event_time_counts
from repotide.streaming.ingest import ingest_available


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="repotide")
    jobs = parser.add_subparsers(dest="job", required=True)

    month = jobs.add_parser("backfill", help="build the tables of a month")
    month.add_argument("-y", "--year", required=True, help="four digits")
    month.add_argument("-m", "--month", required=True, help="two digits")
    month.add_argument("--through", help="last month of a span, as 2021-05")
    month.add_argument("--resume", action="store_true", help="leave out months done before with the same files")

    ingest = jobs.add_parser("ingest", help="process the files that have arrived")
    ingest.add_argument("--checkpoint", required=True)
    ingest.add_argument("--max-files", type=int)

    times = jobs.add_parser("event-time", help="count what has arrived by the events' own hours, late ones too")
    times.add_argument("--checkpoint", required=True)
    times.add_argument("--lateness-hours", type=int, default=2)

    for job in (month, ingest, times):
        job.add_argument("--landing", required=True)
    for job in (month, ingest):
        job.add_argument("--keep-unknown-language", action="store_true")
        job.add_argument("--hourly-details", action="store_true")

    export = jobs.add_parser("export", help="bring the tables of a database up to date, day by day")
    export.add_argument("--url", required=True)
    export.add_argument("--since", help="send every day from this one on again, also if it has not changed")

    arrivals = jobs.add_parser("arrivals", help="show deliveries that were passed over and lines that could not be read")

    for job in (month, ingest, times, export, arrivals):
        job.add_argument("--out", required=True, help="root folder of the tables")
    args = parser.parse_args(argv)
    if args.job == "backfill":
        try:
            month_bounds(args.year, args.month)
            if args.through:
                month_bounds(*args.through.split("-", 1))
        except (ValueError, TypeError) as error:
            parser.error(str(error))
    return args


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session(f"repotide-{args.job}")
    if args.job == "export":
        # the login comes from the environment, never from the code
        names = {"user": "JDBC_USER", "password": "JDBC_PASSWORD", "driver": "JDBC_DRIVER"}
        properties = {key: os.environ[name] for key, name in names.items() if name in os.environ}
        store = TableStore(spark, args.out)
        scope = F.col("create_date") >= as_date(args.since) if args.since else None
        export_changes(store, JdbcTarget(args.url, properties), scope, all_days=bool(args.since))
        return
    if args.job == "arrivals":
        store = TableStore(spark, args.out)
        for name, report in (("deliveries", passed_over), ("broken_lines", lambda s: s.read("broken_lines"))):
            if store.exists(name):
                report(store).orderBy("create_date", "hour").show(1000, truncate=False)
        return
    if args.job == "event-time":
        raw = stream_events(spark, args.landing)
        upsert_event_time_counts(raw, args.out, args.checkpoint, timedelta(hours=args.lateness_hours))
        return
    settings = Settings(require_language=not args.keep_unknown_language, hourly_details=args.hourly_details)
    if args.job == "backfill":
        backfill_month(spark, args.landing, args.out, args.year, args.month, settings, args.through, args.resume)
    else:
        ingest_available(spark, args.landing, args.out, args.checkpoint, settings, args.max_files)


if __name__ == "__main__":
    main()
