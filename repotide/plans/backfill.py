"""Tables for a span of days, from all the files of it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from repotide.functions.calendar import by_month, days_between, month_bounds
from repotide.plans.refresh import Settings, refresh_files, refresh_hours, write_events
from repotide.sources.arrivals import known_files, note_files
from repotide.sources.landing import canonical_events, chosen, empty_files, list_files, read_events
from repotide.sources.tables import TableStore


def backfill(
    spark: SparkSession,
    landing: str,
    out: str,
    first: date,
    last: date,
    settings: Settings = Settings(),
    hour_from: str = "file",
    resume: bool = False,
) -> TableStore:
    """Builds all tables for the days ``first`` to ``last``; a repeat replaces them.

    It goes month by month. Hours without a file are left as they are. Each month, once done, is noted with a digest
    of its files; with ``resume`` months done with the same files and settings are not read again, so a
    backfill of years that was cut short goes on where it stopped. Files passed over are in the book of
    deliveries. With ``hour_from="created_at"`` file names mean nothing: the whole landing folder is read and
    every hour of the span is replaced.
    """
    if not landing:
        raise ValueError("landing must name a folder or bucket")
    store = TableStore(spark, out)
    if hour_from == "file":
        files = list_files(spark, landing, first, last).unionByName(empty_files(spark, landing, first, last))
        if not files.isEmpty():
            note_files(store, files, "listing")
            _backfill_months(store, first, last, settings, resume)
        return store
    span = F.col("create_date").between(F.lit(first), F.lit(last))
    events = canonical_events(read_events(spark, landing), hour_from).where(span)
    store.create("events")
    before = store.partitions("events", span)
    hours = write_events(store, events, span, by_file=False) | before
    refresh_hours(store, hours, settings)
    return store


def _backfill_months(store: TableStore, first: date, last: date, settings: Settings, resume: bool) -> None:
    files = known_files(store, days_between(first, last))
    present = chosen(files)
    # what each hour is made of, so that a file that came or changed since is noticed
    content = F.sort_array(F.collect_list(F.struct("hour", "path", "modified", "length")))
    by_day = {row["create_date"]: row["content"] for row in files.groupBy("create_date").agg(F.xxhash64(content).alias("content")).collect()}
    store.create("finished_months")
    done = {row["month"]: (row["settings"], row["files"]) for row in store.read("finished_months").collect()}
    for days in by_month(day for day, _ in present):
        month = f"{days[0]:%Y-%m}"
        note = (repr(settings), ",".join(f"{day}:{by_day[day]}" for day in days))
        if resume and done.get(month) == note:
            continue
        refresh_files(store, {hour: path for hour, path in present.items() if hour[0] in set(days)}, settings)
        store.write("finished_months", store.spark.createDataFrame([(*note, month)], "settings string, files string, month string"))


def backfill_month(
    spark: SparkSession,
    landing: str,
    out: str,
    year: str,
    month: str,
    settings: Settings = Settings(),
    through: str | None = None,
    resume: bool = False,
) -> TableStore:
    """The month backfill, for a year such as ``"2019"`` and a month such as ``"06"``.

    ``through``, such as ``"2021-05"``, makes it a span of months.
    """
    first, last = month_bounds(year, month)
    if through:
        last = month_bounds(*through.split("-"))[1]
    return backfill(spark, landing, out, first, last, settings, resume=resume)
