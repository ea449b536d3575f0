"""Brings all tables up to date for a set of archive hours.

The month backfill and the incremental job both end here, so history and increments give
the same tables. The JSON text of an hour is parsed once, into the events table; everything
after that reads Parquet, only the columns and types it needs: hourly tables are recomputed for the new
hours alone, daily ones from the hourly tables of their days. Only the folders of these days are listed. Each
table is written once and read back, which keeps lineage short: a lost executor costs the tasks it ran, not
the steps before.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from repotide.functions.calendar import Hour, by_month, days_scope, hours_scope
from repotide.operators.daily import daily_event_top, daily_user_top
from repotide.operators.details import (
    details_still_good,
    hour_bits,
    repo_detail_rows,
    scored_repo_details_from_events,
    with_coverage,
)
from repotide.operators.hourly import hourly_event_counts, hourly_user_pushes
from repotide.operators.scoring import aggregate_score
from repotide.plans.latest import refresh_latest
from repotide.schemas import DAILY_TOP, HOURLY_MINIMUMS, HOURLY_USER_MINIMUM
from repotide.sources.landing import broken_lines, canonical_events, files_with_broken_lines, read_events
from repotide.sources.tables import TableStore


@dataclass(frozen=True)
class Settings:
    """Minimums and cuts; the defaults are the fixed values of the trend tables."""

    minimums: Mapping[str, int] = field(default_factory=lambda: dict(HOURLY_MINIMUMS))
    user_minimum: int = HOURLY_USER_MINIMUM
    top: int = DAILY_TOP
    require_language: bool = True
    # The detail rows of all repositories are an intermediate nothing here reads: those of
    # scored repositories come from the events table. Write them only where wanted.
    hourly_details: bool = False
    # Keep lines that could not be read in the table broken_lines. They are noticed in the one pass over the
    # JSON; only files that have some are read again.
    keep_broken: bool = True


def refresh_files(store: TableStore, files: Mapping[Hour, str], settings: Settings) -> None:
    """Reads the hours in ``files``, month by month, and replaces what the tables had of them and their days."""
    for hours in _months(files):
        paths = [files[hour] for hour in sorted(hours)]
        days = {day for day, _ in hours}
        raw, scope, seen = read_events(store.spark, paths), hours_scope(hours), Observation()
        if settings.keep_broken:
            raw = raw.observe(seen, files_with_broken_lines().alias("files"))
        write_events(store, canonical_events(raw), scope, days=days)
        if settings.keep_broken:
            _keep_broken(store, seen.get["files"], scope, days)
        _refresh_month(store, hours, settings)


def _keep_broken(store: TableStore, files: list[str], scope: Column, days: set[date]) -> None:
    """The broken lines of ``files`` take the place of those known of the hours."""
    if files:
        store.replace("broken_lines", broken_lines(read_events(store.spark, files)), scope, days=days)
    else:
        store.create("broken_lines")
        for key in store.partitions("broken_lines", scope, days):
            store.drop("broken_lines", key)


def write_events(
    store: TableStore, events: DataFrame, scope: Column, by_file: bool = True, days: set[date] | None = None
) -> set[tuple]:
    """Writes the events table, sorted so that row groups can be skipped and columns pack well.

    ``by_file`` says that a file has one hour only. A task then writes few partitions and no
    shuffle is needed; otherwise the hours are gathered first.
    """
    order = ["create_date", "hour", "event", "repo_name"]
    return store.replace("events", events, scope, gather=not by_file, order=order, days=days)


def refresh_hours(store: TableStore, hours: set[Hour], settings: Settings) -> None:
    """Recomputes the hourly tables of ``hours`` and the daily ones of their days from the events table.

    Month by month, so that what is broadcast has the size of a month however long the span.
    """
    for month in _months(hours):
        _refresh_month(store, month, settings)


def _months(hours: Collection[Hour]) -> Iterator[set[Hour]]:
    for days in by_month({day for day, _ in hours}):
        month = set(days)
        yield {hour for hour in hours if hour[0] in month}


def _refresh_month(store: TableStore, hours: set[Hour], settings: Settings) -> None:
    """Three independent chains of tables, whose jobs share the cluster."""
    days = {day for day, _ in hours}
    new, whole = hours_scope(hours), days_scope(days)
    events = store.read("events", new, days)

    def day_tables(name: str) -> DataFrame:
        return store.read(name, whole, days)

    def event_chain() -> None:
        store.replace("hourly_events", hourly_event_counts(events, settings.minimums), new, days=days)
        store.replace("daily_events", daily_event_top(day_tables("hourly_events"), settings.top), whole, days=days)
        store.replace("repo_scores", aggregate_score(day_tables("daily_events")), whole, days=days)
        _refresh_details(store, hours, settings)

    def user_chain() -> None:
        store.replace("hourly_users", hourly_user_pushes(events, settings.user_minimum), new, days=days)
        store.replace("repo_users", daily_user_top(day_tables("hourly_users"), settings.top), whole, days=days)

    def all_details() -> None:
        store.replace("hourly_repo_details", repo_detail_rows(events, settings.require_language), new, days=days)

    _together(store, [event_chain, user_chain] + [all_details] * settings.hourly_details)


def details_of_days(store: TableStore, hours: set[Hour], settings: Settings) -> DataFrame:
    """Details of the scored repositories of the days of ``hours``, which are new.

    The new hours are looked up for all scored repositories. Of earlier hours, what is stored stays, with the new
    score; only for repositories that have entered the list are the day's earlier events read, and only theirs.
    """
    days = {day for day, _ in hours}
    whole = days_scope(days)
    earlier = store.partitions("events", None, days) - hours
    bits = {day: hour_bits(h for d, h in earlier if d == day) for day in days}
    score_rows = len(days) * len(settings.minimums) * settings.top
    scores = store.read("repo_scores", whole, days)

    def looked_up(of: DataFrame, events: DataFrame) -> DataFrame:
        return scored_repo_details_from_events(of, events, settings.require_language, score_rows)

    fresh = looked_up(scores, store.read("events", hours_scope(hours), days))
    if not earlier:
        return fresh
    store.create("detail_lookups")
    scores = with_coverage(scores, store.read("detail_lookups", whole, days), bits, settings.require_language)
    entered = {row.repo_name for row in scores.where(~F.col("covered")).select("repo_name").distinct().collect()}  # score_rows at most
    store.create("repo_details")
    stored = store.read("repo_details", whole & ~hours_scope(hours), days)
    kept = details_still_good(scores.where("covered").drop("covered"), stored, score_rows)
    result = fresh.unionByName(kept)
    if entered:
        before = store.read("events", hours_scope(earlier), days).where(F.col("repo_name").isin(sorted(entered)))
        result = result.unionByName(looked_up(scores.where(~F.col("covered")).drop("covered"), before))
    return result


def _refresh_details(store: TableStore, hours: set[Hour], settings: Settings) -> None:
    """Replaces the days' details, then notes what they were taken from and follows with the newest ones.

    A run cut short before the note leaves an older one, which sends the next run to the events once more.
    """
    days = {day for day, _ in hours}
    whole = days_scope(days)
    # by name within a day, so that a scan for some names skips row groups
    store.replace("repo_details", details_of_days(store, hours, settings), whole, order=["create_date", "repo_name"], days=days)
    score_rows = len(days) * len(settings.minimums) * settings.top

    def note() -> None:
        present = store.partitions("events", None, days)
        bits = [(day, hour_bits(h for d, h in present if d == day)) for day in sorted(days)]
        noted = store.read("repo_scores", whole, days).join(
            F.broadcast(store.spark.createDataFrame(bits, "create_date date, hours int")), "create_date"  # one row a day
        )
        noted = noted.withColumn("require_language", F.lit(settings.require_language)).coalesce(1)  # a few names a day
        store.replace("detail_lookups", noted, whole, gather=False, days=days)

    _together(store, [note, lambda: refresh_latest(store, days, score_rows)])


def _together(store: TableStore, jobs: list[Callable[[], None]]) -> None:
    """Independent jobs, which share the cluster; the first error is raised once all have ended."""
    in_thread = inheritable_thread_target(store.spark)
    with ThreadPoolExecutor(len(jobs)) as pool:
        for job in [pool.submit(in_thread(job)) for job in jobs]:
            job.result()
