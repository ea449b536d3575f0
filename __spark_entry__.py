"""

The given ``events`` table is read as repository events (``sources/clickstream.py``). Its
counts per hour are small, so the queries pass minimums and cuts that leave something.
"""

from __future__ import annotations

import os
import sys
import warnings
from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_queries import NAMES, ORACLE  # noqa: E402
from repotide.functions import calendar, naming  # noqa: E402
from repotide.operators import daily, details, hourly, scoring  # noqa: E402
from repotide.plans import serving  # noqa: E402
from repotide.plans.backfill import backfill  # noqa: E402
from repotide.plans.export import mark_exported, pending_days  # noqa: E402
from repotide.plans.refresh import Settings  # noqa: E402
from repotide.schemas import COUNTED_EVENTS, DETAIL_FIELDS, FORK, PUSH, WATCH  # noqa: E402
from repotide.session import work_dir  # noqa: E402
from repotide.sources.arrivals import passed_over  # noqa: E402
from repotide.sources.clickstream import read_clickstream, write_landing  # noqa: E402
from repotide.sources.landing import canonical_events, read_events, stream_events  # noqa: E402
from repotide.sources.tables import TableStore  # noqa: E402
from repotide.streaming.event_time import (  # noqa: E402
    corrections,
    late_rows,
    run_event_time_counts,
    upsert_event_time_counts,
)
from repotide.streaming.ingest import ingest_available  # noqa: E402

AS_OF = "2024-01-31"
FIRST, LAST = date(2024, 1, 1), date(2024, 1, 31)
ANY = {event: 0 for event in COUNTED_EVENTS}
TWICE = {event: 1 for event in COUNTED_EVENTS}
STAGGERED = {PUSH: 2, WATCH: 1, FORK: 0}
TOP = 20
SETTINGS = Settings(minimums=ANY, user_minimum=0, top=TOP)
WITH_DETAILS = replace(SETTINGS, hourly_details=True)
FEW = 10
# A day has at most TOP repositories per type.
SCORE_ROWS = ((LAST - FIRST).days + 1) * len(ANY) * TOP

Query = Callable[[SparkSession, str], DataFrame]


def _plain(df: DataFrame, *columns: str) -> DataFrame:
    """Result columns with dates and arrays as text and doubles rounded."""
    names = columns or tuple(df.columns)
    types = dict(df.dtypes)
    out = []
    for name in names:
        column = F.col(name)
        if types[name] == "date":
            column = column.cast("string")
        elif types[name].startswith("array"):
            column = F.array_join(column, ",")
        elif types[name] == "double":
            column = F.round(column, 6)
        out.append(column.alias(name))
    return df.select(*out)


def _hourly(events: DataFrame, minimums: dict[str, int] = ANY) -> DataFrame:
    return hourly.hourly_event_counts(events, minimums)


def _daily_top(events: DataFrame) -> DataFrame:
    return daily.daily_event_top(_hourly(events), TOP)


def _daily_users(events: DataFrame) -> DataFrame:
    return daily.daily_user_counts(hourly.hourly_user_pushes(events, 0))


def _tables(spark: SparkSession, sf_dir: str) -> serving.TrendTables:
    """The daily tables, computed from the events; users and details are left uncut."""
    events = read_clickstream(spark, sf_dir)
    top = _daily_top(events)
    return serving.TrendTables(
        daily_events=top,
        repo_users=_daily_users(events),
        repo_scores=scoring.aggregate_score(top),
        repo_details=details.repo_detail_rows(events),
    )


def _on_events(build: Callable[[DataFrame], DataFrame], *columns: str, repos: int | None = None) -> Query:
    return lambda spark, sf_dir: _plain(build(read_clickstream(spark, sf_dir, repos)), *columns)


def _on_tables(build: Callable[[serving.TrendTables], DataFrame], *columns: str) -> Query:
    return lambda spark, sf_dir: _plain(build(_tables(spark, sf_dir)), *columns)


def _landing(spark: SparkSession, sf_dir: str) -> str:
    """A landing folder of compressed archive JSON with all events."""
    landing = work_dir(spark, "landing")
    write_landing(read_clickstream(spark, sf_dir), landing, compressed=True)
    return landing


def _landing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = canonical_events(read_events(spark, _landing(spark, sf_dir)))
    return _plain(
        events.select(
            "create_date",
            "hour",
            "event",
            "repo_name",
            "user_name",
            "id",
            "head_repo.language",
            "head_repo.forks",
            F.col("head_repo").isNotNull().alias("has_head_repo"),
        )
    )


def _landing_events_by_created_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = canonical_events(read_events(spark, _landing(spark, sf_dir)), "created_at")
    return _plain(events.groupBy("create_date", "hour", "event").count())


def _hour_files(events: DataFrame) -> DataFrame:
    """Names of the hours' files, made from the data and read back."""
    names = events.groupBy(naming.hour_file_name(F.col("create_date"), F.col("hour")).alias("file_name")).agg(
        F.count(F.lit(1)).alias("events")
    )
    name = F.col("file_name")
    return names.select(
        "file_name", naming.path_date(name).alias("create_date"), naming.path_hour(name).alias("hour"), "events"
    )


def _in_one_day(events: DataFrame) -> DataFrame:
    """All days as one, so that hours have counts like those of the real archive."""
    return events.withColumn("create_date", F.lit("2024-01-01").cast("date"))


def _default_scores(events: DataFrame) -> DataFrame:
    return scoring.aggregate_score(daily.daily_event_top(hourly.hourly_event_counts(_in_one_day(events))))


def _default_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    pushes = hourly.hourly_user_pushes(_in_one_day(read_clickstream(spark, sf_dir, 2, 2)))
    return _plain(daily.daily_user_top(pushes))


def _window_starts(events: DataFrame) -> DataFrame:
    day = F.col("create_date")
    windows = [calendar.window_start(day, name).alias(name) for name in calendar.WINDOW_DAYS]
    return events.select(day).distinct().select(day, *windows, calendar.slider_start(day, None).alias("unset"))


def _stack_event_tables(events: DataFrame) -> DataFrame:
    counts = daily.daily_event_counts(_hourly(events))
    return daily.stack(*(counts.where(F.col("event") == event) for event in COUNTED_EVENTS))


def _stack_hours(events: DataFrame) -> DataFrame:
    """The last hour of the days stacked on the earlier ones, then summed."""
    users = hourly.hourly_user_pushes(events, 0)
    return daily.daily_user_counts(daily.stack(users.where("hour = 23"), users.where("hour < 23")))


def _scored_details(events: DataFrame) -> DataFrame:
    scores = scoring.aggregate_score(_daily_top(events))
    return details.scored_repo_details(scores, details.repo_detail_rows(events), SCORE_ROWS)


def _scored_details_by_shuffle(events: DataFrame) -> DataFrame:
    """Without a bound of the scores, which are then not broadcast."""
    scores = scoring.aggregate_score(_daily_top(events))
    return details.scored_repo_details(scores, details.repo_detail_rows(events))


def _scored_details_from_events(events: DataFrame) -> DataFrame:
    scores = scoring.aggregate_score(_daily_top(events))
    return details.scored_repo_details_from_events(scores, events, score_rows=SCORE_ROWS)


def _top_users_of_top_repos(tables: serving.TrendTables) -> DataFrame:
    leaders = serving.top_repos(tables, serving.AGGREGATE, "month", AS_OF)
    return serving.repo_top_users(tables, "month", AS_OF, repos=leaders)


def _backfilled(spark: SparkSession, sf_dir: str, settings: Settings) -> TableStore:
    return backfill(spark, _landing(spark, sf_dir), work_dir(spark, "tables"), FIRST, LAST, settings)


def _deep_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hours lie in folders of folders, odd ones deeper than even ones."""
    landing, events = work_dir(spark, "landing"), read_clickstream(spark, sf_dir)
    for odd, folder in ((0, "2024"), (1, "2024/01/odd")):
        write_landing(events.where(F.col("hour") % 2 == odd), f"{landing}/{folder}", compressed=True)
    return _stored_counts(backfill(spark, landing, work_dir(spark, "tables"), FIRST, LAST, SETTINGS))


def _on_stored(build: Callable[[serving.TrendTables], DataFrame]) -> Query:
    """A question asked of the stored tables of a backfill."""
    return lambda spark, sf_dir: _plain(build(serving.TrendTables.stored(_backfilled(spark, sf_dir, SETTINGS))))


def _ingested(spark: SparkSession, sf_dir: str, settings: Settings) -> TableStore:
    """The hours arrive in two deliveries, odd hours first; the job runs after each."""
    landing, out, state = (work_dir(spark, name) for name in ("landing", "tables", "state"))
    events = read_clickstream(spark, sf_dir)
    for odd in (1, 0):
        write_landing(events.where(F.col("hour") % 2 == odd), landing, compressed=True)
        ingest_available(spark, landing, out, state, settings)
    return TableStore(spark, out)


def _stored_counts(store: TableStore) -> DataFrame:
    shared = {"hour": "int", "event": "string", "user_name": "string"}
    frames = []
    for name in ("hourly_events", "hourly_users", "daily_events", "repo_users", "repo_scores"):
        table = store.read(name)
        value = "score" if name == "repo_scores" else "count"
        columns = [
            F.col(c) if c in table.columns else F.lit(None).cast(kind).alias(c) for c, kind in shared.items()
        ]
        amount = F.col(value).cast("double").alias("amount")
        frames.append(table.select(F.lit(name).alias("stored_in"), "create_date", "repo_name", *columns, amount))
    return _plain(daily.stack(*frames))


def _stored_details(store: TableStore) -> DataFrame:
    columns = ["create_date", "hour", "repo_name", "languages", *DETAIL_FIELDS, "id"]
    scored = store.read("repo_details").select(F.lit("repo_details").alias("stored_in"), "score", *columns)
    hourly_rows = store.read("hourly_repo_details").select(
        F.lit("hourly_repo_details").alias("stored_in"), F.lit(None).cast("double").alias("score"), *columns
    )
    return _plain(daily.stack(scored, hourly_rows))


def _event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "event-time")
    run_event_time_counts(stream_events(spark, _landing(spark, sf_dir)), out, work_dir(spark, "state"))
    schema = "hour int, event string, repo_name string, count bigint, create_date date"
    return _plain(spark.read.schema(schema).parquet(out))


def _in_three_deliveries(spark: SparkSession, sf_dir: str) -> TableStore:
    """Hours with remainder 1 by three arrive first, then 2, then 0; each delivery is counted before the next."""
    landing, out, state = (work_dir(spark, name) for name in ("landing", "event-time", "state"))
    events = read_clickstream(spark, sf_dir)
    for remainder in (1, 2, 0):
        write_landing(events.where(F.col("hour") % 3 == remainder), landing, compressed=True)
        store = upsert_event_time_counts(stream_events(spark, landing), out, state)
    return store


def _broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that break off lie among those of the same hours; a backfill finds them."""
    landing, events = _landing(spark, sf_dir), read_clickstream(spark, sf_dir)
    number = F.col("id").cast("bigint")
    start = F.concat(F.lit('{"id":"'), "id", F.lit('","type":"'), "event")
    cut = events.where(number % 40 == 0).select("create_date", "hour", start.alias("value"))
    cut = cut.union(events.where(number % 60 == 0).select("create_date", "hour", F.lit('{"')))
    hour_file = naming.hour_file_name(F.col("create_date"), F.col("hour")).alias("hour_file")
    cut.select("value", hour_file).write.mode("append").partitionBy("hour_file").text(landing)
    lines = backfill(spark, landing, work_dir(spark, "tables"), FIRST, LAST, SETTINGS).read("broken_lines")
    name = F.regexp_extract(F.url_decode("file"), "([0-9-]+\\.json)", 1).alias("file_name")
    lines = lines.select("create_date", "hour", name, "line", "reason", "count")
    return _plain(lines.groupBy("create_date", "hour", "file_name", "line", "reason").agg(F.sum("count").alias("count")))


def _passed_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first six hours of the first five days are delivered again, after all others, in another folder."""
    landing, out, state = (work_dir(spark, name) for name in ("landing", "tables", "state"))
    events = read_clickstream(spark, sf_dir)
    again = (F.col("create_date") <= "2024-01-05") & (F.col("hour") < 6)
    for folder, some in (("first", events), ("second", events.where(again))):
        write_landing(some, f"{landing}/{folder}", compressed=True)
        ingest_available(spark, landing, out, state, SETTINGS)
    name = F.regexp_extract(F.url_decode("delivery"), "([a-z]+/hour_file=[0-9-]+\\.json)$", 1)
    return _plain(passed_over(TableStore(spark, out)).select("create_date", "hour", name.alias("delivery"), "reason"))


def _export_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All has gone out but hour 23 of the second half of the month, which arrives then."""
    landing, out, state = (work_dir(spark, name) for name in ("landing", "tables", "state"))
    events, store = read_clickstream(spark, sf_dir), TableStore(spark, out)
    late = (F.col("create_date") >= "2024-01-16") & (F.col("hour") == 23)
    write_landing(events.where(~late), landing, compressed=True)
    ingest_available(spark, landing, out, state, SETTINGS)
    mark_exported(store, pending_days(store))
    write_landing(events.where(late), landing, compressed=True)
    ingest_available(spark, landing, out, state, SETTINGS)
    return _plain(pending_days(store), "name", "create_date", "rows")


_DETAILS = ("create_date", "hour", "repo_name", "languages", *DETAIL_FIELDS, "id")

QUERIES: dict[str, Query] = {
    "canonical_events": _on_events(lambda e: e, "create_date", "hour", "event", "repo_name", "user_name", "id"),
    "landing_events": _landing_events,
    "landing_events_by_created_at": _landing_events_by_created_at,
    "hour_files": _on_events(_hour_files),
    "window_starts": _on_events(_window_starts),
    "hourly_event_counts": _on_events(lambda e: _hourly(e, TWICE), repos=FEW),
    "hourly_event_counts_by_type": _on_events(lambda e: _hourly(e, STAGGERED), repos=FEW),
    "hourly_user_pushes": _on_events(lambda e: hourly.hourly_user_pushes(e, 0)),
    "hourly_user_pushes_above": lambda spark, sf_dir: _plain(
        hourly.hourly_user_pushes(read_clickstream(spark, sf_dir, FEW, FEW), 1)
    ),
    "daily_event_counts": _on_events(lambda e: daily.daily_event_counts(_hourly(e))),
    "daily_event_top": _on_events(_daily_top),
    "daily_event_top_two_level": _on_events(lambda e: daily.daily_event_top(_hourly(e, TWICE), TOP), repos=FEW),
    "daily_user_counts": _on_events(_daily_users),
    "daily_user_top": _on_events(lambda e: daily.daily_user_top(hourly.hourly_user_pushes(e, 0), TOP)),
    "daily_peaks": _on_events(lambda e: scoring.daily_peaks(_daily_top(e))),
    "daily_max_norm": _on_events(lambda e: scoring.normalised_counts(_daily_top(e))),
    # with the minimums and cuts that the trend tables have by default
    "default_minimums_hourly": _on_events(lambda e: hourly.hourly_event_counts(_in_one_day(e)), repos=FEW),
    "default_minimums_scores": _on_events(_default_scores, repos=FEW),
    "default_minimum_users": _default_users,
    "stack_event_tables": _on_events(_stack_event_tables),
    "stack_hours": _on_events(_stack_hours),
    "aggregate_score": _on_events(lambda e: scoring.aggregate_score(_daily_top(e))),
    "pull_request_rows": _on_events(
        lambda e: details.pull_request_rows(e, False).drop("created_at"),
    ),
    "repo_detail_rows": _on_events(details.repo_detail_rows, *_DETAILS),
    "repo_detail_rows_any_language": _on_events(lambda e: details.repo_detail_rows(e, False), *_DETAILS),
    "repo_languages": _on_events(
        lambda e: details.repo_languages(details.pull_request_rows(e, False)).drop("n"),
    ),
    "scored_repo_details": _on_events(_scored_details, "score", *_DETAILS),
    "scored_repo_details_from_events": _on_events(_scored_details_from_events, "score", *_DETAILS),
    "scored_repo_details_by_shuffle": _on_events(_scored_details_by_shuffle, "score", *_DETAILS),
    **{
        f"top_repos_{metric}_{window}": _on_tables(
            lambda t, metric=metric, window=window: serving.top_repos(t, metric, window, AS_OF)
        )
        for metric in (serving.AGGREGATE, *serving.METRIC_EVENTS)
        for window in ("week", "month")
    },
    "repo_top_users": _on_tables(lambda t: serving.repo_top_users(t, "month", AS_OF)),
    "repo_top_users_of_top_repos": _on_tables(_top_users_of_top_repos),
    "top_users": _on_tables(lambda t: serving.top_users(t, "month", AS_OF)),
    "latest_repo_details": _on_tables(serving.latest_repo_details, *_DETAILS),
    "repo_profile": _on_tables(lambda t: serving.repo_profile(t, "month", AS_OF)),
    "repo_profile_of": _on_tables(lambda t: serving.repo_profile(t, "month", AS_OF, (name for name in NAMES))),
    "stored_repo_profile_of": _on_stored(lambda t: serving.repo_profile(t, "month", AS_OF, NAMES)),
    "stored_latest_repo_details": lambda spark, sf_dir: _plain(
        serving.latest_repo_details(serving.TrendTables.stored(_ingested(spark, sf_dir, SETTINGS))), *_DETAILS
    ),
    "stored_top_repos_aggregate_week": _on_stored(lambda t: serving.top_repos(t, serving.AGGREGATE, "week", AS_OF)),
    "stored_top_repos_push_month": _on_stored(lambda t: serving.top_repos(t, "push", "month", AS_OF)),
    "stored_repos_over": _on_stored(lambda t: serving.repos_over(t, "push", 2)),
    "profile_text": _on_tables(lambda t: serving.profile_text(serving.repo_profile(t, "month", AS_OF))),
    "repos_over": _on_events(
        lambda e: serving.repos_over(
            serving.TrendTables(daily.daily_event_counts(_hourly(e)), e, e, e), "push", 2
        )
    ),
    "repos_over_score": _on_tables(lambda t: serving.repos_over(t, serving.AGGREGATE, 0.5000001)),
    "backfill_counts": lambda spark, sf_dir: _stored_counts(_backfilled(spark, sf_dir, SETTINGS)),
    "backfill_details": lambda spark, sf_dir: _stored_details(_backfilled(spark, sf_dir, WITH_DETAILS)),
    "backfill_deep_layout": _deep_layout,
    "incremental_counts": lambda spark, sf_dir: _stored_counts(_ingested(spark, sf_dir, SETTINGS)),
    "incremental_details": lambda spark, sf_dir: _stored_details(_ingested(spark, sf_dir, WITH_DETAILS)),
    "event_time_counts": _event_time,
    "event_time_upserts": lambda spark, sf_dir: _plain(_in_three_deliveries(spark, sf_dir).read("event_time_counts")),
    "event_time_corrections": lambda spark, sf_dir: _plain(corrections(_in_three_deliveries(spark, sf_dir))),
    "event_time_late_rows": lambda spark, sf_dir: _plain(late_rows(_in_three_deliveries(spark, sf_dir))),
    "broken_lines": _broken_lines,
    "passed_over_deliveries": _passed_over,
    "export_pending_days": _export_pending,
}

# The operators of repotide/llm and their pipeline are optional: both may be absent.
SQL = dict(ORACLE)
# They may also lack a library that only they need; all that they share with the rest is imported above.
try:
    import corpus_pipeline
    from repotide.llm import registry
except ImportError as missing:
    if not (missing.name or "").startswith(("corpus_pipeline", "repotide.llm")):
        warnings.warn(f"without the training-data operators: {missing}", stacklevel=1)
else:
    QUERIES |= registry.QUERIES | {"pipeline": corpus_pipeline.run}
    SQL |= registry.ORACLE
    if corpus_pipeline.ORACLE_SQL:
        SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    """The most popular repositories of the last month."""
    return QUERIES["top_repos_aggregate_month"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
