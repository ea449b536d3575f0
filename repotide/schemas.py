"""Event schema, table schemas and the fixed values of the trend tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

PUSH, WATCH, FORK, PULL_REQUEST = "PushEvent", "WatchEvent", "ForkEvent", "PullRequestEvent"
COUNTED_EVENTS = (PUSH, WATCH, FORK)
USED_EVENTS = (*COUNTED_EVENTS, PULL_REQUEST)

# Hourly minimums (a count must be greater), daily cut, score divisor.
HOURLY_MINIMUMS = {PUSH: 10, WATCH: 5, FORK: 4}
HOURLY_USER_MINIMUM = 10
DAILY_TOP = 50
SCORE_DIVISOR = 3

# Schemas are DDL text, so that no session is needed to import this module.
# Only the fields in use are declared: JSON parsing skips everything else, a missing
# field reads as NULL, and no pass over the files is needed to infer a schema.
EVENT_SCHEMA = """
    id string,
    type string,
    created_at timestamp,
    actor struct<login: string>,
    repo struct<name: string>,
    payload struct<pull_request: struct<head: struct<repo: struct<
        language: string,
        open_issues_count: bigint,
        forks: bigint,
        has_wiki: boolean,
        stargazers_count: bigint,
        watchers_count: bigint>>>>
"""

HEAD_REPO = (
    "struct<language: string, open_issues_count: bigint, forks: bigint, has_wiki: boolean, "
    "stars_count: bigint, watchers: bigint>"
)

DETAIL_FIELDS = ("open_issues_count", "has_wiki", "forks", "stars_count", "watchers")
_DETAIL_DDL = (
    "open_issues_count bigint, has_wiki boolean, forks bigint, stars_count bigint, "
    "watchers bigint, languages array<string>, created_at timestamp, id string"
)


@dataclass(frozen=True)
class Table:
    """Columns and partition columns of one stored table."""

    name: str
    columns: str
    partitions: str

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(f"{self.columns}, {self.partitions}")

    @property
    def keys(self) -> list[str]:
        return T.StructType.fromDDL(self.partitions).fieldNames()


# What is computed hour by hour is kept by the hour, so that a new hour replaces its own partition
# and no other; what is computed of a day is kept by the day.
_BY_HOUR = "create_date date, hour int"
_BY_DAY = "create_date date"

#: Buckets of the tables that are looked up by name.
NAME_BUCKETS = 16

TABLES = {
    t.name: t
    for t in (
        Table(
            "events",
            f"event string, repo_name string, user_name string, created_at timestamp, id string, head_repo {HEAD_REPO}",
            _BY_HOUR,
        ),
        Table("hourly_events", "event string, repo_name string, count bigint", _BY_HOUR),
        Table("hourly_users", "repo_name string, user_name string, count bigint", _BY_HOUR),
        Table("hourly_repo_details", f"repo_name string, {_DETAIL_DDL}", _BY_HOUR),
        Table("daily_events", "event string, repo_name string, count bigint", _BY_DAY),
        Table("repo_users", "repo_name string, user_name string, count bigint", _BY_DAY),
        Table("repo_scores", "repo_name string, score double", _BY_DAY),
        Table("repo_details", f"repo_name string, score double, hour int, {_DETAIL_DDL}", _BY_DAY),
        # the newest row of repo_details for each repository, by a hash of its name
        Table("repo_latest", f"repo_name string, score double, create_date date, hour int, {_DETAIL_DDL}", "bucket int"),
    )
}

# What the jobs note about their own work; no trend is computed from these.
BOOKS = {
    t.name: t
    for t in (
        # what the database has of a table's day; the row with the highest number is the state
        Table("exports", "name string, create_date date, rows bigint, digest string", "number bigint"),
        # files as they arrived; a file is known by its path, and may be noted by more than one source
        Table("deliveries", "hour int, path string, delivery string, modified timestamp, length bigint", "create_date date, source string"),
        # which hours (a bit for each) the stored details of a scored repository were taken from
        Table("detail_lookups", "repo_name string, hours int, require_language boolean", _BY_DAY),
        # months that a backfill has finished, with a digest of the files they were made of
        Table("finished_months", "settings string, files string", "month string"),
        # lines that could not be read, or only in part, of the hours' files
        Table("broken_lines", "file string, line string, reason string, count bigint", _BY_HOUR),
        # counts by event time: what each batch brought, their sums, and how far each batch had come
        Table("event_time_deltas", "event string, repo_name string, count bigint, late boolean", f"{_BY_HOUR}, batch bigint"),
        Table("event_time_counts", "event string, repo_name string, count bigint", _BY_HOUR),
        Table("event_time_batches", "query string, newest timestamp, undated bigint", "batch bigint"),
    )
}
