"""The questions asked of the tables. Every answer is a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotide.functions.calendar import window_start
from repotide.functions.display import flag_text, languages_text, number_text, repo_url
from repotide.functions.naming import name_bucket
from repotide.functions.ranking import with_rank
from repotide.operators.details import newest_details
from repotide.schemas import DETAIL_FIELDS, FORK, PUSH, WATCH
from repotide.sources.tables import TableStore

# Sizes of the answers.
TOP_REPOS = 20
TOP_USERS_OF_REPO = 5
BUSY_DAY = 6000

METRIC_EVENTS = {"push": PUSH, "watch": WATCH, "fork": FORK}
AGGREGATE = "aggregate"

Day = date | str | Column
Names = DataFrame | Iterable[str] | None


@dataclass(frozen=True)
class TrendTables:
    """The daily tables, stored or computed. ``repo_latest``, where it is kept, answers for the newest details."""

    daily_events: DataFrame
    repo_users: DataFrame
    repo_scores: DataFrame
    repo_details: DataFrame
    repo_latest: DataFrame | None = None

    @staticmethod
    def stored(store: TableStore) -> TrendTables:
        names = ["daily_events", "repo_users", "repo_scores", "repo_details"]
        return TrendTables(*(store.read(name) for name in names + ["repo_latest"] * store.exists("repo_latest")))


def metric_values(tables: TrendTables, metric: str) -> tuple[DataFrame, str]:
    """Table and value column of a metric: ``aggregate``, ``push``, ``watch`` or ``fork``."""
    if metric == AGGREGATE:
        return tables.repo_scores, "score"
    if metric not in METRIC_EVENTS:
        raise ValueError(f"unknown metric {metric!r}")
    return tables.daily_events.where(F.col("event") == METRIC_EVENTS[metric]), "count"


def since(df: DataFrame, window: str | int, as_of: Day) -> DataFrame:
    """Rows from the first day of the window on; prunes partitions."""
    return df.where(F.col("create_date") >= window_start(as_of, window))


def as_names(repos: Names) -> DataFrame | tuple[str, ...] | None:
    """Names that can be read more than once. One name as plain text is an error."""
    if repos is None or isinstance(repos, DataFrame):
        return repos
    if isinstance(repos, str):
        raise TypeError("repos must be several names: a list, a tuple or a DataFrame")
    return tuple(repos)


def of_repos(df: DataFrame, repos: Names) -> DataFrame:
    """Rows of the given repositories, of all if ``repos`` is None."""
    repos = as_names(repos)
    if repos is None:
        return df
    if isinstance(repos, DataFrame):
        return df.join(repos.select("repo_name"), "repo_name", "left_semi")
    return df.where(F.col("repo_name").isin(list(repos)))


def top_repos(tables: TrendTables, metric: str, window: str | int, as_of: Day, k: int = TOP_REPOS) -> DataFrame:
    """The ``k`` repositories with the highest total of a metric in the window.

    Ranked by the total rounded to nine digits, as sums of doubles vary in the last ones
    with the order of the rows.
    """
    df, value = metric_values(tables, metric)
    total = F.sum(value).alias("total")
    return (
        since(df, window, as_of)
        .groupBy("repo_name")
        .agg(total)
        .orderBy(F.round("total", 9).desc(), F.asc("repo_name"))
        .limit(k)
    )


def repo_top_users(
    tables: TrendTables, window: str | int, as_of: Day, k: int = TOP_USERS_OF_REPO, repos: Names = None
) -> DataFrame:
    """The ``k`` users with most pushes to each repository in the window, numbered in ``rank``."""
    totals = (
        of_repos(since(tables.repo_users, window, as_of), repos)
        .groupBy("repo_name", "user_name")
        .agg(F.sum("count").alias("total"))
    )
    return with_rank(totals, ["repo_name"], [F.desc("total"), F.asc("user_name")], k)


def top_users(tables: TrendTables, window: str | int, as_of: Day, k: int = TOP_REPOS) -> DataFrame:
    """The ``k`` users with most pushes in the window, over all repositories."""
    return (
        since(tables.repo_users, window, as_of)
        .groupBy("user_name")
        .agg(F.sum("count").alias("total"))
        .orderBy(F.desc("total"), F.asc("user_name"))
        .limit(k)
    )


def latest_repo_details(tables: TrendTables, repos: Names = None) -> DataFrame:
    """The newest detail row of each repository.

    Read from the kept table, of the buckets of the given names only; else searched in all details.
    """
    repos = as_names(repos)
    if tables.repo_latest is None:
        return newest_details(of_repos(tables.repo_details, repos))
    latest = tables.repo_latest
    if isinstance(repos, tuple):
        latest = latest.where(F.col("bucket").isin([name_bucket(F.lit(name)) for name in repos]) if repos else F.lit(False))
    return of_repos(latest, repos).select(*tables.repo_details.columns)


def repo_profile(
    tables: TrendTables, window: str | int, as_of: Day, repos: Names = None, k: int = TOP_USERS_OF_REPO
) -> DataFrame:
    """One row per repository: its top users, its latest details and its address.

    Without ``repos`` every repository with users in the window or with details has a row. A
    given repository always has one; what is unknown of it stays empty or NULL.
    """
    repos = as_names(repos)
    ranked = F.sort_array(F.collect_list(F.struct("rank", "user_name")))
    users = (
        repo_top_users(tables, window, as_of, k, repos)
        .groupBy("repo_name")
        .agg(F.transform(ranked, lambda user: user["user_name"]).alias("users"))
    )
    details = latest_repo_details(tables, repos).select("repo_name", "languages", *DETAIL_FIELDS)
    if repos is None:
        known = users.join(details, "repo_name", "full_outer")
    else:
        session = tables.repo_users.sparkSession
        names = (
            repos.select("repo_name").distinct()
            if isinstance(repos, DataFrame)
            else session.createDataFrame([(name,) for name in sorted(set(repos))], "repo_name string")
        )
        known = names.join(users, "repo_name", "left").join(details, "repo_name", "left")
    return known.select(
        "repo_name",
        F.coalesce("users", F.array().cast("array<string>")).alias("users"),
        "languages",
        "has_wiki",
        "forks",
        F.col("open_issues_count").alias("open_issues"),
        F.col("stars_count").alias("stars"),
        "watchers",
        repo_url(F.col("repo_name")).alias("url"),
    )


def profile_text(profile: DataFrame) -> DataFrame:
    """The profile with every column as text, for display."""
    numbers = [number_text(F.col(c)).alias(c) for c in ("forks", "open_issues", "stars", "watchers")]
    return profile.select(
        "repo_name",
        F.array_join("users", ", ").alias("users"),
        languages_text(F.col("languages")).alias("languages"),
        flag_text(F.col("has_wiki")).alias("has_wiki"),
        *numbers,
        "url",
    )


def repos_over(tables: TrendTables, metric: str = "push", minimum: int = BUSY_DAY) -> DataFrame:
    """Days on which a repository's value exceeds ``minimum``."""
    df, value = metric_values(tables, metric)
    return df.where(F.col(value) > minimum).select("create_date", "repo_name", F.col(value).alias("value"))
