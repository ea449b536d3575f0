"""Daily sums of hourly counts, and their top lists.

The hourly minimum is not additive: hours below it never reach the day's sum, so daily
numbers always start from the hourly counts, not from the events.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.functions.ranking import top_per_group
from repotide.schemas import DAILY_TOP


def daily_event_counts(hourly_events: DataFrame) -> DataFrame:
    """Sum per day, type and repository."""
    return hourly_events.groupBy("create_date", "event", "repo_name").agg(F.sum("count").alias("count"))


def daily_event_top(hourly_events: DataFrame, k: int = DAILY_TOP) -> DataFrame:
    """The ``k`` most active repositories of each day and type."""
    return top_per_group(
        daily_event_counts(hourly_events),
        ["create_date", "event"],
        [F.desc("count"), F.asc("repo_name")],
        k,
    )


def daily_user_counts(hourly_users: DataFrame) -> DataFrame:
    """Sum per day, repository and user."""
    return hourly_users.groupBy("create_date", "repo_name", "user_name").agg(F.sum("count").alias("count"))


def daily_user_top(hourly_users: DataFrame, k: int = DAILY_TOP) -> DataFrame:
    """The ``k`` most active (repository, user) pairs of each day."""
    return top_per_group(
        daily_user_counts(hourly_users),
        ["create_date"],
        [F.desc("count"), F.asc("repo_name"), F.asc("user_name")],
        k,
    )


def stack(*frames: DataFrame) -> DataFrame:
    """Frames of hours, or of event types, below each other; matched by name, copies kept."""
    return reduce(lambda a, b: a.unionByName(b), frames)
