"""Counts per archive hour."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.schemas import HOURLY_MINIMUMS, HOURLY_USER_MINIMUM, PUSH

HOUR = ["create_date", "hour"]


def hourly_event_counts(events: DataFrame, minimums: Mapping[str, int] = HOURLY_MINIMUMS) -> DataFrame:
    """Events per hour, type and repository, kept where above the minimum of the type.

    One pass for all types; the partial aggregation before the shuffle leaves at most one
    row per task and group, so a very active repository does not load one task.
    """
    above = reduce(
        lambda a, b: a | b,
        [(F.col("event") == event) & (F.col("count") > least) for event, least in minimums.items()],
    )
    return (
        events.where(F.col("event").isin(list(minimums)))
        .groupBy(*HOUR, "event", "repo_name")
        .agg(F.count(F.lit(1)).alias("count"))
        .where(above)
    )


def hourly_user_pushes(events: DataFrame, minimum: int = HOURLY_USER_MINIMUM) -> DataFrame:
    """Pushes per hour, repository and user, kept where above ``minimum``."""
    return (
        events.where(F.col("event") == PUSH)
        .groupBy(*HOUR, "repo_name", "user_name")
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") > minimum)
    )
