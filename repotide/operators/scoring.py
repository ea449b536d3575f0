"""Popularity score: each type's counts relative to the day's highest, averaged."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repotide.schemas import SCORE_DIVISOR

DAY_TYPE = ["create_date", "event"]


def daily_peaks(daily_events: DataFrame) -> DataFrame:
    """Highest count of each day and type."""
    return daily_events.groupBy(*DAY_TYPE).agg(F.max("count").alias("peak"))


def normalised_counts(daily_events: DataFrame) -> DataFrame:
    """Adds ``norm``, the count as a share of the day's highest of the same type.

    ``daily_events`` are top lists, so a day and type has at most as many rows as the cut leaves. The
    window that ranked them gathers the same groups, so this one needs no shuffle and no second scan.
    """
    peak = F.max("count").over(Window.partitionBy(*DAY_TYPE))
    return daily_events.withColumn("norm", F.col("count") / peak)


def aggregate_score(daily_events: DataFrame, divisor: int = SCORE_DIVISOR) -> DataFrame:
    """Score per day and repository. A type in which the repository has no row counts as 0."""
    return (
        normalised_counts(daily_events)
        .groupBy("create_date", "repo_name")
        .agg((F.sum("norm") / F.lit(divisor)).alias("score"))
    )
