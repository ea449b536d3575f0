"""Repository details, taken from pull-request events.

A pull request carries its *head* repository, often a fork, so the details and languages
attached to a repository name are those of the repositories that sent it changes.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.functions.joins import may_broadcast, salted_join
from repotide.functions.ranking import top_per_group
from repotide.schemas import DETAIL_FIELDS, PULL_REQUEST

HOUR_REPO = ["create_date", "hour", "repo_name"]
NEWEST = ("create_date", "hour", "created_at", "id")


def pull_request_rows(events: DataFrame, require_language: bool = True) -> DataFrame:
    """One row per pull-request event that names a repository and has a head repository.

    The head repository may have NULL members; with ``require_language`` its language may not.
    """
    rows = (
        events.where(F.col("event") == PULL_REQUEST)
        .dropna(subset=["repo_name", "head_repo"])
        .select(
            *HOUR_REPO,
            "head_repo.language",
            *(f"head_repo.{field}" for field in DETAIL_FIELDS),
            "created_at",
            "id",
        )
    )
    return rows.where(F.col("language").isNotNull()) if require_language else rows


def repo_languages(rows: DataFrame) -> DataFrame:
    """Distinct languages per hour and repository, sorted; empty if all are NULL."""
    return rows.groupBy(*HOUR_REPO).agg(
        F.sort_array(F.collect_set("language")).alias("languages"),
        F.count(F.lit(1)).alias("n"),
    )


def attach_languages(rows: DataFrame, list_rows: int | None = None) -> DataFrame:
    """Every row gets the languages of its hour and repository, in place of its own.

    ``list_rows``, if given, must be a proven upper bound of the number of hours times
    repositories; it decides on broadcasting the lists. Else both meet by hour, repository and a salt,
    each list once per salt: the rows are read twice, and both sides are plain exchanges, so the
    skew join can split a repository further.
    """
    lists = repo_languages(rows).drop("n")
    rows = rows.drop("language")
    if may_broadcast(list_rows):
        return rows.join(F.broadcast(lists), HOUR_REPO)
    return salted_join(rows, lists, HOUR_REPO, "id")


def repo_detail_rows(events: DataFrame, require_language: bool = True) -> DataFrame:
    """Detail rows of every repository, with the hour's languages."""
    return attach_languages(pull_request_rows(events, require_language))


def scored_repo_details(scores: DataFrame, details: DataFrame, score_rows: int | None = None) -> DataFrame:
    """Detail rows of the scored repositories, with the day's score.

    ``score_rows`` is a proven upper bound of the rows of ``scores``, which decides on
    broadcasting them; without one the join is by shuffle, salted so that a repository may have any
    number of rows.
    """
    keys = ["create_date", "repo_name"]
    if may_broadcast(score_rows):
        return details.join(F.broadcast(scores), keys)
    return salted_join(details, scores, keys, "id")


def scored_repo_details_from_events(
    scores: DataFrame, events: DataFrame, require_language: bool = True, score_rows: int | None = None
) -> DataFrame:
    """``scored_repo_details(scores, repo_detail_rows(events))`` with the join done first.

    A language list depends only on rows of the same day and repository, so rows without a
    score can go before the lists are made, and nearly all rows go there.
    """
    rows = scored_repo_details(scores, pull_request_rows(events, require_language), score_rows)
    return attach_languages(rows, None if score_rows is None else 24 * score_rows)


def hour_bits(hours: Iterable[int]) -> int:
    """Hours of a day as bits of a number."""
    return sum(1 << hour for hour in set(hours))


def with_coverage(scores: DataFrame, lookups: DataFrame, hours: Mapping[date, int], require_language: bool) -> DataFrame:
    """Adds ``covered``: whether stored details of the repository have all the hours of its day in ``hours`` (bits)."""
    known = lookups.where(F.col("require_language") == require_language).select("create_date", "repo_name", F.col("hours").alias("looked_up"))
    pairs = [part for day, bits in sorted(hours.items()) for part in (F.lit(day), F.lit(bits))]
    needed = F.coalesce(F.create_map(*pairs)[F.col("create_date")], F.lit(0)) if pairs else F.lit(0)
    covered = F.coalesce(F.col("looked_up"), F.lit(0)).bitwiseAND(needed) == needed
    return scores.join(known, ["create_date", "repo_name"], "left").withColumn("covered", covered).drop("looked_up")


def details_still_good(scores: DataFrame, details: DataFrame, score_rows: int | None = None) -> DataFrame:
    """Stored details of repositories that are still scored, with the day's score as it is now."""
    return scored_repo_details(scores, details.drop("score"), score_rows)


def newest_details(details: DataFrame) -> DataFrame:
    """The newest row of each repository: by hour, then event time, then id."""
    newest = [F.desc(column) for column in NEWEST]
    return top_per_group(details, ["repo_name"], newest, 1)
