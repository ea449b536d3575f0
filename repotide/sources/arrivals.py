"""The book of deliveries: which files came for which hour, and which of them were passed over."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotide.functions.calendar import Hour, days_scope
from repotide.sources.landing import chosen
from repotide.sources.tables import TableStore

OLDER, EMPTY = "older delivery", "zero bytes"


def note_files(store: TableStore, files: DataFrame, source: str) -> set[Hour]:
    """Enters files, as ``list_files`` gives them, and returns their hours.

    ``source`` names the batch or listing they come from. The same source entered again replaces its own rows of
    the days, so a batch that is done again is entered once.
    """
    store.create("deliveries")
    hours = {"hours": F.collect_set(F.struct("create_date", "hour"))}
    store.write("deliveries", files.withColumn("source", F.lit(source)), seen=hours)
    return {tuple(hour) for hour in hours["hours"]}


def known_files(store: TableStore, days: Iterable[date] | None = None) -> DataFrame:
    """Every file once, with its newest age and length; only the folders of ``days`` are listed."""
    scope = None if days is None else days_scope(days)
    last = F.max_by(F.struct("delivery", "length", "modified"), "modified").alias("last")
    return store.read("deliveries", scope, days).groupBy("create_date", "hour", "path").agg(last).select("create_date", "hour", "path", "last.*")


def chosen_files(store: TableStore, hours: set[Hour]) -> dict[Hour, str]:
    """What to read for ``hours``: the newest of all deliveries entered so far."""
    days = {day for day, _ in hours}
    return {hour: path for hour, path in chosen(known_files(store, days)).items() if hour in hours} if days else {}


def passed_over(store: TableStore, scope: Column | None = None) -> DataFrame:
    """Deliveries that are in no table: hour, delivery, how many files it has, bytes and why.

    An hour whose only file has zero bytes is among them.
    """
    files = known_files(store)
    files = files if scope is None else files.where(scope)
    each = files.groupBy("create_date", "hour", "delivery").agg(
        F.max("modified").alias("modified"), F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
    # an hour has few deliveries: one row each, the newest with any content first
    newest = each.where("bytes > 0").groupBy("create_date", "hour").agg(F.max(F.struct("modified", "delivery")).alias("newest"))
    rest = each.join(newest, ["create_date", "hour"], "left").where("newest IS NULL OR delivery <> newest.delivery")
    reason = F.when(F.col("bytes") == 0, EMPTY).otherwise(OLDER)
    return rest.select("create_date", "hour", "delivery", "files", "bytes", reason.alias("reason"))
