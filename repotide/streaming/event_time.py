"""Event-time variants of the hourly counts.

``event_time_counts`` gives an hour out once, when the watermark has passed it, and loses what comes later.
``upsert_event_time_counts`` loses nothing: every batch's counts are kept by hour and batch, and an hour's
counts are the sums over its batches. So any number of deliveries in any order gives the counts that one
delivery of everything gives. Rows of an hour that the watermark had passed are marked late: they are
corrections of an hour that readers may have taken as closed.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.functions.calendar import hours_scope, utc_date, utc_hour
from repotide.schemas import COUNTED_EVENTS
from repotide.sources.tables import TableStore

HOUR_SECONDS = 3600
LATENESS = timedelta(hours=2)


def event_time_counts(raw: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Events per hour of ``created_at``, type and repository, of a stream of raw events.

    An hour is given out once the newest event is ``lateness`` past its end, and the state
    kept for it is dropped then; events that come later still are not counted.
    """
    counts = (
        raw.where(F.col("type").isin(list(COUNTED_EVENTS)))
        .withWatermark("created_at", lateness)
        .groupBy(F.window("created_at", "1 hour"), F.col("type").alias("event"), F.col("repo.name").alias("repo_name"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    start = F.col("window.start")
    return counts.select(
        utc_date(start).alias("create_date"), utc_hour(start).alias("hour"), "event", "repo_name", "count"
    )


def run_event_time_counts(raw: DataFrame, out: str, checkpoint: str, lateness: str = "2 hours") -> None:
    """Appends the finished hours of what has arrived to a Parquet table, then stops."""
    query = (
        event_time_counts(raw, lateness)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .partitionBy("create_date")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _passed(store: TableStore, query: str, batch: int) -> datetime | None:
    """The newest event of all batches before ``batch``."""
    before = {number for (number,) in store.partitions("event_time_batches", F.col("batch") < batch)}
    if not before:
        return None
    row = store.read("event_time_batches", F.col("batch") == max(before)).first()
    if row["query"] != query:
        raise ValueError("the tables were filled from another checkpoint; batches of this one would replace its own")
    return row["newest"]


def upsert_batch(batch: DataFrame, number: int, store: TableStore, query: str, lateness: timedelta = LATENESS) -> None:
    """Adds a batch of raw events to the counts. Doing it again, as after a failure, changes nothing.

    The events are read once: counted by task, then by hour and repository, into partitions of their hour and
    batch. Then only the hours touched are summed again.
    """
    for name in ("event_time_batches", "event_time_deltas"):
        store.create(name)
    newest_before = _passed(store, query, number)
    created = F.col("created_at")
    closed = F.lit(False)
    if newest_before is not None:
        end = (F.floor(F.unix_seconds(created) / HOUR_SECONDS) + 1) * HOUR_SECONDS
        closed = F.coalesce(end <= F.unix_seconds(F.lit(newest_before - lateness)), F.lit(False))
    counts = (
        batch.where(F.col("type").isin(list(COUNTED_EVENTS)))
        .groupBy(
            utc_date(created).alias("create_date"),
            utc_hour(created).alias("hour"),
            F.col("type").alias("event"),
            F.col("repo.name").alias("repo_name"),
            closed.alias("late"),
        )
        .agg(F.count(F.lit(1)).alias("count"), F.max("created_at").alias("newest"))
        .withColumn("batch", F.lit(number).cast("bigint"))
    )
    # events without a time have no hour: they are seen, not written
    seen = {"newest": F.max("newest"), "undated": F.coalesce(F.sum(F.when(F.col("hour").isNull(), F.col("count"))), F.lit(0))}
    touched = {(day, hour) for day, hour, _ in store.write("event_time_deltas", counts, seen=seen)}
    if touched:
        days = {day for day, _ in touched}
        deltas = store.read("event_time_deltas", hours_scope(touched), days)
        sums = deltas.groupBy("create_date", "hour", "event", "repo_name").agg(F.sum("count").alias("count"))
        store.replace("event_time_counts", sums, hours_scope(touched), days=days)
    newest = max((t for t in (newest_before, seen["newest"]) if t is not None), default=None)
    row = [(query, newest, seen["undated"], number)]
    store.write("event_time_batches", store.spark.createDataFrame(row, "query string, newest timestamp, undated bigint, batch bigint"))


def upsert_event_time_counts(raw: DataFrame, out: str, checkpoint: str, lateness: timedelta = LATENESS) -> TableStore:
    """Brings the counts below ``out`` up to date with all that has arrived, then stops."""
    store = TableStore(raw.sparkSession, out)

    def upsert(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        upsert_batch(batch, number, TableStore(session, out), query, lateness)

    run = raw.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
    return store


def corrections(store: TableStore) -> DataFrame:
    """Counts that came for hours already passed: create_date, hour, event, repo_name, count and batch."""
    late = store.read("event_time_deltas").where("late")
    return late.select("create_date", "hour", "event", "repo_name", "count", "batch")


def late_rows(store: TableStore) -> DataFrame:
    """How many rows came late for each hour, and with how many batches."""
    return corrections(store).groupBy("create_date", "hour").agg(F.sum("count").alias("rows"), F.count_distinct("batch").alias("batches"))
