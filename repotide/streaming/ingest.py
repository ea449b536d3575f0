"""Incremental job: picks up the files that have arrived since its last run.

The stream is one of files, not of events: its rows are paths, so finding out what is new
reads no JSON. Each batch recomputes the hours it names, from the newest delivery that the book of deliveries
has of each. Which files are new is known from the checkpoint, never from the clock, and a batch that failed is
done again.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from repotide.plans.refresh import Settings, refresh_files
from repotide.sources.arrivals import chosen_files, note_files
from repotide.sources.landing import FILE_LIST_SCHEMA, NEVER_TOO_OLD, hours_of_files, list_files
from repotide.sources.tables import TableStore


EVER = date(1000, 1, 1), date(9999, 12, 31)


def arriving_files(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """Files of archive hours as they arrive."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILE_LIST_SCHEMA)
        .option("recursiveFileLookup", True)
        # never skip a late file for its age; the number of hours bounds the files remembered
        .option("maxFileAge", NEVER_TOO_OLD)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return hours_of_files(reader.load(landing))


def ingest_batch(batch: DataFrame, number: int, landing: str, out: str, settings: Settings) -> None:
    """Refreshes the hours named by a batch of files, at most one row per file of the batch.

    Nothing is listed: the batch's files go into the book of deliveries, which knows what came before. Only a job
    that began before there was such a book lists the folder, once.
    """
    spark = batch.sparkSession
    store = TableStore(spark, out)
    if number and not store.exists("deliveries"):
        note_files(store, list_files(spark, landing, *EVER), "listing")
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    touched = note_files(store, batch, f"{query}-{number}")
    if touched:
        refresh_files(store, chosen_files(store, touched), settings)


def ingest_available(
    spark: SparkSession,
    landing: str,
    out: str,
    checkpoint: str,
    settings: Settings = Settings(),
    max_files: int | None = None,
) -> None:
    """Processes everything that has arrived, then stops. Run it every hour."""
    query = (
        arriving_files(spark, landing, max_files)
        .writeStream.foreachBatch(lambda batch, number: ingest_batch(batch, number, landing, out, settings))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
