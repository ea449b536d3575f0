"""Archive hours as JSON lines in a landing folder."""

from __future__ import annotations

import re
from datetime import date, datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.functions import naming
from repotide.functions.calendar import Hour, utc_date, utc_hour
from repotide.schemas import EVENT_SCHEMA, USED_EVENTS

# Columns of Spark's binaryFile source; the content is never selected, so never read.
FILE_LIST_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"

# Spark's default skips files more than a week older than the newest one it has seen.
NEVER_TOO_OLD = "36500d"

#: Column with the text of a line that could not be read.
BROKEN = "broken"

_HEAD = "payload.pull_request.head.repo"
# Our name and the archive's name of each head repository field.
HEAD_FIELDS = {
    "language": "language",
    "open_issues_count": "open_issues_count",
    "forks": "forks",
    "has_wiki": "has_wiki",
    "stars_count": "stargazers_count",
    "watchers": "watchers_count",
}


def read_events(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Raw events of files or folders, ``.json`` or ``.json.gz``, with their ``file_path``.

    A line that is no JSON reads as NULLs; the type filter of ``canonical_events`` drops it. The line itself is
    in ``broken``, as is one of which some field could not be read.
    """
    reader = spark.read.schema(f"{EVENT_SCHEMA}, {BROKEN} string").option("columnNameOfCorruptRecord", BROKEN)
    return reader.option("recursiveFileLookup", True).json(paths).select("*", "_metadata.file_path")


def files_with_broken_lines() -> Column:
    """Aggregate for ``observe`` on raw events: a path for each file concerned, at most the files read."""
    return F.collect_set(F.when(F.col(BROKEN).isNotNull(), F.col("file_path")))


def broken_lines(raw: DataFrame) -> DataFrame:
    """Lines that could not be read: hour, file, line, reason, and how often the file has the line.

    ``no JSON`` lines have given no event; of a ``bad field`` one the other fields are in use.
    """
    path = F.col("file_path")
    # Spark parses only fields that are asked for, and finds a bad one only then
    fields = F.xxhash64(*(c for c in raw.columns if c not in (BROKEN, "file_path"))).alias("fields")
    reason = F.when(F.col("type").isNull() & F.col("id").isNull(), "no JSON").otherwise("bad field")
    return (
        raw.where(F.col(BROKEN).isNotNull())
        .groupBy(naming.path_date(path).alias("create_date"), naming.path_hour(path).alias("hour"), path.alias("file"), F.col(BROKEN).alias("line"), reason.alias("reason"), fields)
        .agg(F.count(F.lit(1)).alias("count"))
        .drop("fields")
    )


def stream_events(spark: SparkSession, landing: str) -> DataFrame:
    """The raw events of a landing folder as a stream.

    All files there are one batch, so that the watermark of a run does not move between its files,
    and none is skipped for its age.
    """
    reader = spark.readStream.schema(EVENT_SCHEMA).option("recursiveFileLookup", True)
    return reader.option("maxFileAge", NEVER_TOO_OLD).json(landing)


def canonical_events(raw: DataFrame, hour_from: str = "file") -> DataFrame:
    """Flat events of the used types, placed in the hour their file is named after.

    A file whose name gives no hour is an error, as its rows would be in no table. With
    ``hour_from="created_at"`` events go to their own UTC hour instead, for landing folders without
    such names.
    """
    if hour_from == "file":
        path = F.col("file_path")
        nameless = F.raise_error(F.concat(F.lit("the name gives no hour: "), path))
        day = F.coalesce(naming.path_date(path), nameless.cast("date"))
        hour = F.coalesce(naming.path_hour(path), nameless.cast("int"))
    elif hour_from == "created_at":
        day, hour = utc_date(F.col("created_at")), utc_hour(F.col("created_at"))
    else:
        raise ValueError("hour_from must be 'file' or 'created_at'")
    head = F.struct(*(F.col(f"{_HEAD}.{theirs}").alias(ours) for ours, theirs in HEAD_FIELDS.items()))
    return raw.where(F.col("type").isin(list(USED_EVENTS))).select(
        day.alias("create_date"),
        hour.alias("hour"),
        F.col("type").alias("event"),
        F.col("repo.name").alias("repo_name"),
        F.col("actor.login").alias("user_name"),
        "created_at",
        "id",
        F.when(F.col(_HEAD).isNotNull(), head).alias("head_repo"),
    )


def list_files(spark: SparkSession, landing: str, first: date, last: date) -> DataFrame:
    """Files of the hours from ``first`` to ``last``: day, hour, path, delivery, age and length.

    Hours may lie at any depth, as what is read later is found at any depth too. Only names are
    listed. Spark skips files of zero bytes, so these count as not delivered; ``empty_files`` finds them.
    """
    reader = spark.read.format("binaryFile").schema(FILE_LIST_SCHEMA).option("recursiveFileLookup", True)
    try:
        files = reader.load(landing)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], FILE_LIST_SCHEMA)
    return hours_of_files(files).where(F.col("create_date").between(first, last))


def hours_of_files(files: DataFrame) -> DataFrame:
    """The files, listed by Spark's binaryFile source, that belong to an archive hour."""
    path = F.col("path")
    hours = files.where(naming.is_hour_path(path)).select(
        naming.path_date(path).alias("create_date"),
        naming.path_hour(path).alias("hour"),
        "path",
        naming.delivery(path).alias("delivery"),
        F.col("modificationTime").alias("modified"),
        "length",
    )
    return hours.where(F.col("create_date").isNotNull() & (F.col("hour") < 24))


def newest_delivery(files: DataFrame) -> DataFrame:
    """What to read for each hour: where it was delivered more than once, the newest delivery."""
    newest = F.max(F.struct("modified", "delivery"))["delivery"]
    return files.where(F.col("length") > 0).groupBy("create_date", "hour").agg(newest.alias("delivery"))


def empty_files(spark: SparkSession, landing: str, first: date, last: date) -> DataFrame:
    """Files of zero bytes of the hours from ``first`` to ``last``, like ``list_files``.

    Spark's sources leave these out, so the folder's names are listed once on the driver.
    """
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(landing)
    files = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = jvm.org.apache.spark.deploy.SparkHadoopUtil.get().listLeafStatuses(files, root).mkString("\n") if files.exists(root) else ""
    empty = re.findall(r"path=([^;]*);[^\n]*?length=0;[^\n]*?modification_time=(\d+)", found)
    rows = [(path, datetime.fromtimestamp(int(ms) / 1000, timezone.utc), 0, None) for path, ms in empty]
    listed = spark.createDataFrame(rows, FILE_LIST_SCHEMA)
    return hours_of_files(listed).where(F.col("create_date").between(first, last))


def hour_files(spark: SparkSession, landing: str, first: date, last: date) -> dict[Hour, str]:
    """The path to read for every hour present: one per hour, however many files it has."""
    return chosen(list_files(spark, landing, first, last))


def chosen(files: DataFrame) -> dict[Hour, str]:
    rows = newest_delivery(files).collect()
    return {(row.create_date, row.hour): row.delivery for row in rows}
