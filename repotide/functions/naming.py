"""Names of archive hours: ``YYYY-MM-DD/YYYY-MM-DD-H.json[.gz]``, the hour not padded."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from repotide.schemas import NAME_BUCKETS

# An hour is one file, or a folder with part files at any depth. Group 1 is the
# delivery (file or folder), 2 the day, 3 the hour.
HOUR_PATH = r"^(.*?(\d{4}-\d{2}-\d{2})-(\d{1,2})\.json(?:\.gz)?)(?:/.*)?$"


def hour_file_name(day: Column, hour: Column) -> Column:
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("-"), hour.cast("string"), F.lit(".json"))


def is_hour_path(path: Column) -> Column:
    return path.rlike(HOUR_PATH)


def delivery(path: Column) -> Column:
    return F.regexp_extract(path, HOUR_PATH, 1)


def path_date(path: Column) -> Column:
    return F.try_to_date(F.regexp_extract(path, HOUR_PATH, 2), "yyyy-MM-dd")


def path_hour(path: Column) -> Column:
    return F.regexp_extract(path, HOUR_PATH, 3).try_cast("int")


def name_bucket(name: Column) -> Column:
    """Partition of a name in tables that are looked up by it."""
    return F.pmod(F.xxhash64(name), F.lit(NAME_BUCKETS)).cast("int")
