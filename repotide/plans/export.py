"""Keeps the daily tables of a database like the stored ones.

The book ``exports`` has, for each exported table and day, how many rows went out and a digest of them. A
day whose rows give another digest, for a late hour, a second delivery or a day left without rows, is sent as a
whole and takes the place of what the database has of it. A day that is still growing is sent again with every
hour; nothing needs to be known of when a day is closed.

The digest is taken before the rows are read, and the book is written after the database: a run that is cut
short, or rows that change meanwhile, make a day go out once more than needed, which replaces it by the same rows.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotide.functions.calendar import by_month, days_scope
from repotide.schemas import BOOKS
from repotide.sources.jdbc import exported_frames
from repotide.sources.tables import TableStore

_HALF = (1 << 32) - 1
#: Entries of the book, a folder each, before they become one.
MOST_ENTRIES = 100


class Target(Protocol):
    def replace_days(self, rows: DataFrame, table: str, days: Collection[date]) -> None: ...


def day_digests(rows: DataFrame) -> DataFrame:
    """Number and digest of each day's rows, the same for any order of them.

    Doubles count to nine digits, as sums of them vary in the last ones. One partial aggregation: a row per task and
    day is shuffled.
    """
    values = [F.round(name, 9) if kind == "double" else F.col(name) for name, kind in rows.dtypes]
    present = [F.isnull(name).cast("int") for name in rows.columns]
    both = F.xxhash64(*values, *present)
    halves = [F.sum(F.shiftrightunsigned(both, 32)), F.sum(both.bitwiseAND(F.lit(_HALF)))]
    count = F.count(F.lit(1))
    return rows.groupBy("create_date").agg(count.alias("rows"), F.concat_ws(":", *(h.cast("string") for h in halves)).alias("digest"))


def exported_days(store: TableStore) -> DataFrame:
    """What the book says the database has: name, create_date, rows and digest."""
    store.create("exports")
    last = F.max_by(F.struct("rows", "digest"), "number").alias("last")
    return store.read("exports").groupBy("name", "create_date").agg(last).select("name", "create_date", "last.rows", "last.digest")


def pending_days(store: TableStore, scope: Column | None = None) -> DataFrame:
    """Days that differ from what went out: name, create_date, and the number and digest of their rows now.

    ``scope`` confines the days. A day that has lost its rows is pending with 0 rows.
    """
    frames = [day_digests(rows).select(F.lit(name).alias("name"), "*") for name, rows in exported_frames(store).items()]
    now = reduce(DataFrame.unionByName, frames)
    sent = exported_days(store).select("name", "create_date", F.col("digest").alias("sent"))
    days = now.join(sent, ["name", "create_date"], "full_outer")
    days = days.where(~F.col("digest").eqNullSafe(F.col("sent"))).select("name", "create_date", F.coalesce("rows", F.lit(0)).alias("rows"), "digest")
    return days if scope is None else days.where(scope)


def mark_exported(store: TableStore, days: DataFrame) -> None:
    """Notes that the database has ``days``, as given by ``pending_days``."""
    number = (store.read("exports").agg(F.max("number")).first()[0] or 0) + 1
    keys = BOOKS["exports"].keys
    rows = days.select("name", "create_date", "rows", "digest", F.lit(number).cast("bigint").alias("number"))
    rows.coalesce(1).write.mode("append").partitionBy(*keys).parquet(store.path("exports"))


def compact_book(store: TableStore, most: int = MOST_ENTRIES) -> None:
    """Writes the book's state as one entry once it has more than ``most``, then removes the older ones."""
    numbers = sorted(n for (n,) in store.partitions("exports", F.lit(True)))
    if len(numbers) > most:
        mark_exported(store, exported_days(store))
        for number in numbers:
            store.drop("exports", (number,))


def export_changes(store: TableStore, target: Target, scope: Column | None = None, all_days: bool = False) -> list[tuple[str, date]]:
    """Sends the days that have changed since they last went out, and returns them.

    With ``all_days`` those of ``scope`` go out whatever the book says. A table goes month by month, each followed by
    its entry in the book.
    """
    spark, sent = store.spark, []
    if all_days:
        frames = [day_digests(rows).select(F.lit(name).alias("name"), "*") for name, rows in exported_frames(store, scope).items()]
        pending = reduce(DataFrame.unionByName, [*frames, pending_days(store, scope).where("rows = 0")])
    else:
        pending = pending_days(store, scope)
    rows = sorted(pending.collect(), key=lambda r: (r["name"], r["create_date"]))  # tables times calendar days at most
    frames = exported_frames(store)
    for name in sorted({r["name"] for r in rows}):
        of_table = {r["create_date"]: r for r in rows if r["name"] == name}
        for days in by_month(of_table):
            target.replace_days(frames[name].where(days_scope(days)), name, days)
            mark_exported(store, spark.createDataFrame([tuple(of_table[d]) for d in days], pending.schema))
            sent += [(name, day) for day in days]
    compact_book(store)
    return sent
