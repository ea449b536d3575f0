"""Helpers that several of the operators share."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repotide.session import work_dir

#: Characters between words: space and \x09 to \x0D.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let_workers_import(spark: SparkSession) -> None:
    """Python workers find this package where the driver has it, unless they have it installed."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet to the shared work folder and read back: its lineage ends there."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def full_text(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def split_words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    return F.array_remove(F.split(F.translate(text, BLANKS[1:], " " * len(BLANKS[1:])), " "), "")


def row_hash(*columns: str) -> Column:
    """Tells rows of one doc_id apart; rows that agree in ``columns`` get equal hashes."""
    return F.xxhash64(*[F.col(c) for c in columns])


def gapless(df: DataFrame, keys: list[str], order: list[str], name: str, slices: int) -> DataFrame:
    """Adds ``name``: numbers from 0 without gaps within ``keys``, the same in every run.

    A key's rows are numbered in ``slices`` parts by a hash of ``order``, whose columns should tell
    rows apart, and each part starts where the ones before it end. So no task holds all rows of a
    frequent key. Choose ``slices`` by the number of rows (``slices_for``).
    """
    part, before = f"{name}_part", f"{name}_before"
    df = df.withColumn(part, F.pmod(F.xxhash64(*order), F.lit(slices)).cast("int"))
    starts = (
        df.groupBy(*keys, part)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn(
            before,
            F.coalesce(F.sum("n").over(Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .drop("n")
    )
    inside = F.row_number().over(Window.partitionBy(*keys, part).orderBy(*order)) - 1
    return (
        df.withColumn(name, inside)
        .join(starts, [*keys, part])
        .withColumn(name, (F.col(name) + F.col(before)).cast("long"))
        .drop(part, before)
    )


def slices_for(rows: int, per_slice: int = 200_000) -> int:
    """Parts of about ``per_slice`` rows."""
    return max(8, -(-rows // per_slice))
