"""The stored tables: Parquet, partitioned by day or by day and hour."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, StructType

from repotide.schemas import BOOKS, TABLES

ALL = TABLES | BOOKS


def _groups(pattern: str, text: str) -> list[tuple[str, ...]]:
    return [match.groups() for match in re.finditer(pattern, text)]


def _key(text: str, kind: DataType) -> object:
    if isinstance(kind, DateType):
        return date.fromisoformat(text)
    return int(text) if isinstance(kind, IntegralType) else unquote(text)


def _literal(value: object) -> str:
    if isinstance(value, date):
        return f"DATE'{value}'"
    return str(value) if isinstance(value, int) else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


class TableStore:
    """Reads and replaces the tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, scope: Column | None = None, days: Iterable[date] | None = None) -> DataFrame:
        """A table, or the partitions of it that ``scope`` selects.

        With ``days``, to which ``scope`` must be confined, only the folders of these are listed, however
        many days the table has.
        """
        reader, schema = self.spark.read, ALL[name].schema
        if days is None:
            table = reader.schema(schema).parquet(self.path(name))
        else:
            folders = self._folders(name, days)
            reader = reader.schema(schema).option("basePath", self.path(name))
            table = reader.parquet(*folders) if folders else self._empty(schema)
        return table if scope is None else table.where(scope)

    def create(self, name: str) -> None:
        """An empty table, if there is none yet."""
        table = ALL[name]
        empty = self._empty(table.schema)
        empty.write.mode("ignore").partitionBy(*table.keys).parquet(self.path(name))

    def partitions(self, name: str, scope: Column | None = None, days: Iterable[date] | None = None) -> set[tuple]:
        """Keys in ``scope`` that have rows now, told by the names of the folders, without a job."""
        found = self._listed(name, days)
        if scope is None or not found:
            return found
        # a list of values is filtered by the optimizer, on the driver
        rows = ", ".join(f"({', '.join(map(_literal, key))})" for key in sorted(found))
        values = self.spark.sql(f"SELECT * FROM VALUES {rows} AS keys({', '.join(ALL[name].keys)})")
        return {tuple(row) for row in values.where(scope).collect()}

    def replace(
        self,
        name: str,
        df: DataFrame,
        scope: Column,
        gather: bool = True,
        order: list[str] | None = None,
        days: Iterable[date] | None = None,
    ) -> set[tuple]:
        """Replaces all partitions in ``scope`` by ``df`` and returns the keys written.

        Partitions with rows are overwritten dynamically; the folders of those left without rows are
        then removed through the file system, without a job. Doing the same again changes nothing, so
        a run that was cut short is simply run again.

        ``gather`` brings each partition's rows into few tasks of about the advisory size, so
        into few files; Spark splits a day that is too large for one task. ``order`` sorts what a
        task then writes. ``days`` are those of ``scope``, as in ``read``.
        """
        self.create(name)
        before = self.partitions(name, scope, days)
        written = self.write(name, df, gather, order)
        for key in sorted(before - written):
            self.drop(name, key)
        return written

    def write(
        self, name: str, df: DataFrame, gather: bool = True, order: list[str] | None = None, seen: dict[str, Column] | None = None
    ) -> set[tuple]:
        """Overwrites the partitions of which ``df`` has rows and returns their keys.

        ``seen`` has aggregates of the rows by name; their values take their place. It may name columns that the
        table lacks. Rows whose keys are NULL are seen but not written.
        """
        table = ALL[name]
        rows = df if seen else df.select(*table.schema.fieldNames())
        if gather:
            rows = rows.hint("rebalance", *table.keys)
        if order:
            rows = rows.sortWithinPartitions(*order)
        # observed above all exchanges: what lies below an empty one is dropped from the plan, metrics and all
        found, values = Observation(), seen or {}
        rows = rows.observe(found, F.collect_set(F.struct(*table.keys)).alias("keys"), *(v.alias(k) for k, v in values.items()))
        if seen:
            rows = rows.dropna(subset=table.keys).select(*table.schema.fieldNames())
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*table.keys)
            .parquet(self.path(name))
        )
        values.update({name: found.get[name] for name in values})
        return {tuple(key) for key in found.get["keys"] if None not in tuple(key) or not seen}

    def drop(self, name: str, key: tuple) -> None:
        """Removes a partition, through the file system and without a job."""
        folder = "/".join(f"{column}={value}" for column, value in zip(ALL[name].keys, key))
        files, path = self._located(f"{self.path(name)}/{folder}")
        files.delete(path, True)

    def _folders(self, name: str, days: Iterable[date]) -> list[str]:
        """The folders of those days that the table has."""
        folders = [f"{self.path(name)}/create_date={day}" for day in sorted(set(days))]
        return [folder for folder in folders if (at := self._located(folder))[0].exists(at[1])]

    def _listed(self, name: str, days: Iterable[date] | None) -> set[tuple]:
        """Keys of the partitions that have a folder, those of ``days`` only if given."""
        columns = [ALL[name].schema[key] for key in ALL[name].keys]
        parts = [f"{column.name}=*" for column in columns]
        if days is not None:
            parts[0] = f"create_date={{{','.join(sorted(map(str, set(days))))}}}"
            if parts[0].endswith("{}"):
                return set()
        files, root = self._located(self.path(name))
        plain = re.sub(r"([\\\[\]{}*?])", r"\\\1", root.toString())
        jvm = self.spark._jvm
        found = jvm.org.apache.spark.deploy.SparkHadoopUtil.get().globPath(files, jvm.org.apache.hadoop.fs.Path("/".join([plain, *parts])))
        names = found.mkString("\n")  # one call for all of them
        pattern = "(?m)/" + "/".join(f"{column.name}=([^/\n]*)" for column in columns) + "$"
        return {tuple(_key(text, column.dataType) for text, column in zip(key, columns)) for key in _groups(pattern, names)}

    def exists(self, name: str) -> bool:
        files, path = self._located(self.path(name))
        return files.exists(path)

    def _located(self, folder: str) -> tuple:
        """The file system of a folder and its path there."""
        jvm, session = self.spark._jvm, self.spark._jsparkSession
        path = jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(session.sessionState().newHadoopConf()), path

    def _empty(self, schema: StructType) -> DataFrame:
        columns = [F.lit(None).cast(column.dataType).alias(column.name) for column in schema]
        return self.spark.range(0).where(F.lit(False)).select(*columns)
