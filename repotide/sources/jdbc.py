"""Export to, and scans of, tables in a database."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.schemas import COUNTED_EVENTS
from repotide.sources.tables import TableStore

# Names and column order of the tables that database readers expect.
EXPORTED_EVENT_TABLES = {event: f"{event}_table" for event in COUNTED_EVENTS}
EXPORTED_TABLES = {
    "repo_users": ("repo_users", ["repo_name", "user_name", "count", "create_date"]),
    "repo_scores": ("AggregateEvent_table", ["repo_name", "score", "create_date"]),
    "repo_details": (
        "repo_details",
        [
            "repo_name",
            "score",
            "create_date",
            "forks",
            "has_wiki",
            "languages",
            "open_issues_count",
            "stars_count",
            "watchers",
        ],
    ),
}


def export_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    properties: Mapping[str, str] | None = None,
    connections: int = 8,
) -> None:
    """Writes a frame to a database table over at most ``connections`` connections."""
    df.write.option("numPartitions", connections).jdbc(url, table, mode, dict(properties or {}))


class JdbcTarget:
    """A database whose tables take whole days at a time.

    Rows are written by Spark's parallel JDBC writer into a staging table beside the real one. Then one
    transaction deletes the days and inserts what was staged, so readers see a day before or after, never
    half of it or twice, and doing it again changes nothing. One job at a time may write a table.
    """

    def __init__(self, url: str, properties: Mapping[str, str] | None = None, connections: int = 8):
        self.url, self.properties, self.connections = url, dict(properties or {}), connections

    def replace_days(self, rows: DataFrame, table: str, days: Collection[date]) -> None:
        """``rows``, all of ``days``, take the place of what ``table`` has of these days."""
        staging = f"{table}_staging"
        export_jdbc(rows.limit(0), self.url, table, "append", self.properties, 1)  # makes the table, if there is none
        writer = rows.write.option("truncate", True).option("numPartitions", self.connections)
        writer.jdbc(self.url, staging, "overwrite", self.properties)
        quote = self._dialect(rows.sparkSession).quoteIdentifier
        columns = ", ".join(quote(c) for c in rows.columns)
        statements = [(f"DELETE FROM {table} WHERE {quote('create_date')} = ?", day) for day in sorted(days)]
        self.in_transaction(rows.sparkSession, [*statements, (f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging}", None)])

    def in_transaction(self, spark: SparkSession, statements: list[tuple[str, date | None]]) -> None:
        """Runs statements, each with its day if it has one, all or none."""
        connection = self.connect(spark)
        try:
            connection.setAutoCommit(False)
            for text, day in statements:
                statement = connection.prepareStatement(text)
                if day is not None:
                    statement.setDate(1, spark._jvm.java.sql.Date.valueOf(day.isoformat()))
                statement.executeUpdate()
                statement.close()
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()

    def connect(self, spark: SparkSession):
        """A connection as Spark's own writer makes it: same driver, login and dialect."""
        jvm = spark._jvm
        properties = jvm.PythonUtils.toScalaMap(self.properties)
        options = jvm.org.apache.spark.sql.execution.datasources.jdbc.JDBCOptions(self.url, "exports", properties)
        return self._dialect(spark).createConnectionFactory(options).apply(-1)

    def _dialect(self, spark: SparkSession):
        return spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url)


def exported_frames(store: TableStore, scope: Column | None = None) -> dict[str, DataFrame]:
    """The daily tables, or the days in ``scope``, by their names in the database."""
    daily = store.read("daily_events", scope).select("event", "repo_name", "count", "create_date")
    frames = {name: daily.where(F.col("event") == event) for event, name in EXPORTED_EVENT_TABLES.items()}
    return frames | {name: store.read(table, scope).select(*columns) for table, (name, columns) in EXPORTED_TABLES.items()}


def export_tables(
    store: TableStore,
    url: str,
    scope: Column | None = None,
    mode: str = "append",
    properties: Mapping[str, str] | None = None,
    connections: int = 8,
) -> None:
    """Writes the daily tables, or the days in ``scope``, to a new database, whatever it has of them.

    ``plans.export`` keeps an existing one up to date.
    """
    for name, df in exported_frames(store, scope).items():
        export_jdbc(df, url, name, mode, properties, connections)


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None, **partitioning
) -> DataFrame:
    """Scans a database table; filters, limits and aggregates are pushed down by Spark.

    ``partitioning`` takes ``column``, ``lowerBound``, ``upperBound`` and ``numPartitions``
    for a parallel scan.
    """
    return spark.read.jdbc(url, table, properties=dict(properties or {}), **partitioning)
