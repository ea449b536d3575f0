"""Export of changed days. The database is a dict of days, or what Spark's JDBC writer is given; none is run."""

import os
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from repotide.plans.backfill import backfill
from repotide.plans.export import compact_book, day_digests, export_changes, exported_days, mark_exported, pending_days
from repotide.sources.jdbc import JdbcTarget, exported_frames
from repotide.sources.tables import TableStore
from repotide.streaming.ingest import ingest_available

from . import archive

FIRST, LAST = date(2019, 6, 1), date(2019, 6, 30)
HOURS = list(archive.COUNTS)
DAY, NEXT = date(2019, 6, 27), date(2019, 6, 28)


class Days:
    """Tables as {table: {day: rows}}, and the calls that made them so."""

    def __init__(self, fails=()):
        self.tables, self.calls, self.fails = {}, [], set(fails)

    def replace_days(self, rows, table, days):
        self.calls.append((table, tuple(days)))
        found = [tuple(r) for r in rows.collect()]
        at = rows.columns.index("create_date")
        of = self.tables.setdefault(table, {})
        for day in days:
            of[day] = sorted((r for r in found if r[at] == day), key=repr)
        if table in self.fails:
            raise ConnectionError("lost after the commit")


def stored(store):
    out = {}
    for name, rows in exported_frames(store).items():
        at = rows.columns.index("create_date")
        for row in rows.collect():
            out.setdefault(name, {}).setdefault(row[at], []).append(tuple(row))
    return {name: {day: sorted(rows, key=repr) for day, rows in days.items()} for name, days in out.items()}


def sent(target):
    return {name: {day: rows for day, rows in days.items() if rows} for name, days in target.tables.items() if any(days.values())}


@pytest.fixture
def site(spark, tmp_path):
    """A landing folder and tables without the last hour of the first day."""
    landing, out, state = (str(tmp_path / n) for n in ("landing", "tables", "state"))
    for hour in (HOURS[0], HOURS[2]):
        archive.put_hour(landing, hour)
    ingest_available(spark, landing, out, state)
    return landing, state, TableStore(spark, out)


def test_a_late_hour_sends_its_day_again(spark, site):
    landing, state, store = site
    target = Days()
    export_changes(store, target)
    assert sent(target) == stored(store)
    push = target.tables["PushEvent_table"][DAY]
    target.calls.clear()
    assert export_changes(store, target) == [] and target.calls == []  # an unchanged day is not sent
    archive.put_hour(landing, HOURS[1])
    ingest_available(spark, landing, store.root, state)
    changed = export_changes(store, target)
    assert {day for _, day in changed} == {DAY} and ("PushEvent_table", DAY) in changed
    assert target.tables["PushEvent_table"][DAY] != push
    assert sent(target) == stored(store)
    assert export_changes(store, target) == []


def test_the_same_rows_written_again_are_not_sent(spark, site):
    landing, _, store = site
    export_changes(store, Days())
    backfill(spark, landing, store.root, FIRST, LAST)
    assert export_changes(store, Days()) == []


@pytest.mark.parametrize("table", ["AggregateEvent_table", "PushEvent_table", "repo_users"])
def test_a_crash_between_database_and_book_doubles_nothing(spark, site, table):
    _, _, store = site
    target = Days(fails=[table])
    with pytest.raises(ConnectionError):
        export_changes(store, target)
    target.fails.clear()
    again = export_changes(store, target)
    assert (table, DAY) in again  # its entry is missing, so it goes out again and replaces itself
    assert sent(target) == stored(store)


def test_a_day_left_without_rows_is_emptied(spark, site):
    landing, state, store = site
    target = Days()
    export_changes(store, target)
    fewer = archive.put(landing, *HOURS[2], [archive.lines(HOURS[2])[0]], compressed=True)
    os.utime(fewer, (2e9, 2e9))
    ingest_available(spark, landing, store.root, state)
    assert {("PushEvent_table", NEXT, 0)} <= {tuple(r)[:3] for r in pending_days(store).collect()}
    export_changes(store, target)
    assert target.tables["PushEvent_table"][NEXT] == [] and sent(target) == stored(store)
    assert export_changes(store, target) == []


def test_days_may_be_confined_or_all_sent(spark, site):
    _, _, store = site
    later = F.col("create_date") >= NEXT
    target = Days()
    assert {day for _, day in export_changes(store, target, later)} == {NEXT}
    assert {day for _, day in export_changes(store, target)} == {DAY}
    assert {day for _, day in export_changes(store, target, later, all_days=True)} == {NEXT}
    assert sent(target) == stored(store)


def test_a_long_span_goes_month_by_month(spark, site):
    _, _, store = site
    newer = store.read("daily_events").withColumn("create_date", F.lit("2019-08-01").cast("date"))
    store.replace("daily_events", newer, F.col("create_date") == "2019-08-01")
    target = Days()
    export_changes(store, target)
    assert ("PushEvent_table", (DAY, NEXT)) in target.calls and ("PushEvent_table", (date(2019, 8, 1),)) in target.calls


def test_the_book_becomes_one_entry(spark, site):
    _, _, store = site
    export_changes(store, Days())
    before = sorted(map(tuple, exported_days(store).collect()))
    assert len(store.partitions("exports", F.lit(True))) > 1
    compact_book(store, 1)
    assert len(store.partitions("exports", F.lit(True))) == 1
    assert sorted(map(tuple, exported_days(store).collect())) == before
    assert export_changes(store, Days()) == []


def test_digests_tell_rows_apart(spark):
    def digest(*rows):
        frame = spark.createDataFrame([(DAY, *r) for r in rows], "create_date date, a string, b double, c array<string>")
        return day_digests(frame.repartition(3)).first()

    one, two = ("x", 0.1 + 0.2, ["p"]), ("y", None, None)
    assert digest(one, two) == digest(two, one) == digest(("x", 0.3, ["p"]), two)
    others = [digest(*rows) for rows in ([one], [one, one], [one, two, two], [one, two], [("x", 0.3, []), two], [(None, 0.3, ["p"]), two])]
    assert len({r["digest"] for r in others}) == len(others)


def test_one_transaction_replaces_days(spark, monkeypatch):
    written, statements = [], []

    def jdbc(writer, url, table, mode=None, properties=None):
        written.append((url, table, mode, properties, writer._df.count()))

    class Connection:
        def __init__(self, bad):
            self.bad = bad

        def setAutoCommit(self, on):
            statements.append(("auto", on))

        def prepareStatement(self, text):
            return Statement(text, self.bad)

        def __getattr__(self, name):
            return lambda: statements.append(name)

    class Statement:
        def __init__(self, text, bad):
            self.text, self.bad, self.day = text, bad, None

        def setDate(self, _, day):
            self.day = day.toString()

        def executeUpdate(self):
            statements.append((self.text, self.day))
            if self.bad and self.text.startswith("INSERT"):
                raise RuntimeError("full")

        def close(self):
            pass

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    rows = spark.createDataFrame([("a", 1, DAY), ("b", 2, NEXT)], "repo_name string, count long, create_date date")
    target = JdbcTarget("jdbc:postgresql://host/db", {"user": "me"})
    monkeypatch.setattr(target, "connect", lambda _: Connection(False))
    target.replace_days(rows, "t", [NEXT, DAY])
    url, login = "jdbc:postgresql://host/db", {"user": "me"}
    assert written == [(url, "t", "append", login, 0), (url, "t_staging", "overwrite", login, 2)]
    delete = 'DELETE FROM t WHERE "create_date" = ?'
    columns = '"repo_name", "count", "create_date"'
    insert = (f"INSERT INTO t ({columns}) SELECT {columns} FROM t_staging", None)
    assert statements == [("auto", False), (delete, str(DAY)), (delete, str(NEXT)), insert, "commit", "close"]
    statements.clear()
    monkeypatch.setattr(target, "connect", lambda _: Connection(True))
    with pytest.raises(RuntimeError):
        target.replace_days(rows, "t", [DAY])
    assert statements[-2:] == ["rollback", "close"] and "commit" not in statements


def test_connections_are_made_by_spark(spark):
    """As far as it goes without a database: Spark finds no driver for the address."""
    with pytest.raises((PySparkException, Exception), match="No suitable driver"):
        JdbcTarget("jdbc:nothing:at-all", {"user": "me"}).connect(spark)
