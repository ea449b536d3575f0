"""Backfill and incremental job: same tables, whatever arrives and in whatever order."""

import json
import os
from datetime import date

import pytest

from repotide.functions.calendar import hours_scope
from repotide.plans.backfill import backfill
from repotide.plans.refresh import Settings, refresh_files
from repotide.schemas import TABLES
from repotide.sources.tables import TableStore
from repotide.streaming.event_time import run_event_time_counts
from repotide.streaming.ingest import ingest_available
from repotide.sources.landing import canonical_events, hour_files, read_events, stream_events

from . import archive

FIRST, LAST = date(2019, 6, 1), date(2019, 6, 30)
HOURS = list(archive.COUNTS)
SETTINGS = Settings(hourly_details=True)


def contents(store):
    rows = {}
    for name, table in TABLES.items():
        columns = table.schema.fieldNames()
        rows[name] = sorted((repr(tuple(row)) for row in store.read(name).select(*columns).collect()))
    return rows


@pytest.fixture(scope="module")
def expected(spark, tmp_path_factory):
    landing = tmp_path_factory.mktemp("landing")
    archive.put_all(landing)
    store = backfill(spark, str(landing), str(tmp_path_factory.mktemp("tables")), FIRST, LAST, SETTINGS)
    tables = contents(store)
    assert tables["repo_scores"] and tables["repo_details"]
    # the same once more changes nothing
    assert contents(backfill(spark, str(landing), store.root, FIRST, LAST, SETTINGS)) == tables
    return tables


@pytest.mark.parametrize("how", [{"compressed": True}, {"flat": True}, {"flat": True, "compressed": True}])
def test_layouts(spark, tmp_path, expected, how):
    archive.put_all(tmp_path / "landing", **how)
    store = backfill(spark, str(tmp_path / "landing"), str(tmp_path / "t"), FIRST, LAST, SETTINGS)
    assert contents(store) == expected


def test_hour_as_folder_of_parts(spark, tmp_path, expected):
    for day, hour in HOURS:
        rows = archive.lines((day, hour))
        folder = tmp_path / "landing" / f"{day}-{hour}.json"
        archive.put(folder, day, hour, rows[::2], flat=True, name="part-0.txt")
        archive.put(folder, day, hour, rows[1::2], flat=True, name="part-1.txt.gz", compressed=True)
    store = backfill(spark, str(tmp_path / "landing"), str(tmp_path / "t"), FIRST, LAST, SETTINGS)
    assert contents(store) == expected


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 0, 2)])
def test_incremental_equals_backfill(spark, tmp_path, expected, order):
    landing, out, state = (str(tmp_path / n) for n in ("landing", "tables", "state"))
    for n in order:
        archive.put_hour(landing, HOURS[n])
        ingest_available(spark, landing, out, state, SETTINGS)
    assert contents(TableStore(spark, out)) == expected
    # nothing new: nothing happens
    ingest_available(spark, landing, out, state, SETTINGS)
    assert contents(TableStore(spark, out)) == expected


def test_incremental_after_backfill_one_file_per_batch(spark, tmp_path, expected):
    landing, out, state = (str(tmp_path / n) for n in ("landing", "tables", "state"))
    archive.put_hour(landing, HOURS[0])
    backfill(spark, landing, out, FIRST, LAST, SETTINGS)
    for hour in HOURS[1:]:
        archive.put_hour(landing, hour)
    ingest_available(spark, landing, out, state, SETTINGS, max_files=1)
    assert contents(TableStore(spark, out)) == expected


def test_late_file_with_an_old_date_is_not_skipped(spark, tmp_path, expected):
    landing, out, state = (str(tmp_path / n) for n in ("landing", "tables", "state"))
    archive.put_hour(landing, HOURS[1])
    archive.put_hour(landing, HOURS[2])
    ingest_available(spark, landing, out, state, SETTINGS)
    late = archive.put_hour(landing, HOURS[0])
    os.utime(late, (1.5e9, 1.5e9))
    ingest_available(spark, landing, out, state, SETTINGS)
    assert contents(TableStore(spark, out)) == expected


def test_hour_delivered_twice_counts_once(spark, tmp_path, expected):
    """The newest delivery of an hour replaces the older one, in the job and in a backfill."""
    landing, out, state = (str(tmp_path / n) for n in ("landing", "tables", "state"))
    first = archive.put(landing, *HOURS[0], archive.lines(HOURS[0])[:20])
    os.utime(first, (1.5e9, 1.5e9))
    archive.put_hour(landing, HOURS[1])
    archive.put_hour(landing, HOURS[2])
    ingest_available(spark, landing, out, state, SETTINGS)
    assert contents(TableStore(spark, out)) != expected
    archive.put_hour(landing, HOURS[0], compressed=True)
    ingest_available(spark, landing, out, state, SETTINGS)
    assert contents(TableStore(spark, out)) == expected
    again = backfill(spark, landing, str(tmp_path / "t2"), FIRST, LAST, SETTINGS)
    assert contents(again) == expected


def test_emptied_hours_leave_no_rows_behind(spark, tmp_path):
    """An hour comes again with fewer events, then as an empty file."""
    landing, out, state = (str(tmp_path / n) for n in ("landing", "tables", "state"))
    day, hour = HOURS[2]
    old = archive.put_hour(landing, HOURS[2])
    os.utime(old, (1.5e9, 1.5e9))
    ingest_available(spark, landing, out, state, SETTINGS)
    store = TableStore(spark, out)
    assert store.read("repo_scores").count() == 1
    fewer = archive.put(landing, day, hour, archive.lines(HOURS[2])[:5], compressed=True)
    os.utime(fewer, (1.6e9, 1.6e9))
    ingest_available(spark, landing, out, state, SETTINGS)
    counts = {name: store.read(name).count() for name in TABLES}
    assert counts.pop("events") == 5
    assert set(counts.values()) == {0}
    archive.put(landing, day, hour, [], flat=True)
    ingest_available(spark, landing, out, state, SETTINGS)
    assert store.read("events").count() == 5  # a file of zero bytes is no delivery
    archive.put(landing, day, hour, [], flat=True, compressed=True)
    ingest_available(spark, landing, out, state, SETTINGS)
    assert store.read("events").count() == 0


def test_backfill_by_created_at_ignores_names(spark, tmp_path, expected):
    rows = [row for hour in HOURS for row in archive.lines(hour)]
    archive.put(tmp_path / "landing", "", 0, rows, flat=True, name="dump.json")
    out = str(tmp_path / "t")
    store = backfill(spark, str(tmp_path / "landing"), out, FIRST, LAST, SETTINGS, hour_from="created_at")
    assert contents(store) == expected
    # a smaller dump replaces the span as a whole
    archive.put(tmp_path / "landing2", "", 0, archive.lines(HOURS[2]), flat=True, name="dump.json")
    store = backfill(spark, str(tmp_path / "landing2"), out, FIRST, LAST, SETTINGS, hour_from="created_at")
    assert [r.create_date for r in store.read("daily_events").collect()] == [date(2019, 6, 28)]
    assert store.read("repo_details").count() == 0


def test_hours_at_any_depth(spark, tmp_path, expected):
    landing = tmp_path / "landing"
    for hour, folder in zip(HOURS, ("", "2019/06", "a/b/c"), strict=True):
        archive.put_hour(landing / folder, hour)
    assert contents(backfill(spark, str(landing), str(tmp_path / "t"), FIRST, LAST, SETTINGS)) == expected
    ingest_available(spark, str(landing), str(tmp_path / "t2"), str(tmp_path / "s"), SETTINGS)
    assert contents(TableStore(spark, str(tmp_path / "t2"))) == expected


def test_part_files_in_folders_of_an_hour(spark, tmp_path, expected):
    for day, hour in HOURS:
        rows = archive.lines((day, hour))
        folder = tmp_path / "landing" / f"{day}-{hour}.json"
        archive.put(folder, day, hour, rows[::2], flat=True, name="part-0.txt")
        archive.put(folder / "more" / "still", day, hour, rows[1::2], flat=True, name="part-1.txt")
    assert contents(backfill(spark, str(tmp_path / "landing"), str(tmp_path / "t"), FIRST, LAST, SETTINGS)) == expected
    assert not list((tmp_path / "t").glob("**/*HIVE_DEFAULT*"))


def test_files_without_an_hour_are_an_error(spark, tmp_path):
    archive.put(tmp_path, "", 0, archive.lines(HOURS[2]), flat=True, name="dump.json")
    with pytest.raises(Exception, match="the name gives no hour"):
        canonical_events(read_events(spark, str(tmp_path))).collect()


def test_event_time_stream_takes_files_of_any_age(spark, tmp_path):
    landing, out, state = (str(tmp_path / n) for n in ("landing", "out", "state"))
    archive.put_hour(landing, HOURS[0])
    run_event_time_counts(stream_events(spark, landing), out, state)
    late = archive.put_hour(landing, HOURS[2])
    os.utime(late, (1.5e9, 1.5e9))
    run_event_time_counts(stream_events(spark, landing), out, state)
    read = spark.read.json(f"{state}/offsets/*").count()
    assert read and len(list((tmp_path / "state" / "sources" / "0").glob("[0-9]*"))) == 2


def test_backfill_of_an_empty_month_and_without_landing(spark, tmp_path):
    archive.put_all(tmp_path / "landing")
    store = backfill(spark, str(tmp_path / "landing"), str(tmp_path / "t"), date(2018, 1, 1), date(2018, 1, 31))
    assert not (tmp_path / "t").exists() and store.root == str(tmp_path / "t")
    with pytest.raises(ValueError):
        backfill(spark, "", str(tmp_path / "t"), FIRST, LAST)


def test_event_time_counts_take_late_rows_up_to_the_bound(spark, tmp_path):
    landing, out, state = (str(tmp_path / n) for n in ("landing", "counts", "state"))

    def deliver(name, *hours):
        rows = [archive.event(n, "2019-06-27", h, archive.PUSH, "a/x", "u1") for n, h in enumerate(hours)]
        archive.put(landing, "", 0, [json.dumps(r) for r in rows], flat=True, name=name)
        run_event_time_counts(stream_events(spark, landing), out, state)

    deliver("1.json", 1, 1, 3)
    deliver("2.json", 1, 5, 5)  # the 1 is late but within two hours of 3: its hour is still open
    deliver("3.json", 1, 9)  # hour 1 was closed when 5 had been seen
    deliver("4.json", 20)
    rows = spark.read.schema("hour int, event string, repo_name string, count bigint, create_date date").parquet(out)
    assert sorted((r.hour, r["count"]) for r in rows.collect()) == [(1, 3), (3, 1), (5, 2), (9, 1)]


def test_one_hour_touches_its_own_partitions(spark, tmp_path, expected):
    archive.put_all(tmp_path / "landing")
    store = backfill(spark, str(tmp_path / "landing"), str(tmp_path / "t"), FIRST, LAST, SETTINGS)

    def files(name):
        return {str(p.relative_to(tmp_path)) for p in (tmp_path / "t" / name).rglob("part-*")}

    hourly = ("events", "hourly_events", "hourly_users", "hourly_repo_details")
    before = {name: files(name) for name in hourly}
    present = hour_files(spark, str(tmp_path / "landing"), FIRST, LAST)
    day, hour = max(present)
    refresh_files(store, {(day, hour): present[day, hour]}, SETTINGS)
    for name in hourly:
        changed = before[name] ^ files(name)
        assert all(f"create_date={day}/hour={hour}/" in path for path in changed), name
    assert files("events") != before["events"]
    assert contents(store) == expected
    only = store.read("events", hours_scope({(day, hour)}), {day})
    assert only.count() > 0
    assert all(f"create_date={day}/" in path for path in only.inputFiles())
    assert store.read("events", days={date(2031, 1, 1)}).count() == 0
