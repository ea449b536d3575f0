"""The book of deliveries, details that follow the list, and backfills that go on where they stopped."""

import os
import random
import re
from datetime import date

import pytest

from repotide.plans import backfill as backfill_module
from repotide.plans import refresh
from repotide.plans.backfill import backfill, backfill_month
from repotide.plans.refresh import Settings, details_of_days, refresh_files
from repotide.sources import arrivals
from repotide.sources.arrivals import EMPTY, OLDER, known_files, note_files, passed_over
from repotide.sources.landing import hour_files, list_files
from repotide.sources.tables import TableStore
from repotide.streaming import ingest
from repotide.streaming.ingest import ingest_available

from . import archive

FIRST, LAST = date(2019, 6, 1), date(2019, 6, 30)
DAY = date(2019, 6, 27)
HOURS = list(archive.COUNTS)


@pytest.fixture
def places(tmp_path):
    return tuple(str(tmp_path / name) for name in ("landing", "tables", "state"))


def test_a_batch_lists_nothing(spark, places, monkeypatch):
    landing, out, state = places

    def listed(*_):
        raise AssertionError("listed")

    monkeypatch.setattr(ingest, "list_files", listed)
    for hour in HOURS:
        archive.put_hour(landing, hour)
        ingest_available(spark, landing, out, state)
    assert {(r.create_date.isoformat(), r.hour) for r in known_files(TableStore(spark, out)).collect()} == set(HOURS)


def test_a_job_from_before_the_book_lists_once(spark, places, monkeypatch):
    landing, out, state = places
    old = archive.put_hour(landing, HOURS[0])
    os.utime(old, (2e9, 2e9))
    with monkeypatch.context() as before:
        before.setattr(ingest, "note_files", lambda store, files, source: {(r.create_date, r.hour) for r in files.collect()})
        before.setattr(ingest, "chosen_files", lambda store, hours: hour_files(spark, landing, FIRST, LAST))
        ingest_available(spark, landing, out, state)
    assert not TableStore(spark, out).exists("deliveries")
    archive.put(landing, *HOURS[0], [archive.lines(HOURS[0])[0]], flat=True)  # older than the one there
    ingest_available(spark, landing, out, state)
    store = TableStore(spark, out)
    assert store.read("events").count() > 10
    assert [r.reason for r in passed_over(store).collect()] == [OLDER]


def report(store):
    return sorted((r.create_date.isoformat(), r.hour, os.path.basename(r.delivery), r.files, r.reason) for r in passed_over(store).collect())


@pytest.mark.parametrize("job", ["backfill", "ingest"])
def test_what_is_passed_over_is_reported(spark, places, job):
    landing, out, state = places
    day, hour = HOURS[0]
    older = archive.put_hour(landing, HOURS[0])
    os.utime(older, (1.5e9, 1.5e9))
    archive.put_hour(landing, HOURS[0], flat=True, compressed=True)
    parts = f"{landing}/more/{HOURS[1][0]}-{HOURS[1][1]}.json"
    for n in range(3):
        path = archive.put(parts, *HOURS[1], archive.lines(HOURS[1])[n::3], flat=True, name=f"part-{n}")
        os.utime(path, (1.5e9 + n, 1.5e9 + n))
    archive.put_hour(landing, HOURS[1])
    expected = [(day, hour, older.name, 1, OLDER), (*HOURS[1], os.path.basename(parts), 3, OLDER)]
    if job == "backfill":
        archive.put(landing, *HOURS[2], [], flat=True)
        archive.put_hour(landing, HOURS[2])
        archive.put(landing, "2019-06-29", 4, [])
        expected += [(*HOURS[2], "2019-06-28-5.json", 1, EMPTY), ("2019-06-29", 4, "2019-06-29-4.json", 1, EMPTY)]
        store = backfill(spark, landing, out, FIRST, LAST)
    else:
        ingest_available(spark, landing, out, state)
        store = TableStore(spark, out)
    assert report(store) == sorted(expected)


def test_a_source_is_entered_once(spark, places):
    landing, out, _ = places
    archive.put_all(landing)
    store = TableStore(spark, out)
    for source in ("a", "a", "b"):
        hours = note_files(store, list_files(spark, landing, FIRST, LAST), source)
    assert {(d.isoformat(), h) for d, h in hours} == set(HOURS)
    assert store.read("deliveries").count() == 6 and known_files(store).count() == 3
    assert arrivals.chosen_files(store, hours) == hour_files(spark, landing, FIRST, LAST)
    assert arrivals.chosen_files(store, set()) == {}


# details


def busy(rng, hour, repos):
    """An hour in which repositories have pushes and pull requests of their own number."""
    rows, n = [], 0
    for repo in repos:
        for _ in range(rng.randrange(0, 7)):
            n += 1
            rows.append(archive.json.dumps(archive.event(1000 * hour + n, "2019-06-27", hour, archive.PUSH, repo, "u1")))
        for language in rng.sample(["Go", "Python", "Scala", None], rng.randrange(0, 3)):
            n += 1
            rows.append(archive.json.dumps(archive.pull(1000 * hour + n, "2019-06-27", hour, repo, language)))
    return rows


FEW = Settings(minimums={archive.PUSH: 1}, user_minimum=0, top=3)


def rows_of(store, name="repo_details"):
    columns = sorted(store.read(name).columns)
    return sorted(repr(tuple(r)) for r in store.read(name).selectExpr(*(f"round({c}, 9)" if c == "score" else c for c in columns)).collect())


def test_details_follow_a_changing_list(spark, places, tmp_path):
    """After each hour, in any order and with hours coming again, they are those of a backfill."""
    landing, out, state = places
    rng = random.Random(5)
    repos = [f"r/{k}" for k in range(8)]
    kept, entered = 0, 0
    for n, hour in enumerate((5, 2, 9, 2, 23, 0)):
        path = archive.put(f"{landing}/{n}", "2019-06-27", hour, busy(rng, hour, repos))
        os.utime(path, (1.9e9 + n, 1.9e9 + n))
        before = {r.id for r in TableStore(spark, out).read("repo_details").collect()} if n else set()
        ingest_available(spark, landing, out, state, FEW)
        store = TableStore(spark, out)
        assert rows_of(store) == rows_of(backfill(spark, landing, str(tmp_path / f"whole{n}"), FIRST, LAST, FEW)), hour
        after = store.read("repo_details").collect()
        kept += sum(r.id in before for r in after)
        entered += sum(r.id not in before and r.hour != hour for r in after)
    assert kept and entered


def test_other_languages_are_looked_up_anew(spark, places, tmp_path):
    landing, out, state = places
    rng = random.Random(8)
    repos = [f"r/{k}" for k in range(3)]
    every = Settings(minimums={archive.PUSH: 1}, user_minimum=0, top=3, require_language=False)
    for hour, settings in ((1, FEW), (2, every)):
        archive.put(landing, "2019-06-27", hour, busy(rng, hour, repos))
        ingest_available(spark, landing, out, state, settings)
    assert rows_of(TableStore(spark, out)) == rows_of(backfill(spark, landing, str(tmp_path / "whole"), FIRST, LAST, every))


def test_a_run_cut_short_before_the_note(spark, places, tmp_path, monkeypatch):
    landing, out, state = places
    rng = random.Random(3)
    repos = [f"r/{k}" for k in range(6)]
    archive.put(landing, "2019-06-27", 1, busy(rng, 1, repos))
    ingest_available(spark, landing, out, state, FEW)
    archive.put(landing, "2019-06-27", 2, busy(rng, 2, repos))
    replace = TableStore.replace

    def fails(self, name, *args, **more):
        if name == "detail_lookups":
            raise OSError("gone")
        return replace(self, name, *args, **more)

    monkeypatch.setattr(TableStore, "replace", fails)
    with pytest.raises(Exception, match="gone"):
        ingest_available(spark, landing, out, state, FEW)
    monkeypatch.setattr(TableStore, "replace", replace)
    ingest_available(spark, landing, out, state, FEW)
    assert rows_of(TableStore(spark, out)) == rows_of(backfill(spark, landing, str(tmp_path / "whole"), FIRST, LAST, FEW))


def test_one_hour_reads_one_hour_of_events(spark, places):
    """Of earlier hours only the repositories that have entered the list are read, and by name."""
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    landing, out, state = places

    def hour(number, *repos):
        rows = [archive.event(100 * number + n, "2019-06-27", number, archive.PUSH, r, "u") for n, r in enumerate(repos * 3)]
        rows += [archive.pull(100 * number + 50 + n, "2019-06-27", number, r, "Go") for n, r in enumerate((*repos, "r/late"))]
        archive.put(landing, "2019-06-27", number, [archive.json.dumps(r) for r in rows])

    hour(1, "r/a", "r/b")
    hour(2, "r/a", "r/b")
    ingest_available(spark, landing, out, state, FEW)
    store = TableStore(spark, out)

    def scans():
        plan = details_of_days(store, {(DAY, 3)}, FEW)._jdf.queryExecution().executedPlan().toString()
        return {line.split("PartitionFilters: ")[1] for line in plan.split("\n") if "FileScan" in line and "head_repo#" in line}

    def hours(scan):
        return {n for n in range(24) if re.search(rf"\(hour#\d+ = {n}\)|hour#\d+ IN \([\d,]*\b{n}\b", scan)}

    hour(3, "r/a")
    refresh_files(store, {(DAY, 3): hour_files(spark, landing, DAY, DAY)[DAY, 3]}, FEW)
    assert {frozenset(hours(scan)) for scan in scans()} == {frozenset({3})}
    # a repository without an entry in the note is looked up in the earlier hours, alone
    store.replace("detail_lookups", store.read("detail_lookups").where("repo_name <> 'r/b'"), refresh.days_scope({DAY}), days={DAY})
    assert {frozenset(hours(scan)) for scan in scans()} == {frozenset({3}), frozenset({1, 2})}
    earlier = [scan for scan in scans() if hours(scan) == {1, 2}]
    assert all("EqualTo(repo_name,r/b)" in scan and "EqualTo(event,PullRequestEvent)" in scan for scan in earlier)
    assert "r/late" not in {r.repo_name for r in store.read("repo_details").collect()}


# backfill of several months


def two_months(landing):
    archive.put_all(landing)
    rows = [line.replace("2019-06-28", "2019-07-02") for line in archive.lines(HOURS[2])]
    archive.put(landing, "2019-07-02", 5, rows)


def test_a_backfill_goes_on_where_it_stopped(spark, places, tmp_path, monkeypatch):
    landing, out, _ = places
    two_months(landing)
    read = []
    months = backfill_module.refresh_files

    def counted(store, files, settings, fail_at=None):
        month = {day.month for day, _ in files}
        if month == fail_at:
            raise OSError("cut short")
        read.append(month)
        months(store, files, settings)

    monkeypatch.setattr(backfill_module, "refresh_files", lambda *a: counted(*a, fail_at={7}))
    with pytest.raises(OSError):
        backfill_month(spark, landing, out, "2019", "06", through="2019-07")
    assert read == [{6}]
    monkeypatch.setattr(backfill_module, "refresh_files", counted)
    backfill_month(spark, landing, out, "2019", "06", through="2019-07", resume=True)
    assert read == [{6}, {7}]
    whole = backfill(spark, landing, str(tmp_path / "whole"), date(2019, 6, 1), date(2019, 7, 31))
    store = TableStore(spark, out)
    assert rows_of(store, "daily_events") == rows_of(whole, "daily_events")
    read.clear()
    backfill_month(spark, landing, out, "2019", "06", through="2019-07", resume=True)
    assert read == []
    # a file that has changed, other settings, or no resuming: read again
    later = archive.put(landing, "2019-07-02", 5, archive.lines(HOURS[2])[:1])
    os.utime(later, (2e9, 2e9))
    backfill_month(spark, landing, out, "2019", "06", through="2019-07", resume=True)
    assert read == [{7}]
    backfill_month(spark, landing, out, "2019", "06", FEW, through="2019-06", resume=True)
    backfill_month(spark, landing, out, "2019", "06", FEW)
    assert read == [{7}, {6}, {6}]


def test_partitions_are_told_by_their_names(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "odd name x=1"))
    assert store.partitions("events") == set() and store.partitions("events", None, []) == set()
    archive.put_all(tmp_path / "landing")
    backfill(spark, str(tmp_path / "landing"), store.root, FIRST, LAST)
    expected = {(date.fromisoformat(day), hour) for day, hour in HOURS}
    assert store.partitions("events") == expected
    assert store.partitions("events", None, [DAY, date(2031, 1, 1)]) == {k for k in expected if k[0] == DAY}
    assert store.partitions("events", refresh.hours_scope({(DAY, 23)}), [DAY]) == {(DAY, 23)}
    assert store.partitions("deliveries") == {(d, "listing") for d, _ in expected}
    assert store.partitions("finished_months") == {("2019-06",)}
