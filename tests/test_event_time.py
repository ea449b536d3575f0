"""Counts by event time that lose nothing, and lines that cannot be read."""

import itertools
import json
import os
from collections import Counter
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from repotide.plans.backfill import backfill
from repotide.plans.refresh import Settings
from repotide.sources.landing import broken_lines, read_events, stream_events
from repotide.sources.tables import TableStore
from repotide.streaming.event_time import corrections, late_rows, upsert_batch, upsert_event_time_counts
from repotide.streaming.ingest import ingest_available

from . import archive

FIRST, LAST = date(2019, 6, 1), date(2019, 6, 30)
HOURS = list(archive.COUNTS)


def deliver(landing, name, *hours, day="2019-06-27"):
    rows = [archive.event(n, day, h, archive.PUSH, f"a/{n % 2}", "u1") for n, h in enumerate(hours)]
    archive.put(landing, "", 0, [json.dumps(r) for r in rows], flat=True, name=name)


def counted(store):
    return {(r.hour, r.repo_name): r["count"] for r in store.read("event_time_counts").collect()}


DELIVERIES = [("1.json", (1, 1, 3)), ("2.json", (1, 5, 5)), ("3.json", (1, 9)), ("4.json", (20, 2))]


@pytest.mark.parametrize("order", [*itertools.permutations(range(4))][::5])
def test_any_order_gives_the_counts_of_one_delivery(spark, tmp_path, order):
    landing, out, state = (str(tmp_path / n) for n in ("landing", "out", "state"))
    for k in order:
        deliver(landing, DELIVERIES[k][0], *DELIVERIES[k][1])
        store = upsert_event_time_counts(stream_events(spark, landing), out, state)
    expected = Counter((h, f"a/{n % 2}") for _, hours in DELIVERIES for n, h in enumerate(hours))
    assert counted(store) == expected
    late, newest = Counter(), None
    for k in order:
        hours = DELIVERIES[k][1]
        late.update(h for h in hours if newest is not None and h + 1 + 2 <= newest)
        newest = max([*hours, *([newest] if newest is not None else [])])
    assert {r["hour"]: r["rows"] for r in late_rows(store).collect()} == dict(late)
    # nothing new: nothing happens
    assert counted(upsert_event_time_counts(stream_events(spark, landing), out, state)) == expected


def test_a_batch_done_again_changes_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "out"))
    frames = []
    for name, hours in DELIVERIES:
        deliver(tmp_path / name, name, *hours)
        frames.append(read_events(spark, str(tmp_path / name)))
    for number, frame in enumerate(frames):
        upsert_batch(frame, number, store, "q")
    expected, late = counted(store), sorted(map(tuple, corrections(store).collect()))
    assert late
    upsert_batch(frames[-1], len(frames) - 1, store, "q")
    assert counted(store) == expected and sorted(map(tuple, corrections(store).collect())) == late
    with pytest.raises(ValueError, match="another checkpoint"):
        upsert_batch(frames[0], 9, store, "other")


def test_a_batch_cut_short_is_made_good(spark, tmp_path, monkeypatch):
    """It fails after its counts by batch are written, before they are summed."""
    landing, out, state = (str(tmp_path / n) for n in ("landing", "out", "state"))
    deliver(landing, *DELIVERIES[0][:1], *DELIVERIES[0][1])
    replace = TableStore.replace
    monkeypatch.setattr(TableStore, "replace", lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(Exception, match="gone"):
        upsert_event_time_counts(stream_events(spark, landing), out, state)
    monkeypatch.setattr(TableStore, "replace", replace)
    store = upsert_event_time_counts(stream_events(spark, landing), out, state)
    assert counted(store) == {(1, "a/0"): 1, (1, "a/1"): 1, (3, "a/0"): 1}
    assert late_rows(store).count() == 0


def test_events_without_a_time_are_counted_as_such(spark, tmp_path):
    row = archive.event(1, "2019-06-27", 3, archive.PUSH, "a/x", "u1")
    nameless = dict(row, repo=None)
    lines = [json.dumps(dict(row, created_at=None)), json.dumps(row), json.dumps(nameless), "{bad"]
    archive.put(tmp_path, "", 0, lines, flat=True, name="x.json")
    store = TableStore(spark, str(tmp_path / "out"))
    upsert_batch(read_events(spark, str(tmp_path / "x.json")), 0, store, "q")
    assert counted(store) == {(3, "a/x"): 1, (3, None): 1}
    read = store.read("event_time_batches").first()
    assert read["undated"] == 1 and read["newest"].astimezone(timezone.utc).hour == 3
    # a batch of nothing
    upsert_batch(read_events(spark, str(tmp_path / "x.json")).where("id = 'none'"), 1, store, "q")
    assert counted(store) == {(3, "a/x"): 1, (3, None): 1}
    assert store.read("event_time_batches").where("batch = 1").first()["newest"] == read["newest"]


def test_lateness_is_measured_from_the_end_of_the_hour(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "out"))
    rows = "type string, created_at timestamp, repo struct<name: string>"

    def batch(number, *times):
        frame = spark.createDataFrame([(archive.PUSH, t, ("r",)) for t in times], rows)
        upsert_batch(frame, number, store, "q", timedelta(hours=2))

    def at(hour, minute=0):
        return datetime(2019, 6, 27, hour, minute, tzinfo=timezone.utc)

    batch(0, at(6, 0))
    batch(1, at(2, 59), at(3, 0), at(3, 59), at(4, 0))
    assert sorted(r.hour for r in corrections(store).collect()) == [2, 3]


BAD = ['{"id": "1", "type": "PushEv', "no json at all", '{"id": "1", "type": "PushEv', ""]
HALF = json.dumps(dict(archive.event(7, "2019-06-27", 0, archive.PUSH, "a/x", "u1"), created_at={"not": "a time"}))


@pytest.mark.parametrize("how", [{}, {"compressed": True}])
def test_broken_lines_are_kept_with_their_file(spark, tmp_path, how):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "t")
    good = [line for line in archive.lines(HOURS[0]) if line != "{bad"]
    path = archive.put(landing, *HOURS[0], good + BAD, **how)
    archive.put_hour(landing, HOURS[1], **how)
    store = backfill(spark, landing, out, FIRST, LAST)

    def kept():
        return {(os.path.basename(r.file), r.hour, r.line, r.reason): r["count"] for r in store.read("broken_lines").collect()}

    assert kept() == {(path.name, 0, BAD[0], "no JSON"): 2, (path.name, 0, BAD[1], "no JSON"): 1}
    clean = backfill(spark, landing, str(tmp_path / "t2"), FIRST, LAST, Settings(keep_broken=False))
    for name in ("events", "hourly_events", "repo_details"):
        assert sorted(map(repr, store.read(name).collect())) == sorted(map(repr, clean.read(name).collect()))
    # the hour comes again without them
    again = archive.put(landing, *HOURS[0], good, flat=True, **how)
    os.utime(again, (2e9, 2e9))
    ingest_available(spark, landing, out, str(tmp_path / "s"))
    assert kept() == {}


def test_a_line_of_which_a_field_is_bad_counts_and_is_kept(spark, tmp_path):
    archive.put(tmp_path / "landing", *HOURS[0], [HALF], name="2019-06-27-0.json")
    raw = read_events(spark, str(tmp_path / "landing"))
    rows = broken_lines(raw).collect()
    assert [(r.reason, r.line, r["count"]) for r in rows] == [("bad field", HALF, 1)]
    store = backfill(spark, str(tmp_path / "landing"), str(tmp_path / "t"), FIRST, LAST, Settings(minimums={archive.PUSH: 0}))
    assert store.read("hourly_events").select("count").first()[0] == 1
    assert store.read("broken_lines").count() == 1


def test_only_files_with_broken_lines_are_read_again(spark, tmp_path, monkeypatch):
    from repotide.plans import refresh

    archive.put_all(tmp_path / "landing")  # the first hour has a broken line
    read = []
    monkeypatch.setattr(refresh, "read_events", lambda spark, paths: read.append(paths) or read_events(spark, paths))
    store = backfill(spark, str(tmp_path / "landing"), str(tmp_path / "t"), FIRST, LAST)
    assert [len(paths) for paths in read] == [3, 1] and read[1][0].endswith("2019-06-27-0.json")
    assert [r.line for r in store.read("broken_lines", F.col("hour") == 0).collect()] == ["{bad"]
