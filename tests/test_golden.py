"""The hand-checked archive, with the default minimums and cuts."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from repotide.operators import daily, details, hourly, scoring
from repotide.plans import serving
from repotide.plans.backfill import backfill, backfill_month
from repotide.plans.refresh import Settings
from repotide.sources.landing import canonical_events, hour_files, read_events

from . import archive

D27, D28 = date(2019, 6, 27), date(2019, 6, 28)
FIRST, LAST = date(2019, 6, 1), date(2019, 6, 30)


def got(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def six(value):
    return float(round(Decimal(value), 6))


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    archive.put_all(folder)
    return str(folder)


@pytest.fixture(scope="module")
def events(spark, landing):
    return canonical_events(read_events(spark, landing))


@pytest.fixture(scope="module")
def store(spark, landing, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    return backfill_month(spark, landing, out, "2019", "06", Settings(hourly_details=True))


@pytest.fixture(scope="module")
def tables(store):
    return serving.TrendTables.stored(store)


HOURLY_EVENTS = [
    (D27, 0, "ForkEvent", "b/y", 5),
    (D27, 0, "PushEvent", "a/x", 12),
    (D27, 0, "PushEvent", "c/z", 12),
    (D27, 0, "WatchEvent", "a/x", 6),
    (D27, 23, "PushEvent", "b/y", 11),
    (D27, 23, "WatchEvent", "a/x", 6),
    (D27, 23, "WatchEvent", "c/z", 8),
    (D28, 5, "PushEvent", "a/x", 20),
]
DAILY_EVENTS = [
    (D27, "ForkEvent", "b/y", 5),
    (D27, "PushEvent", "a/x", 12),
    (D27, "PushEvent", "b/y", 11),
    (D27, "PushEvent", "c/z", 12),
    (D27, "WatchEvent", "a/x", 12),
    (D27, "WatchEvent", "c/z", 8),
    (D28, "PushEvent", "a/x", 20),
]
USERS = [(D27, "a/x", "u1", 12), (D27, "b/y", "u2", 11), (D28, "a/x", "u1", 20)]
SCORES = [(D27, "a/x", 0.666667), (D27, "b/y", 0.638889), (D27, "c/z", 0.555556), (D28, "a/x", 0.333333)]


def test_broken_lines_and_other_types_are_dropped(events):
    counts = dict(got(events.groupBy("event").count(), "event", "count"))
    assert counts == {"PushEvent": 73, "WatchEvent": 25, "ForkEvent": 9, "PullRequestEvent": 6}


def test_hour_comes_from_the_file_name(spark, tmp_path):
    row = archive.lines(("2019-06-28", 5))
    archive.put(tmp_path, "2019-07-01", 9, row)
    raw = read_events(spark, str(tmp_path))
    by_file = canonical_events(raw).select("create_date", "hour").distinct()
    assert got(by_file, "*") == [(date(2019, 7, 1), 9)]
    by_event = canonical_events(raw, "created_at").select("create_date", "hour").distinct()
    assert got(by_event, "*") == [(D28, 5)]
    with pytest.raises(ValueError):
        canonical_events(raw, "clock")


def test_hour_of_created_at_is_utc_in_any_session_zone(spark, landing):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        hours = canonical_events(read_events(spark, landing), "created_at").select("create_date", "hour").distinct()
        assert got(hours, "*") == [(D27, 0), (D27, 23), (D28, 5)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_missing_fields_read_as_null(spark, tmp_path):
    archive.put(tmp_path, "2019-06-27", 1, ['{"type": "PushEvent"}', '{"type": "PullRequestEvent", "payload": {}}'])
    events = canonical_events(read_events(spark, str(tmp_path)))
    assert events.where("repo_name is null and head_repo is null").count() == 2
    assert details.pull_request_rows(events, False).count() == 0


def test_hourly_events(events):
    assert got(hourly.hourly_event_counts(events), "create_date", "hour", "event", "repo_name", "count") == HOURLY_EVENTS


def test_hourly_users(events):
    expected = [(D27, 0, "a/x", "u1", 12), (D27, 23, "b/y", "u2", 11), (D28, 5, "a/x", "u1", 20)]
    assert got(hourly.hourly_user_pushes(events), "create_date", "hour", "repo_name", "user_name", "count") == expected


def test_daily(events):
    counts = hourly.hourly_event_counts(events)
    assert got(daily.daily_event_top(counts), "create_date", "event", "repo_name", "count") == DAILY_EVENTS
    users = daily.daily_user_top(hourly.hourly_user_pushes(events))
    assert got(users, "create_date", "repo_name", "user_name", "count") == USERS


def test_scores(events):
    top = daily.daily_event_top(hourly.hourly_event_counts(events))
    scores = scoring.aggregate_score(top)
    assert got(scores, "create_date", "repo_name", F.round("score", 6)) == SCORES
    peaks = scoring.daily_peaks(top)
    assert got(peaks, "create_date", "event", "peak") == [
        (D27, "ForkEvent", 5),
        (D27, "PushEvent", 12),
        (D27, "WatchEvent", 12),
        (D28, "PushEvent", 20),
    ]


def test_detail_rows(events):
    columns = ["repo_name", "languages", "open_issues_count", "has_wiki", "forks", "stars_count", "watchers"]

    def row(repo, languages, n):
        return (repo, languages, n, n % 2 == 0, 2 * n, 3 * n, 4 * n)

    # the hour's numbers 58 to 63 are its pull requests
    with_language = [row("a/x", ["Go", "Python"], n) for n in (58, 59, 60)] + [row("d/w", ["Scala"], 63)]
    assert got(details.repo_detail_rows(events), *columns) == with_language
    any_language = sorted(with_language + [row("b/y", [], 61)])
    assert got(details.repo_detail_rows(events, require_language=False), *columns) == any_language


def test_scored_details_both_ways(events):
    scores = scoring.aggregate_score(daily.daily_event_top(hourly.hourly_event_counts(events)))
    for require_language, expected in ((True, ["a/x"] * 3), (False, ["a/x"] * 3 + ["b/y"])):
        rows = details.repo_detail_rows(events, require_language)
        frames = [
            details.scored_repo_details(scores, rows),
            details.scored_repo_details_from_events(scores, events, require_language, score_rows=300),
        ]
        if require_language:  # too many scores to broadcast
            frames.append(details.scored_repo_details_from_events(scores, events, score_rows=10**9))
        results = [got(f, "repo_name", "create_date", F.round("score", 6), "languages", "id") for f in frames]
        assert [r[0] for r in results[0]] == expected
        assert all(r == results[0] for r in results)


def test_stored_tables(store):
    assert got(store.read("hourly_events"), "create_date", "hour", "event", "repo_name", "count") == HOURLY_EVENTS
    assert got(store.read("daily_events"), "create_date", "event", "repo_name", "count") == DAILY_EVENTS
    assert got(store.read("repo_users"), "create_date", "repo_name", "user_name", "count") == USERS
    assert got(store.read("repo_scores"), "create_date", "repo_name", F.round("score", 6)) == SCORES
    assert got(store.read("hourly_repo_details"), "repo_name") == [("a/x",)] * 3 + [("d/w",)]
    assert got(store.read("repo_details"), "create_date", "repo_name", "languages") == [
        (D27, "a/x", ["Go", "Python"])
    ] * 3


def test_settings_keep_unknown_language(spark, landing, tmp_path):
    store = backfill(spark, landing, str(tmp_path), FIRST, LAST, Settings(require_language=False))
    assert [r[0] for r in got(store.read("repo_details"), "repo_name")] == ["a/x", "a/x", "a/x", "b/y"]


@pytest.mark.parametrize(
    "metric, as_of, expected",
    [
        ("push", "2019-07-01", [("a/x", 32), ("c/z", 12), ("b/y", 11)]),
        ("push", "2019-07-05", [("a/x", 20)]),
        ("push", "2019-07-06", []),
        ("watch", "2019-07-01", [("a/x", 12), ("c/z", 8)]),
        ("fork", "2019-07-01", [("b/y", 5)]),
        ("aggregate", "2019-07-01", [("a/x", 1.0), ("b/y", 0.638889), ("c/z", 0.555556)]),
    ],
)
def test_top_repos(tables, metric, as_of, expected):
    rows = serving.top_repos(tables, metric, "week", as_of).collect()
    assert [(r.repo_name, six(r.total) if metric == "aggregate" else r.total) for r in rows] == expected


def test_top_repos_rejects_unknown_metric(tables):
    with pytest.raises(ValueError):
        serving.top_repos(tables, "stars", "week", "2019-07-01")


def test_users(tables):
    expected = [("a/x", "u1", 32, 1), ("b/y", "u2", 11, 1)]
    columns = ["repo_name", "user_name", "total", "rank"]
    assert got(serving.repo_top_users(tables, 7, "2019-07-01"), *columns) == expected
    assert got(serving.repo_top_users(tables, 7, "2019-07-01", repos=["b/y"]), *columns) == expected[1:]
    assert got(serving.top_users(tables, 7, "2019-07-01"), "user_name", "total") == [("u1", 32), ("u2", 11)]


def test_latest_details_and_profile(spark, tables):
    latest = serving.latest_repo_details(tables)
    assert got(latest, "repo_name", "id") == [("a/x", "59")]
    wanted = spark.createDataFrame([("a/x",), ("b/y",), ("q/q",), ("q/q",)], "repo_name string")
    for repos in (wanted, ["a/x", "b/y", "q/q"]):
        profile = serving.repo_profile(tables, "week", "2019-07-01", repos)
        assert got(profile, "repo_name", "users", "languages", "forks", "has_wiki", "url") == [
            ("a/x", ["u1"], ["Go", "Python"], 118, False, "https://github.com/a/x/"),
            ("b/y", ["u2"], None, None, None, "https://github.com/b/y/"),
            ("q/q", [], None, None, None, "https://github.com/q/q/"),
        ]
    everyone = serving.repo_profile(tables, "week", "2019-07-01")
    assert got(everyone, "repo_name") == [("a/x",), ("b/y",)]
    text = serving.profile_text(everyone)
    assert got(text, "repo_name", "users", "languages", "has_wiki", "stars") == [
        ("a/x", "u1", "GoPython", "False", "177"),
        ("b/y", "u2", None, None, None),
    ]


def test_repos_over(tables):
    assert got(serving.repos_over(tables, "push", 12), "create_date", "repo_name", "value") == [(D28, "a/x", 20)]
    assert got(serving.repos_over(tables), "repo_name") == []


def test_top_lists_at_the_cut(spark):
    """More than k equal counts: the first names stay, and scores are in (0, 1]."""
    rows = [(D27, 3, e, f"r{n:03}", 9) for n in range(70) for e in archive_types()]
    counts = spark.createDataFrame(rows, "create_date date, hour int, event string, repo_name string, count bigint")
    top = daily.daily_event_top(counts)
    kept = got(top.where("event = 'PushEvent'"), "repo_name")
    assert kept == [(f"r{n:03}",) for n in range(50)]
    shorter = daily.daily_event_top(counts, 20)
    assert shorter.join(top, top.columns, "left_anti").count() == 0
    scores = [r[0] for r in got(scoring.aggregate_score(top), "score")]
    assert all(0 < s <= 1 for s in scores)


def archive_types():
    return (archive.PUSH, archive.WATCH, archive.FORK)


def test_score_divides_by_three_with_one_type(spark):
    rows = [(D27, "PushEvent", "a", 4), (D27, "PushEvent", "b", 1)]
    frame = spark.createDataFrame(rows, "create_date date, event string, repo_name string, count bigint")
    assert got(scoring.aggregate_score(frame), "repo_name", F.round("score", 6)) == [("a", 0.333333), ("b", 0.083333)]


def test_stack_matches_by_name_and_keeps_copies(spark):
    a = spark.createDataFrame([("x", 1)], "event string, count int")
    b = spark.createDataFrame([(1, "x"), (2, "y")], "count bigint, event string")
    stacked = daily.stack(a, b, a)
    assert got(stacked, "event", "count") == [("x", 1), ("x", 1), ("x", 1), ("y", 2)]
    assert dict(stacked.dtypes)["count"] == "bigint"


def test_hours_are_listed_from_the_landing_folder(spark, landing):
    assert sorted(hour_files(spark, landing, FIRST, LAST)) == [(D27, 0), (D27, 23), (D28, 5)]
    assert sorted(hour_files(spark, landing, D28, LAST)) == [(D28, 5)]
    assert hour_files(spark, landing, date(2018, 1, 1), date(2018, 1, 2)) == {}
