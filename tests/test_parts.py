"""Helpers: skewed joins, rankings, dates, names, command line, database export."""

import random
from datetime import date

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F

from repotide.__main__ import parse
from repotide.functions import calendar, naming
from repotide.functions.joins import salted_join
from repotide.functions.ranking import with_rank
from repotide.operators import daily, details, hourly, scoring
from repotide.plans import serving
from repotide.plans.backfill import backfill_month
from repotide.schemas import TABLES, USED_EVENTS
from repotide.session import work_dir
from repotide.sources.jdbc import export_jdbc, export_tables, read_jdbc
from repotide.sources.landing import canonical_events, read_events

from . import archive


def plan_of(df):
    return df._jdf.queryExecution().toString()


def skewed_rows(n=3000):
    """A third of the rows has one key, and these are all the same row."""
    random.seed(7)
    rows = [("hot", 0)] * (n // 3)
    return rows + [(f"k{random.randrange(400)}", i) for i in range(n - len(rows))]


@pytest.mark.parametrize("salts", [1, 4, 16])
def test_salted_join_with_a_hot_key(spark, salts):
    rows = spark.createDataFrame(skewed_rows(), "key string, value int")
    lookup = rows.where("key <> 'k7'").groupBy("key").agg(F.max("value").alias("top"))
    joined = salted_join(rows, lookup, ["key"], "value", salts)
    plain = rows.join(lookup, "key")
    assert sorted(joined.columns) == sorted(plain.columns)
    assert sorted(map(tuple, joined.select(plain.columns).collect())) == sorted(map(tuple, plain.collect()))


def test_scored_details_without_a_bound_read_each_frame_once(spark, tmp_path):
    frame = spark.range(100).selectExpr("date'2019-06-27' as create_date", "concat('r', id % 3) as repo_name", "cast(id as string) as id")
    frame.write.parquet(str(tmp_path / "d"))
    frame.selectExpr("create_date", "repo_name", "1.0D as score").distinct().write.parquet(str(tmp_path / "s"))
    joined = details.scored_repo_details(spark.read.parquet(str(tmp_path / "s")), spark.read.parquet(str(tmp_path / "d")))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and plan.count("Exchange") <= 2
    assert joined.count() == 100


def test_languages_of_a_hot_repository(spark):
    rows = [(date(2019, 6, 27), 0, r, f"l{i % 3}", i) for i, (r, _) in enumerate(skewed_rows(900))]
    frame = spark.createDataFrame(rows, "create_date date, hour int, repo_name string, language string, id int")
    expected = {}
    for _, _, repo, language, _ in rows:
        expected.setdefault(repo, set()).add(language)
    for bound in (None, 5000):
        result = details.attach_languages(frame, bound).collect()
        assert len(result) == 900
        assert all(r.languages == sorted(expected[r.repo_name]) for r in result)


@pytest.mark.parametrize("k", [3, 1500])
def test_rank_early_cut_and_salted_cut(spark, k):
    random.seed(3)
    rows = [("hot" if i % 3 else f"g{i % 7}", random.randrange(50), i) for i in range(6000)]
    frame = spark.createDataFrame(rows, "g string, v int, id int")
    ranked = with_rank(frame, ["g"], [F.desc("v"), F.asc("id")], k)
    by_group = {}
    for g, v, i in rows:
        by_group.setdefault(g, []).append((-v, i))
    expected = sorted((g, n, i) for g, vs in by_group.items() for n, (_, i) in enumerate(sorted(vs)[:k], 1))
    assert sorted(map(tuple, ranked.select("g", "rank", "id").collect())) == expected


def test_top_lists_are_cut_before_the_shuffle(spark):
    counts = spark.createDataFrame([], "create_date date, hour int, event string, repo_name string, count bigint")
    plan = plan_of(daily.daily_event_top(counts))
    assert "WindowGroupLimit" in plan and "row_number(), 50" in plan


def test_plans_prune_partitions_columns_and_json(spark, tmp_path):
    archive.put_all(tmp_path / "landing")
    store = backfill_month(spark, str(tmp_path / "landing"), str(tmp_path / "t"), "2019", "06")
    tables = serving.TrendTables.stored(store)

    top = plan_of(serving.top_repos(tables, "push", "week", "2019-07-01"))
    assert "TakeOrderedAndProject" in top
    assert "create_date#" in top.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(event,PushEvent)" in top

    raw = plan_of(canonical_events(read_events(spark, str(tmp_path / "landing"))))
    assert "PushedFilters: [In(type" in raw

    users = plan_of(hourly.hourly_user_pushes(store.read("events")))
    assert users.split("ReadSchema: ")[1].startswith("struct<event:string,repo_name:string,user_name:string>")

    scores = scoring.aggregate_score(store.read("daily_events"))._jdf.queryExecution().executedPlan().toString()
    assert scores.count("FileScan parquet") == 1 and "Join" not in scores


def test_windows(spark):
    day = spark.range(1).select(
        *(calendar.window_start("2019-07-01", name).alias(name) for name in calendar.WINDOW_DAYS),
        *(calendar.slider_start("2019-07-01", p).alias(f"s{p}") for p in (0, 10, 50, 100, 7, None)),
        calendar.window_start(date(2019, 7, 1), 3).alias("three"),
    )
    assert [str(v) for v in day.first()] == [
        "2019-06-24",
        "2019-06-01",
        "2019-04-02",
        "2019-01-02",
        "2019-06-24",
        "2019-06-01",
        "2019-04-02",
        "2019-01-02",
        "2019-07-01",
        "2019-07-01",
        "2019-06-28",
    ]


def test_month_bounds():
    assert calendar.month_bounds("2019", "02") == (date(2019, 2, 1), date(2019, 2, 28))
    assert calendar.month_bounds("2020", "02")[1] == date(2020, 2, 29)
    for year, month in (("19", "06"), ("2019", "6"), ("2019", "13"), ("2019", "00"), ("abcd", "06"), ("2019", "xx")):
        with pytest.raises(ValueError):
            calendar.month_bounds(year, month)
    days = [date(2019, 2, 1), date(2018, 12, 31), date(2019, 2, 1), date(2019, 2, 9)]
    assert calendar.by_month(days) == [[date(2018, 12, 31)], [date(2019, 2, 1), date(2019, 2, 9)]]
    assert calendar.months_between(date(2018, 12, 31), date(2019, 2, 1)) == ["2018-12", "2019-01", "2019-02"]


def test_hours_scope(spark):
    days = [date(2019, 6, d) for d in range(1, 31)]
    frame = spark.createDataFrame([(d, h) for d in days for h in range(24)], "create_date date, hour int")
    hours = {(days[0], 3), (days[0], 4), (days[1], 3), (days[1], 4), (days[2], 9)}
    assert {tuple(r) for r in frame.where(calendar.hours_scope(hours)).collect()} == hours
    assert frame.where(calendar.hours_scope([])).count() == 0


def test_hour_names(spark):
    paths = [
        ("s3a://b/2019-06-27/2019-06-27-5.json", "2019-06-27", 5),
        ("file:/l/2019-06-27-23.json.gz", "2019-06-27", 23),
        ("file:/l/hour_file=2019-06-27-0.json/part-0.txt.gz", "2019-06-27", 0),
        ("file:/2018-01-01-3.json/2019-06-27-4.json", "2018-01-01", 3),
        ("file:/2019-06-27-5.json/a/b.json", "2019-06-27", 5),
    ]
    frame = spark.createDataFrame([(p,) for p, _, _ in paths], "path string")
    path = F.col("path")
    parsed = frame.select("path", naming.path_date(path).cast("string"), naming.path_hour(path)).collect()
    assert [tuple(r) for r in parsed] == paths
    others = [("file:/l/2019-06-27-5.json.tmp",), ("file:/l/notes.json",), ("file:/2019-06-27-5.jsonl/b.json",)]
    frame = spark.createDataFrame(others, "path string")
    assert frame.where(naming.is_hour_path(path)).count() == 0


def test_work_dir_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first.startswith(shared + "/x-") and first != second


def test_command_line(capsys):
    args = parse(["backfill", "--landing", "l", "--out", "o", "-y", "2019", "-m", "06", "--hourly-details"])
    assert (args.job, args.year, args.month, args.hourly_details) == ("backfill", "2019", "06", True)
    assert parse(["ingest", "--landing", "l", "--out", "o", "--checkpoint", "c"]).max_files is None
    assert parse(["export", "--out", "o", "--url", "u", "--since", "2019-06-01"]).since == "2019-06-01"
    for bad in (["-y", "19", "-m", "06"], ["-y", "2019", "-m", "13"]):
        with pytest.raises(SystemExit):
            parse(["backfill", "--landing", "l", "--out", "o", *bad])


def test_export_gives_spark_the_tables_readers_expect(spark, tmp_path, monkeypatch):
    """Looks at what is handed to Spark's JDBC writer; no database is run."""
    archive.put_all(tmp_path / "landing")
    store = backfill_month(spark, str(tmp_path / "landing"), str(tmp_path / "t"), "2019", "06")
    written = {}

    def jdbc(writer, url, table, mode=None, properties=None):
        written[table] = (url, mode, properties, writer._df.columns, writer._df.count())

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    export_tables(store, "jdbc:some:db", properties={"user": "me"})
    event = ["event", "repo_name", "count", "create_date"]
    assert {name: (columns, rows) for name, (_, _, _, columns, rows) in written.items()} == {
        "PushEvent_table": (event, 4),
        "WatchEvent_table": (event, 2),
        "ForkEvent_table": (event, 1),
        "repo_users": (["repo_name", "user_name", "count", "create_date"], 3),
        "AggregateEvent_table": (["repo_name", "score", "create_date"], 4),
        "repo_details": (
            "repo_name score create_date forks has_wiki languages open_issues_count stars_count watchers".split(),
            3,
        ),
    }
    assert {v[:2] for v in written.values()} == {("jdbc:some:db", "append")}
    assert all(v[2] == {"user": "me"} for v in written.values())

    written.clear()
    export_tables(store, "u", F.col("create_date") >= "2019-06-28", "overwrite")
    assert [written[t][4] for t in ("PushEvent_table", "WatchEvent_table", "repo_details")] == [1, 0, 0]
    export_jdbc(spark.range(3), "u", "one")
    assert written["one"][4] == 3


def test_names_are_read_once_and_plain_text_is_an_error(spark):
    users = spark.createDataFrame([("a", "u", 1, date(2019, 6, 27))], "repo_name string, user_name string, count long, create_date date")
    details = spark.createDataFrame([], TABLES["repo_details"].schema)
    tables = serving.TrendTables(users, users, users, details)
    profile = [
        sorted(r.repo_name for r in serving.repo_profile(tables, "month", "2019-06-30", names).collect())
        for names in ((n for n in ("a", "b")), ["a", "b"], spark.createDataFrame([("a",), ("b",)], "repo_name string"))
    ]
    assert profile == [["a", "b"]] * 3
    with pytest.raises(TypeError):
        serving.repo_profile(tables, "month", "2019-06-30", "ab")


def test_details_read_the_events_twice_and_build_without_a_job(spark, tmp_path):
    spark.range(10).selectExpr(
        "date'2019-06-27' as create_date", "1 as hour", "'PullRequestEvent' as event", "'r' as repo_name", "'u' as user_name",
        "timestamp'2019-06-27 01:00:00' as created_at", "cast(id as string) as id",
        "named_struct('language', 'Go', 'open_issues_count', id, 'forks', id, 'has_wiki', true, 'stars_count', id, 'watchers', id) as head_repo",
    ).write.parquet(str(tmp_path / "e"))
    events = spark.read.parquet(str(tmp_path / "e"))
    spark.sparkContext.setJobGroup("build", "build")
    frame = details.repo_detail_rows(events)
    scored = details.scored_repo_details_from_events(frame.selectExpr("create_date", "repo_name", "1.0D as score").distinct(), events)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert frame.count() == 10 and scored.count() == 10


def test_read_jdbc_arguments(spark, monkeypatch):
    seen = {}

    def jdbc(reader, url, table, properties=None, **rest):
        seen.update(url=url, table=table, properties=properties, **rest)

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    read_jdbc(spark, "u", "t", {"user": "me"}, column="count", lowerBound=0, upperBound=9, numPartitions=3)
    assert seen["table"] == "t" and seen["properties"] == {"user": "me"} and seen["numPartitions"] == 3


def test_used_events():
    assert USED_EVENTS == ("PushEvent", "WatchEvent", "ForkEvent", "PullRequestEvent")
