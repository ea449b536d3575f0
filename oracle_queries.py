"""DuckDB SQL giving the results that the queries of ``__spark_entry__`` must give.

Written from the definitions, independently of the Spark plans: counts per hour, minimum,
sum per day, cut, score. Dates are text on both sides.
"""

from __future__ import annotations

_EVENTS = """
ev AS (
    SELECT {day} AS create_date,
           CAST(hour(ts) AS INTEGER) AS hour,
           CASE event_type WHEN 'click' THEN 'PushEvent' WHEN 'view' THEN 'WatchEvent'
                WHEN 'signup' THEN 'ForkEvent' WHEN 'purchase' THEN 'PullRequestEvent'
                WHEN 'error' THEN 'IssuesEvent' END AS event,
           CASE WHEN event_type <> 'purchase' OR event_id % 13 <> 0 THEN {repo} END AS repo_name,
           'user_' || CAST({user} AS VARCHAR) AS user_name,
           event_type = 'purchase' AND event_id % 11 <> 0 AS has_head,
           ts,
           event_id,
           CAST(event_id AS VARCHAR) AS id,
           CASE event_id % 4 WHEN 0 THEN 'Python' WHEN 1 THEN 'Go' WHEN 2 THEN 'Scala' END AS language,
           event_id % 7 AS open_issues_count,
           CAST(floor(value) AS BIGINT) AS forks,
           event_id % 2 = 0 AS has_wiki,
           event_id % 1000 AS stars_count,
           event_id % 500 AS watchers
    FROM events)
"""
_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_FEW = f"'repo_' || CAST({_K} % 10 AS VARCHAR)"


def _events(repo: str, user: str = "user_id", day: str = "CAST(ts AS DATE)") -> str:
    return "WITH " + _EVENTS.format(repo=repo, user=user, day=day).strip()


EV = _events(f"'repo_' || CAST({_K} AS VARCHAR)")
EV10 = _events(_FEW)
EV10_10 = _events(_FEW, "user_id % 10")
# All days as one, so that hours have counts like those of the real archive.
_ONE_DAY = "DATE '2024-01-01'"
DAY_EV10 = _events(_FEW, day=_ONE_DAY)
DAY_EV2_2 = _events(f"'repo_' || CAST({_K} % 2 AS VARCHAR)", "user_id % 2", _ONE_DAY)

_COUNTED = "event IN ('PushEvent', 'WatchEvent', 'ForkEvent')"


def _hourly(minimum: int) -> str:
    return f"""
hourly AS (
    SELECT create_date, hour, event, repo_name, count(*) AS count FROM ev
    WHERE {_COUNTED} GROUP BY create_date, hour, event, repo_name HAVING count(*) > {minimum})
"""


# The minimums and cuts of the trend tables.
_DEFAULT_HOURLY = f"""
hourly AS (
    SELECT create_date, hour, event, repo_name, count(*) AS count FROM ev
    WHERE {_COUNTED} GROUP BY create_date, hour, event, repo_name
    HAVING count(*) > CASE event WHEN 'PushEvent' THEN 10 WHEN 'WatchEvent' THEN 5 ELSE 4 END)
"""


HOURLY_USERS = """
hourly_users AS (
    SELECT create_date, hour, repo_name, user_name, count(*) AS count FROM ev
    WHERE event = 'PushEvent' GROUP BY create_date, hour, repo_name, user_name)
"""
DAILY = """
daily AS (
    SELECT create_date, event, repo_name, CAST(sum(count) AS BIGINT) AS count FROM hourly
    GROUP BY create_date, event, repo_name)
"""
TOP = """
top AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY create_date, event ORDER BY count DESC, repo_name) AS rn
        FROM daily) WHERE rn <= 20)
"""
DAILY_USERS = """
daily_users AS (
    SELECT create_date, repo_name, user_name, CAST(sum(count) AS BIGINT) AS count FROM hourly_users
    GROUP BY create_date, repo_name, user_name)
"""
TOP_USERS = """
top_users AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY create_date ORDER BY count DESC, repo_name, user_name) AS rn
        FROM daily_users) WHERE rn <= 20)
"""
NORM = """
norm AS (
    SELECT create_date, event, repo_name, count,
           count / max(count) OVER (PARTITION BY create_date, event) AS norm FROM top)
"""
SCORES = """
scores AS (
    SELECT create_date, repo_name, sum(norm) / 3 AS score FROM norm GROUP BY create_date, repo_name)
"""


def _details(require_language: bool) -> str:
    condition = "AND language IS NOT NULL" if require_language else ""
    return f"""
pr AS (SELECT * FROM ev WHERE event = 'PullRequestEvent' AND has_head AND repo_name IS NOT NULL {condition}),
langs AS (
    SELECT create_date, hour, repo_name,
           coalesce(string_agg(DISTINCT language, ',' ORDER BY language), '') AS languages
    FROM pr GROUP BY create_date, hour, repo_name),
details AS (
    SELECT pr.* EXCLUDE (language), langs.languages
    FROM pr JOIN langs USING (create_date, hour, repo_name))
"""


SCORED = """
scored AS (
    SELECT details.*, score FROM details JOIN scores USING (create_date, repo_name))
"""


def _latest(details: str) -> str:
    return f"""
latest AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY repo_name ORDER BY create_date DESC, hour DESC, ts DESC, id DESC) AS rn
        FROM {details}) WHERE rn = 1)
"""


LATEST = _latest("details")


def _with(*ctes: str, events: str = EV) -> str:
    return ",\n".join([events, *(cte.strip() for cte in ctes)])


SCORE_CHAIN = (_hourly(0), DAILY, TOP, NORM, SCORES)
USER_CHAIN = (HOURLY_USERS, DAILY_USERS)
DAY = "CAST(create_date AS VARCHAR) AS create_date"
FIELDS = "open_issues_count, has_wiki, forks, stars_count, watchers"


def _top_repos(metric: str, start: str) -> str:
    source = {
        "aggregate": "SELECT repo_name, sum(score) AS total FROM scores",
        "push": "SELECT repo_name, CAST(sum(count) AS BIGINT) AS total FROM top",
        "watch": "SELECT repo_name, CAST(sum(count) AS BIGINT) AS total FROM top",
        "fork": "SELECT repo_name, CAST(sum(count) AS BIGINT) AS total FROM top",
    }[metric]
    event = {"push": "PushEvent", "watch": "WatchEvent", "fork": "ForkEvent"}.get(metric)
    only = f" AND event = '{event}'" if event else ""
    total = "round(total, 6)" if metric == "aggregate" else "total"
    return f"""{_with(*SCORE_CHAIN)},
    totals AS ({source} WHERE create_date >= DATE '{start}'{only} GROUP BY repo_name)
SELECT repo_name, {total} AS total FROM totals ORDER BY round(totals.total, 9) DESC, repo_name LIMIT 20"""


def _user_ranks(users: str) -> str:
    return f"""
user_totals AS (
    SELECT repo_name, user_name, CAST(sum(count) AS BIGINT) AS total FROM {users}
    WHERE create_date >= DATE '2024-01-01' GROUP BY repo_name, user_name),
user_ranks AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY repo_name ORDER BY total DESC, user_name) AS INTEGER) AS rank
    FROM user_totals),
user_lists AS (
    SELECT repo_name, string_agg(user_name, ',' ORDER BY rank) AS users
    FROM user_ranks WHERE rank <= 5 GROUP BY repo_name)
"""


_USER_RANKS = _user_ranks("daily_users")


def _profile(columns: str) -> str:
    return f"""{_with(*USER_CHAIN, _USER_RANKS, _details(True), LATEST)}
SELECT repo_name, {columns}, 'https://github.com/' || repo_name || '/' AS url
FROM user_lists FULL OUTER JOIN latest USING (repo_name)"""


NAMES = ("repo_1", "repo_2", "repo_42", "repo_none")


def _profile_of(ctes: str) -> str:
    rows = ", ".join(f"('{name}')" for name in NAMES)
    return f"""{ctes}
SELECT repo_name, coalesce(users, '') AS users, languages, has_wiki, forks, open_issues_count AS open_issues,
       stars_count AS stars, watchers, 'https://github.com/' || repo_name || '/' AS url
FROM (VALUES {rows}) AS names(repo_name) LEFT JOIN user_lists USING (repo_name) LEFT JOIN latest USING (repo_name)"""


# Tables of a whole run: everything that counts, one row per stored row.
STORED_COUNTS = f"""{_with(*SCORE_CHAIN, *USER_CHAIN, TOP_USERS)}
SELECT 'hourly_events' AS stored_in, {DAY}, hour, event, repo_name, NULL AS user_name,
       CAST(count AS DOUBLE) AS amount FROM hourly
UNION ALL SELECT 'hourly_users', CAST(create_date AS VARCHAR), hour, NULL, repo_name, user_name, count FROM hourly_users
UNION ALL SELECT 'daily_events', CAST(create_date AS VARCHAR), NULL, event, repo_name, NULL, count FROM top
UNION ALL SELECT 'repo_users', CAST(create_date AS VARCHAR), NULL, NULL, repo_name, user_name, count FROM top_users
UNION ALL SELECT 'repo_scores', CAST(create_date AS VARCHAR), NULL, NULL, repo_name, NULL, round(score, 6) FROM scores"""

STORED_DETAILS = f"""{_with(*SCORE_CHAIN, _details(True), SCORED)}
SELECT 'repo_details' AS stored_in, {DAY}, hour, repo_name, round(score, 6) AS score, languages, {FIELDS}, id FROM scored
UNION ALL
SELECT 'hourly_repo_details', CAST(create_date AS VARCHAR), hour, repo_name, NULL, languages, {FIELDS}, id FROM details"""

# An hour is complete once the newest event is two hours past its end.
EVENT_TIME = f"""{EV}
SELECT {DAY}, hour, event, repo_name, count(*) AS count FROM ev
WHERE {_COUNTED}
  AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM ev WHERE {_COUNTED})
GROUP BY ev.create_date, hour, event, repo_name"""

# Counts by event time, whatever the order of arrival.
_BY_CREATED_AT = f"""
SELECT {DAY}, hour, event, repo_name, count(*) AS count FROM ev WHERE {_COUNTED}
GROUP BY ev.create_date, hour, event, repo_name"""


def _late(batch: int, hours: str, earlier: str) -> str:
    """Counts that batch number ``batch`` brings for hours which the newest event of the earlier ones has passed."""
    return f"""
SELECT create_date, hour, event, repo_name, count(*) AS count, {batch} AS batch FROM ev
WHERE {_COUNTED} AND {hours} AND date_trunc('hour', ts) + INTERVAL 1 HOUR
    <= (SELECT max(ts) - INTERVAL 2 HOUR FROM ev WHERE {_COUNTED} AND ({earlier}))
GROUP BY create_date, hour, event, repo_name"""


# The hours come in three deliveries: those with remainder 1, then 2, then 0.
_LATE = f"""{EV},
late AS ({_late(1, "hour % 3 = 2", "hour % 3 = 1")} UNION ALL {_late(2, "hour % 3 = 0", "hour % 3 <> 0")})"""

# Every 40th event has left a line that breaks off and every 60th the same two characters.
BROKEN = f"""{EV},
cut AS (
    SELECT create_date, hour, '{{"id":"' || id || '","type":"' || event AS line FROM ev WHERE event_id % 40 = 0
    UNION ALL SELECT create_date, hour, '{{"' FROM ev WHERE event_id % 60 = 0)
SELECT {DAY}, hour, strftime(create_date, '%Y-%m-%d') || '-' || CAST(hour AS VARCHAR) || '.json' AS file_name,
       line, 'no JSON' AS reason, count(*) AS count
FROM cut GROUP BY cut.create_date, hour, line"""

# Name, day and content of every row that is exported.
_EXPORTED = """
    SELECT event || '_table' AS name, create_date, concat_ws('|', repo_name, count) AS content FROM top
    UNION ALL SELECT 'repo_users', create_date, concat_ws('|', repo_name, user_name, count) FROM top_users
    UNION ALL SELECT 'AggregateEvent_table', create_date, concat_ws('|', repo_name, round(score, 9)) FROM scores
    UNION ALL SELECT 'repo_details', create_date, concat_ws('|', repo_name, round(score, 9), languages,
        coalesce(forks, -1), has_wiki, open_issues_count, stars_count, watchers) FROM scored
"""


def _tables_of(condition: str) -> str:
    """All exported rows as they are when the events of ``condition`` have arrived."""
    some = f"ev AS (SELECT * FROM all_ev WHERE {condition})"
    events = EV.replace("ev AS (", "all_ev AS (", 1)
    chain = (some, *SCORE_CHAIN, *USER_CHAIN, TOP_USERS, _details(True), SCORED)
    return f"({_with(*chain, events=events)} {_EXPORTED})"


# Days whose rows differ once hour 23 of the days from the 16th on has come late.
EXPORT_PENDING = f"""
WITH before AS (SELECT * FROM {_tables_of("NOT (create_date >= DATE '2024-01-16' AND hour = 23)")}),
after AS (SELECT * FROM {_tables_of("true")}),
differs AS (
    SELECT DISTINCT name, create_date FROM (
        (SELECT * FROM before EXCEPT ALL SELECT * FROM after)
        UNION ALL (SELECT * FROM after EXCEPT ALL SELECT * FROM before)))
SELECT name, {DAY}, count(content) AS rows
FROM differs LEFT JOIN after USING (name, create_date) GROUP BY name, differs.create_date"""

ORACLE = {
    "canonical_events": f"""{EV}
SELECT {DAY}, hour, event, repo_name, user_name, id FROM ev""",
    "landing_events": f"""{EV}
SELECT {DAY}, hour, event, repo_name, user_name, id,
       CASE WHEN has_head THEN language END AS language,
       CASE WHEN has_head THEN forks END AS forks,
       has_head AS has_head_repo
FROM ev WHERE event <> 'IssuesEvent'""",
    "landing_events_by_created_at": f"""{EV}
SELECT {DAY}, hour, event, count(*) AS count FROM ev WHERE event <> 'IssuesEvent'
GROUP BY ev.create_date, hour, event""",
    "hour_files": f"""{EV}
SELECT strftime(create_date, '%Y-%m-%d') || '-' || CAST(hour AS VARCHAR) || '.json' AS file_name,
       {DAY}, hour, count(*) AS events
FROM ev GROUP BY ev.create_date, hour""",
    "window_starts": f"""{EV}
SELECT DISTINCT {DAY},
       CAST(CAST(ev.create_date - INTERVAL 7 DAY AS DATE) AS VARCHAR) AS week,
       CAST(CAST(ev.create_date - INTERVAL 30 DAY AS DATE) AS VARCHAR) AS month,
       CAST(CAST(ev.create_date - INTERVAL 90 DAY AS DATE) AS VARCHAR) AS quarter,
       CAST(CAST(ev.create_date - INTERVAL 180 DAY AS DATE) AS VARCHAR) AS half_year,
       CAST(ev.create_date AS VARCHAR) AS unset
FROM ev""",
    "hourly_event_counts": f"""{_with(_hourly(1), events=EV10)}
SELECT {DAY}, hour, event, repo_name, count FROM hourly""",
    "hourly_event_counts_by_type": f"""{EV10},
counts AS (SELECT create_date, hour, event, repo_name, count(*) AS count FROM ev
           WHERE {_COUNTED} GROUP BY create_date, hour, event, repo_name)
SELECT {DAY}, hour, event, repo_name, count FROM counts
WHERE count > CASE event WHEN 'PushEvent' THEN 2 WHEN 'WatchEvent' THEN 1 ELSE 0 END""",
    "hourly_user_pushes": f"""{_with(HOURLY_USERS)}
SELECT {DAY}, hour, repo_name, user_name, count FROM hourly_users""",
    "hourly_user_pushes_above": f"""{_with(HOURLY_USERS, events=EV10_10)}
SELECT {DAY}, hour, repo_name, user_name, count FROM hourly_users WHERE count > 1""",
    "daily_event_counts": f"""{_with(_hourly(0), DAILY)}
SELECT {DAY}, event, repo_name, count FROM daily""",
    "daily_event_top": f"""{_with(_hourly(0), DAILY, TOP)}
SELECT {DAY}, event, repo_name, count FROM top""",
    "daily_event_top_two_level": f"""{_with(_hourly(1), DAILY, TOP, events=EV10)}
SELECT {DAY}, event, repo_name, count FROM top""",
    "daily_user_counts": f"""{_with(*USER_CHAIN)}
SELECT {DAY}, repo_name, user_name, count FROM daily_users""",
    "daily_user_top": f"""{_with(*USER_CHAIN, TOP_USERS)}
SELECT {DAY}, repo_name, user_name, count FROM top_users""",
    "daily_peaks": f"""{_with(_hourly(0), DAILY, TOP)}
SELECT {DAY}, event, max(count) AS peak FROM top GROUP BY top.create_date, event""",
    "daily_max_norm": f"""{_with(_hourly(0), DAILY, TOP, NORM)}
SELECT {DAY}, event, repo_name, count, round(norm, 6) AS norm FROM norm""",
    "default_minimums_hourly": f"""{_with(_DEFAULT_HOURLY, events=DAY_EV10)}
SELECT {DAY}, hour, event, repo_name, count FROM hourly""",
    "default_minimums_scores": f"""{_with(_DEFAULT_HOURLY, DAILY, TOP.replace("<= 20", "<= 50"), NORM, SCORES, events=DAY_EV10)}
SELECT {DAY}, repo_name, round(score, 6) AS score FROM scores""",
    "default_minimum_users": f"""{_with(HOURLY_USERS, events=DAY_EV2_2)}
SELECT {DAY}, repo_name, user_name, CAST(sum(count) AS BIGINT) AS count FROM hourly_users WHERE count > 10
GROUP BY hourly_users.create_date, repo_name, user_name""",
    "stack_event_tables": f"""{_with(_hourly(0), DAILY)}
SELECT {DAY}, event, repo_name, count FROM daily WHERE event = 'PushEvent'
UNION ALL SELECT CAST(create_date AS VARCHAR), event, repo_name, count FROM daily WHERE event = 'WatchEvent'
UNION ALL SELECT CAST(create_date AS VARCHAR), event, repo_name, count FROM daily WHERE event = 'ForkEvent'""",
    "stack_hours": f"""{_with(HOURLY_USERS, DAILY_USERS)}
SELECT {DAY}, repo_name, user_name, count FROM daily_users""",
    "aggregate_score": f"""{_with(*SCORE_CHAIN)}
SELECT {DAY}, repo_name, round(score, 6) AS score FROM scores""",
    "pull_request_rows": f"""{_with(_details(False))}
SELECT {DAY}, hour, repo_name, language, {FIELDS}, id FROM pr""",
    "repo_detail_rows": f"""{_with(_details(True))}
SELECT {DAY}, hour, repo_name, languages, {FIELDS}, id FROM details""",
    "repo_detail_rows_any_language": f"""{_with(_details(False))}
SELECT {DAY}, hour, repo_name, languages, {FIELDS}, id FROM details""",
    "repo_languages": f"""{_with(_details(False))}
SELECT {DAY}, hour, repo_name, languages FROM langs""",
    "scored_repo_details": f"""{_with(*SCORE_CHAIN, _details(True), SCORED)}
SELECT {DAY}, hour, repo_name, round(score, 6) AS score, languages, {FIELDS}, id FROM scored""",
    "scored_repo_details_from_events": f"""{_with(*SCORE_CHAIN, _details(True), SCORED)}
SELECT {DAY}, hour, repo_name, round(score, 6) AS score, languages, {FIELDS}, id FROM scored""",
    **{
        f"top_repos_{metric}_{name}": _top_repos(metric, start)
        for metric in ("aggregate", "push", "watch", "fork")
        for name, start in (("week", "2024-01-24"), ("month", "2024-01-01"))
    },
    "repo_top_users": f"""{_with(*USER_CHAIN, _USER_RANKS)}
SELECT repo_name, user_name, total, rank FROM user_ranks WHERE rank <= 5""",
    "repo_top_users_of_top_repos": f"""{_with(*SCORE_CHAIN, *USER_CHAIN, _USER_RANKS)},
    leaders AS (SELECT repo_name FROM scores WHERE create_date >= DATE '2024-01-01'
                GROUP BY repo_name ORDER BY round(sum(score), 9) DESC, repo_name LIMIT 20)
SELECT repo_name, user_name, total, rank FROM user_ranks
WHERE rank <= 5 AND repo_name IN (SELECT repo_name FROM leaders)""",
    "top_users": f"""{_with(*USER_CHAIN)}
SELECT user_name, CAST(sum(count) AS BIGINT) AS total FROM daily_users
WHERE create_date >= DATE '2024-01-01' GROUP BY user_name ORDER BY total DESC, user_name LIMIT 20""",
    "latest_repo_details": f"""{_with(_details(True), LATEST)}
SELECT repo_name, {DAY}, hour, languages, {FIELDS}, id FROM latest""",
    "repo_profile": _profile(
        "coalesce(users, '') AS users, languages, has_wiki, forks, open_issues_count AS open_issues, "
        "stars_count AS stars, watchers"
    ),
    "profile_text": _profile(
        "replace(coalesce(users, ''), ',', ', ') AS users, replace(languages, ',', '') AS languages, "
        "CASE WHEN has_wiki THEN 'True' WHEN NOT has_wiki THEN 'False' END AS has_wiki, "
        "CAST(forks AS VARCHAR) AS forks, CAST(open_issues_count AS VARCHAR) AS open_issues, "
        "CAST(stars_count AS VARCHAR) AS stars, CAST(watchers AS VARCHAR) AS watchers"
    ),
    "scored_repo_details_by_shuffle": f"""{_with(*SCORE_CHAIN, _details(True), SCORED)}
SELECT {DAY}, hour, repo_name, round(score, 6) AS score, languages, {FIELDS}, id FROM scored""",
    "repo_profile_of": _profile_of(_with(*USER_CHAIN, _USER_RANKS, _details(True), LATEST)),
    "stored_repo_profile_of": _profile_of(
        _with(*SCORE_CHAIN, *USER_CHAIN, TOP_USERS, _user_ranks("top_users"), _details(True), SCORED, _latest("scored"))
    ),
    "stored_latest_repo_details": f"""{_with(*SCORE_CHAIN, _details(True), SCORED, _latest("scored"))}
SELECT repo_name, {DAY}, hour, languages, {FIELDS}, id FROM latest""",
    "stored_top_repos_aggregate_week": _top_repos("aggregate", "2024-01-24"),
    "stored_top_repos_push_month": _top_repos("push", "2024-01-01"),
    "stored_repos_over": f"""{_with(_hourly(0), DAILY, TOP)}
SELECT {DAY}, repo_name, count AS value FROM top WHERE event = 'PushEvent' AND count > 2""",
    "backfill_deep_layout": STORED_COUNTS,
    "repos_over": f"""{_with(_hourly(0), DAILY)}
SELECT {DAY}, repo_name, count AS value FROM daily WHERE event = 'PushEvent' AND count > 2""",
    "repos_over_score": f"""{_with(*SCORE_CHAIN)}
SELECT {DAY}, repo_name, round(score, 6) AS value FROM scores WHERE score > 0.5000001""",
    "backfill_counts": STORED_COUNTS,
    "backfill_details": STORED_DETAILS,
    "incremental_counts": STORED_COUNTS,
    "incremental_details": STORED_DETAILS,
    "event_time_counts": EVENT_TIME,
    "event_time_upserts": f"{EV} {_BY_CREATED_AT}",
    "event_time_corrections": f"{_LATE} SELECT {DAY}, hour, event, repo_name, count, batch FROM late",
    "event_time_late_rows": f"""{_LATE}
SELECT {DAY}, hour, CAST(sum(count) AS BIGINT) AS rows, count(DISTINCT batch) AS batches
FROM late GROUP BY late.create_date, hour""",
    "broken_lines": BROKEN,
    "passed_over_deliveries": f"""{EV}
SELECT DISTINCT CAST(ev.create_date AS VARCHAR) AS create_date, hour,
       'first/hour_file=' || strftime(ev.create_date, '%Y-%m-%d') || '-' || CAST(hour AS VARCHAR) || '.json' AS delivery,
       'older delivery' AS reason
FROM ev WHERE ev.create_date <= DATE '2024-01-05' AND hour < 6""",
    "export_pending_days": EXPORT_PENDING,
}
