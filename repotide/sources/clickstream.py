"""Adapter: a generic click-stream table, read as repository events.

The table has ``event_id, ts, user_id, event_type, value, props`` with ``props`` such as
``{"k": 7}``. Repositories and their details are derived from these, so that the operators have
something deterministic to work on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.functions.naming import hour_file_name
from repotide.schemas import FORK, PULL_REQUEST, PUSH, WATCH

CLICKSTREAM_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)

# The archive type each click-stream type stands for.
EVENT_TYPES = {
    "click": PUSH,
    "view": WATCH,
    "signup": FORK,
    "purchase": PULL_REQUEST,
    "error": "IssuesEvent",
}


def read_clickstream(
    spark: SparkSession, sf_dir: str, repos: int | None = None, users: int | None = None
) -> DataFrame:
    """Events of ``<sf_dir>/events.parquet`` as flat repository events.

    ``repos`` and ``users`` fold the repositories and users into that many. Every 11th pull request
    has no head repository and every 13th names no repository, as happens in archives.
    """
    raw = spark.read.schema(CLICKSTREAM_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    k = "from_json(props, 'k bigint').k"
    cases = " ".join(f"when '{theirs}' then '{ours}'" for theirs, ours in EVENT_TYPES.items())
    return raw.selectExpr(
        "cast(ts as date) as create_date",
        "hour(ts) as hour",
        f"case event_type {cases} end as event",
        f"""if(event_type = 'purchase' and event_id % 13 = 0, null,
               concat('repo_', {k if repos is None else f'{k} % {repos}'})) as repo_name""",
        f"concat('user_', {'user_id' if users is None else f'user_id % {users}'}) as user_name",
        "cast(concat(cast(ts as string), 'Z') as timestamp) as created_at",  # UTC in any session
        "cast(event_id as string) as id",
        """if(event_type = 'purchase' and event_id % 11 != 0, named_struct(
               'language', case event_id % 4 when 0 then 'Python' when 1 then 'Go' when 2 then 'Scala' end,
               'open_issues_count', event_id % 7,
               'forks', floor(value),
               'has_wiki', event_id % 2 = 0,
               'stars_count', event_id % 1000,
               'watchers', event_id % 500), null) as head_repo""",
    )


def write_landing(events: DataFrame, landing: str, compressed: bool = False) -> None:
    """Writes flat events as archive JSON, one folder per hour named like the hour's file.

    An hour's rows are gathered into few part files; one that is too large for a task is split.
    """
    head = F.col("head_repo")
    head_json = F.struct(
        head["language"].alias("language"),
        head["open_issues_count"].alias("open_issues_count"),
        head["forks"].alias("forks"),
        head["has_wiki"].alias("has_wiki"),
        head["stars_count"].alias("stargazers_count"),
        head["watchers"].alias("watchers_count"),
    )
    payload = F.struct(F.when(head.isNotNull(), head_json).alias("repo"))
    for name in ("head", "pull_request"):
        payload = F.struct(payload.alias(name))
    line = F.to_json(
        F.struct(
            "id",
            F.col("event").alias("type"),
            "created_at",
            F.struct(F.col("user_name").alias("login")).alias("actor"),
            F.struct(F.col("repo_name").alias("name")).alias("repo"),
            payload.alias("payload"),
        )
    )
    hour_file = hour_file_name(F.col("create_date"), F.col("hour")).alias("hour_file")
    (
        events.select(line.alias("value"), hour_file)
        .hint("rebalance", "hour_file")
        .write.mode("append")
        .partitionBy("hour_file")
        .option("compression", "gzip" if compressed else "none")
        .text(landing)
    )
