"""The newest details of every repository, kept up to date instead of searched in the whole history.

The table ``repo_latest`` has a row for each repository that was ever scored, at most some 150 a day, by a hash of
the name. When the details of some days are replaced, a repository's newest row is

- the newest of these days, if that is no older than the row stored so far;
- the stored row, if it is of another day and newer;
- else, where a repository has lost the day of its stored row, the newest of the other days, for which the history
  is read, for these repositories alone.

The table is small, so it is written as a whole. Nothing is sorted to answer a question, and one for some names reads
the buckets of these names only.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from repotide.functions.calendar import days_scope
from repotide.functions.joins import may_broadcast
from repotide.functions.naming import name_bucket
from repotide.operators.daily import stack
from repotide.operators.details import newest_details
from repotide.schemas import TABLES
from repotide.sources.tables import TableStore


def refresh_latest(store: TableStore, days: set[date], name_rows: int | None = None) -> None:
    """Follows the details of ``days``, which have just been replaced.

    ``name_rows`` is a proven bound of the repositories scored on these days, which decides on broadcasting their
    names. Doing it again changes nothing.
    """
    store.create("repo_latest")
    whole = days_scope(days)
    kept = [c for c in TABLES["repo_latest"].schema.fieldNames() if c != "bucket"]
    stored, details = store.read("repo_latest"), store.read("repo_details", whole, days)
    # a repository whose stored row's day has no details of it any more falls back to an older one
    now = details.select("repo_name", "create_date")
    now = F.broadcast(now.distinct()) if may_broadcast(name_rows) else now
    fallen = stored.where(whole).join(now, ["repo_name", "create_date"], "left_anti").select("repo_name")
    frames = [details.select(*kept), stored.where(~whole).select(*kept)]
    if not fallen.isEmpty():
        history = store.read("repo_details", ~whole).select(*kept)
        fallen = F.broadcast(fallen) if may_broadcast(name_rows) else fallen
        frames.append(history.join(fallen, "repo_name", "left_semi"))
    rows = newest_details(stack(*frames)).withColumn("bucket", name_bucket(F.col("repo_name")))
    store.replace("repo_latest", rows, F.lit(True))
