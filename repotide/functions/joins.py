"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Broadcast limit. Rows here are a few names and numbers, some 100 bytes.
BROADCAST_ROWS = 1_000_000
SALTS = 4


def may_broadcast(row_bound: int | None) -> bool:
    """Whether a frame with the proven upper bound ``row_bound`` of rows may be broadcast."""
    return row_bound is not None and row_bound <= BROADCAST_ROWS


def salted_join(rows: DataFrame, lookup: DataFrame, keys: list[str], spread: str, salts: int = SALTS) -> DataFrame:
    """Inner join of ``rows`` with ``lookup``, which has one row per key.

    Both meet by the keys and a salt, a hash of the column ``spread`` that tells a key's rows apart; each lookup
    row goes once to each salt. Both sides are plain exchanges, so that the skew join can split a key further
    where ``salts`` parts of it are still large. Each frame is read once.
    """
    salt = "join_salt_"
    copies = lookup.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    return salted.join(copies, [*keys, salt]).drop(salt)
