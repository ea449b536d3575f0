"""Sharding by jump consistent hashing.

A document's shard depends on its doc_id and on the number of shards, on nothing else: no table of a
ring is kept, and going from n to n + 1 shards moves one document in n + 1, always into the new shard.

Defined results: a null doc_id is a key like any other, so all of these share a shard; repeated rows
meet in one shard and get slots of their own; a null text has size 8 and the checksum of an empty one.
Columns other than doc_id and text are not read by ``place`` and kept by ``shard_documents``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.llm.common import full_text, gapless, let_workers_import, slices_for, stored, table

SHARDS = 24
#: Bytes that a document takes beside its text.
OVERHEAD = 8


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard from 0 of each key, by the published jump consistent hash."""
    state = keys.astype(np.uint64)
    shard, jump = np.zeros(len(state), np.int64), np.zeros(len(state), np.int64)
    active = np.arange(len(state))
    while len(active):
        shard[active] = jump[active]
        state[active] = state[active] * np.uint64(2862933555777941757) + np.uint64(1)
        high = (state[active] >> np.uint64(33)).astype(np.float64) + 1.0
        jump[active] = ((shard[active] + 1) * (float(1 << 31) / high)).astype(np.int64)
        active = active[jump[active] < shards]
    return shard


def shard_of(key: str, shards: int):
    """Column of the shard of each row's ``key`` column."""
    place = F.pandas_udf(lambda keys: pd.Series(jump_hash(keys.to_numpy().view(np.uint64), shards)), "int")
    return place(F.xxhash64(key))


def shard_documents(docs: DataFrame, shards: int = SHARDS, name: str = "shard") -> DataFrame:
    """``docs`` with the column ``name``; for files by shard write it with ``partitionBy(name)``."""
    return docs.withColumn(name, shard_of("doc_id", shards))


def place(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Size, checksum, shard and place of every document, and its shard if there were one more."""
    let_workers_import(docs.sparkSession)
    text = full_text()
    sized = docs.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of("doc_id", shards).alias("shard"),
        shard_of("doc_id", shards + 1).alias("grown_shard"),
    )
    sized = stored(sized, "shard-keys")
    slices = slices_for(sized.count() // shards)
    placed = gapless(sized, ["shard"], ["doc_id", "text_crc32", "size"], "slot", slices)
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place(table(spark, sf_dir, "documents"))
