"""Hard negatives by Fagin's threshold algorithm.

Every ``ANCHOR_EVERY``-th row is an anchor. Its positives are the rows of its label with the highest integer
inner products; its negatives, for each positive, the highest rows of other labels whose product lies in a
window below the positive's.

Rows are dealt into shards of about ``SHARD_ROWS`` and anchors into blocks of ``BLOCK_ANCHORS``; a task takes
one shard and one block. There each dimension has a list of the shard's rows sorted by that component. An
anchor reads the lists from the top where its component is positive and from the bottom where it is negative,
all to the same depth. Rows met are scored by random access with their whole integer product. The product of
the anchor with the components last read bounds that of every row not met yet; once it lies strictly below the
k-th score of every window (its lower end while it is not full), the rest cannot matter. In many dimensions
that may come late, so depth doubles from round to round, and an anchor stops too when it has met all rows.
A shard gives k rows a window at most, and the shards' rows are merged by a top-k per window.

The anchors are a stated query set against all rows, so the work grows with both; each task's memory is
bounded by its shard and block, and no anchor or label has a task of its own. A product of an anchor and a
row is exact: doubles while all sums stay below 2 to the 53rd, else whole numbers of any size; a score beyond
64 bits counts as the nearest 64-bit number.

Defined results: rows with a null vec_id, label or vector, or a null or non-finite component, take no part;
shorter vectors count as filled up with zeros; rows equal in vec_id, label and vector are one row, others of one
vec_id are rows of their own but no partners of each other; equal scores are ordered by vec_id; an anchor without
positives or without rows in its window has no results; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.functions.ranking import with_rank
from repotide.llm.common import let_workers_import, stored, table

ANCHOR_EVERY, RELABEL_EVERY, LABELS = 100, 7, 10
#: Positives of an anchor, negatives of a positive.
POSITIVES, NEGATIVES = 5, 5
#: A negative's score lies between this share of the positive's, in percent, and the positive's.
LOWEST_PERCENT = 80
#: Whole numbers for each unit of a component.
SCALE = 256
SHARD_ROWS, BLOCK_ANCHORS = 4096, 2048
#: Rows read from every list in the first round.
FIRST_DEPTH = 16
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def whole_components(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of floor(SCALE * component), short ones filled with zeros: doubles, or objects if they are very large."""
    lists = vectors.combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    parts = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(lists), width))
    row = np.repeat(np.arange(len(lists)), lengths)
    starts = np.cumsum(lengths) - lengths
    out[row, np.arange(len(parts)) - np.repeat(starts, lengths)] = parts
    return out


def exact(rows: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles if every sum of products is exact so, else as whole numbers of any size."""
    most = (abs(rows).max(initial=0) * abs(anchors).max(initial=0)) * max(1, rows.shape[1])
    if most < 2.0**53:
        return rows, anchors
    return tuple(np.frompyfunc(int, 1, 1)(x) for x in (rows, anchors))


def _in_64_bits(scores: np.ndarray) -> np.ndarray:
    return np.clip(scores, _LEAST, _MOST) if scores.dtype == object else scores


@dataclass
class Window:
    """The best rows met with scores from ``low`` to ``high``: score descending, then id."""

    low: int
    high: int
    k: int
    scores: np.ndarray
    ids: np.ndarray

    @staticmethod
    def empty(low: int, high: int, k: int) -> Window:
        return Window(low, high, k, np.empty(0), np.empty(0, np.int64))

    def add(self, scores: np.ndarray, ids: np.ndarray, repeats: bool) -> None:
        fits = (scores >= self.floor) & (scores <= self.high)
        scores, ids = scores[fits], ids[fits]
        if not len(scores):
            return
        if len(scores) > self.k and not repeats:
            good = scores >= np.partition(scores, -self.k)[-self.k]
            scores, ids = scores[good], ids[good]
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))
        if repeats:  # equal rows count once
            same = (np.diff(scores[order], prepend=np.nan) == 0) & (np.diff(ids[order], prepend=0) == 0)
            same[0] = False
            order = order[~same]
        self.scores, self.ids = scores[order[: self.k]], ids[order[: self.k]]

    @property
    def floor(self) -> float:
        """A row below this score changes nothing."""
        return self.scores[-1] if len(self.scores) == self.k else self.low


class SortedLists:
    """Rows with, for each dimension, their order by that component."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray):
        self.rows, self.ids = rows, ids
        self.order = np.argsort(rows, axis=0, kind="stable")
        self.sorted = np.take_along_axis(rows, self.order, axis=0)
        self.repeats = len(np.unique(ids)) < len(ids)

    def search(self, anchor: np.ndarray, partners: np.ndarray, windows: list[Window]) -> None:
        """Fills the windows with the best of the rows marked in ``partners``."""
        n = len(self.rows)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        met = np.zeros(n, bool) if len(up) + len(down) else np.ones(n, bool)
        if met.all():  # all products are zero
            self._score(np.flatnonzero(partners), anchor, windows)
            return
        depth, before = min(FIRST_DEPTH, n), 0
        while True:
            now = np.zeros(n, bool)
            now[self.order[n - depth : n - before, up].ravel()] = True
            now[self.order[before:depth, down].ravel()] = True
            now &= ~met
            met |= now
            self._score(np.flatnonzero(now & partners), anchor, windows)
            bound = (self.sorted[n - depth, up] * anchor[up]).sum() + (self.sorted[depth - 1, down] * anchor[down]).sum()
            bound = _in_64_bits(np.array([bound]))[0]
            if depth == n or all(bound < w.floor for w in windows) or met.all():
                return
            before, depth = depth, min(2 * depth, n)

    def _score(self, at: np.ndarray, anchor: np.ndarray, windows: list[Window]) -> None:
        scores, ids = _in_64_bits(self.rows[at] @ anchor), self.ids[at]
        for window in windows:
            window.add(scores, ids, self.repeats)


def _loaded(rows: pa.Table, anchors: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    lengths = [x.column("vec").combine_chunks().value_lengths().to_numpy(zero_copy_only=False) for x in (rows, anchors)]
    width = int(max((x.max(initial=0) for x in lengths), default=0))
    x, a = exact(*(whole_components(t.column("vec"), width) for t in (rows, anchors)))
    return x, a, rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()


def _long(values) -> pa.Array:
    return pa.array([int(v) for v in values], pa.int64())


def _positives(k: int):
    def of_shard(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = {"anchor": [], "positive_score": [], "positive_id": []}
        if rows.num_rows and anchors.num_rows:
            x, a, ids, labels = _loaded(rows, anchors)
            lists = {}
            for vector, key, own, label in zip(a, *(anchors.column(c).to_pylist() for c in ("anchor", "vec_id", "label"))):
                if label not in lists:
                    at = np.flatnonzero(labels == label)
                    lists[label] = SortedLists(x[at], ids[at])
                if len(lists[label].ids):
                    window = Window.empty(-np.inf, np.inf, k)
                    lists[label].search(vector, lists[label].ids != own, [window])
                    found["anchor"] += [key] * len(window.ids)
                    found["positive_score"] += window.scores.tolist()
                    found["positive_id"] += window.ids.tolist()
        return pa.table({name: _long(values) for name, values in found.items()})

    return of_shard


def _negatives(k: int, lowest: int):
    def of_shard(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = {"anchor": [], "positive_score": [], "negative_score": [], "negative_id": []}
        if rows.num_rows and anchors.num_rows:
            x, a, ids, labels = _loaded(rows, anchors)
            lists = SortedLists(x, ids)
            for vector, key, own, label, scores in zip(a, *(anchors.column(c).to_pylist() for c in ("anchor", "vec_id", "label", "scores"))):
                windows = [Window.empty(-(-lowest * p // 100), p, k) for p in scores if -(-lowest * p // 100) <= p]
                if windows:
                    lists.search(vector, (labels != label) & (ids != own), windows)
                for window in windows:
                    found["anchor"] += [key] * len(window.ids)
                    found["positive_score"] += [window.high] * len(window.ids)
                    found["negative_score"] += window.scores.tolist()
                    found["negative_id"] += window.ids.tolist()
        return pa.table({name: _long(values) for name, values in found.items()})

    return of_shard


def usable(rows: DataFrame, relabel_every: int = RELABEL_EVERY, labels: int = LABELS) -> DataFrame:
    """vec_id, label, vec and row of the rows that take part, with the labels changed where asked."""
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % relabel_every == 0, (label + 1) % labels).otherwise(label)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        label.alias("label"),
        F.col("embedding").alias("vec"),
        F.monotonically_increasing_id().alias("row"),
    )


def _met(rows: DataFrame, anchors: DataFrame, shards: int, blocks: int, of_shard, schema: str) -> DataFrame:
    """Every block of anchors with every shard of rows."""
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = anchors.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    return dealt.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(of_shard, schema)


def mine(
    embeddings: DataFrame,
    anchor_every: int = ANCHOR_EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest_percent: int = LOWEST_PERCENT,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score."""
    let_workers_import(embeddings.sparkSession)
    rows = stored(usable(embeddings), "vectors")
    anchors = rows.where(F.col("vec_id") % anchor_every == 0).groupBy("vec_id", "label", "vec").agg(F.min("row").alias("anchor"))
    anchors = stored(anchors, "anchors")
    shards, blocks = -(-max(1, rows.count()) // SHARD_ROWS), -(-max(1, anchors.count()) // BLOCK_ANCHORS)
    found = _met(rows, anchors, shards, blocks, _positives(positives), "anchor long, positive_score long, positive_id long")
    near = with_rank(found.distinct(), ["anchor"], [F.desc("positive_score"), F.asc("positive_id")], positives).drop("rank")
    near = stored(near, "positives")
    scores = near.groupBy("anchor").agg(F.collect_set("positive_score").alias("scores"))  # ``positives`` rows each
    schema = "anchor long, positive_score long, negative_score long, negative_id long"
    found = _met(rows, anchors.join(scores, "anchor"), shards, blocks, _negatives(negatives, lowest_percent), schema)
    order = [F.desc("negative_score"), F.asc("negative_id")]
    hard = with_rank(found.distinct(), ["anchor", "positive_score"], order, negatives)
    names = anchors.select("anchor", F.col("vec_id").alias("anchor_id"))
    return (
        near.join(hard, ["anchor", "positive_score"])
        .join(names, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "embeddings"))


OP13_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
