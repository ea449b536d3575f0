"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes a row of statistics. Cyclic boosting visits the features in turn, fits a shallow tree (up to
three leaves) on one feature's bins to the gradient of the log loss, and adds it to that feature's lookup
table. Then the pairs of features whose tables explain most of what is left get tables of two
dimensions, boosted likewise by trees of a cut on the first feature and one on the second on each side. A score is
the sum of one number from each table, so documents are scored by vectorised look-ups.

The model is fitted in the driver on at most ``MAX_ROWS`` labelled rows, those with the least hashes of their
doc_ids; statistics are computed for all documents, once, and scores for all of them on the executors.

Defined results: null and empty texts have statistics of zero and get a score; labels that are null or of
documents that are not there are left out; repeated rows get equal scores; without labels of both kinds
every score is the share of ones, or one half. A null doc_id is not held out and never learnt from. An empty
table gives no rows. Columns other than doc_id and text, of labels doc_id and quality, are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.llm.common import full_text, let, let_workers_import, split_words, stored, table

MAX_ROWS = 40_000
#: Leading bits of the hashes by which labelled rows are counted to find those of the sample.
PREFIX_BITS = 14
BINS, ROUNDS, RATE, LEAST = 32, 120, 0.15, 20
PAIRS, PAIR_BINS, PAIR_ROUNDS = 6, 8, 40
DAMPING = 1.0


def _without(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Characters whose share of the text is a feature.
SHARES = {"upper": UPPER, "digit": "0123456789", "symbol": "#*$%&|<>", "shout": "!?", "stop": ".,;:", "bracket": "()[]{}@/\\_="}


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the features of every document."""
    own = docs.select("doc_id", full_text().alias("text"))
    chars = F.greatest(F.char_length("text"), F.lit(1))
    lines = F.filter(F.split("text", "\n"), lambda x: x != "")

    def of_words(words: Column) -> Column:
        n = F.greatest(F.size(words), F.lit(1))
        return F.struct(
            F.log1p(F.size(words)).alias("n_words"),
            (F.size(F.array_distinct(words)) / F.sqrt(n.cast("double"))).alias("variety"),
            (F.size(F.array_distinct(words)) / n).alias("distinct"),
        )

    def of_lines(parts: Column) -> Column:
        n = F.greatest(F.size(parts), F.lit(1))
        return F.struct(F.log1p(F.size(parts)).alias("n_lines"), (F.size(F.array_distinct(parts)) / n).alias("distinct_lines"))

    return own.select(
        "doc_id",
        let(split_words(F.col("text")), of_words).alias("w"),
        let(lines, of_lines).alias("l"),
        F.log1p(F.char_length("text")).alias("n_chars"),
        (F.char_length(F.translate("text", " \t\n\x0b\x0c\r", "")) / chars).alias("solid"),
        ((F.octet_length("text") - F.char_length("text")) / chars).alias("wide"),
        *[(_without(F.col("text"), c) / chars).alias(name) for name, c in SHARES.items()],
    ).select("doc_id", "w.*", "l.*", "n_chars", "solid", "wide", *SHARES)


class Model(NamedTuple):
    features: list[str]
    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    #: coarse bin of each fine bin
    coarse: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def bins(self, values: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, values[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)

    def score(self, values: np.ndarray) -> np.ndarray:
        if not len(values):
            return np.empty(0)
        bins = self.bins(values)
        total = np.full(len(values), self.base)
        for k, lookup in enumerate(self.tables):
            total += lookup[bins[:, k]]
        for (a, b), lookup in zip(self.pairs, self.pair_tables, strict=True):
            total += lookup[self.coarse[a][bins[:, a]], self.coarse[b][bins[:, b]]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + DAMPING)


def _cut(g: np.ndarray, h: np.ndarray, n: np.ndarray, least: int) -> tuple[float, int]:
    """Gain of the best cut of a row of bins in two and the first bin of the right part; no gain without one."""
    left_g, left_h, left_n = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gain = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    gain = np.where((left_n >= least) & (n.sum() - left_n >= least), gain, 0.0)
    if not len(gain) or gain.max() <= 1e-9:
        return 0.0, 0
    return float(gain.max()), int(gain.argmax()) + 1


def _leaf(g: np.ndarray, h: np.ndarray) -> float:
    return float(g.sum() / (h.sum() + DAMPING))


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, least: int) -> np.ndarray:
    """Values of a tree of up to three leaves, by bin."""
    parts = [(0, len(g))]
    for _ in range(2):
        cuts = [(*_cut(g[a:b], h[a:b], n[a:b], least), a, b) for a, b in parts]
        gain, at, a, b = max(cuts)
        if gain <= 0:
            break
        parts = [p for p in parts if p != (a, b)] + [(a, a + at), (a + at, b)]
    out = np.zeros(len(g))
    if len(parts) > 1:
        for a, b in parts:
            out[a:b] = _leaf(g[a:b], h[a:b])
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, least: int) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree of one cut on the rows and one on the columns of each side."""
    best, out = 0.0, np.zeros(g.shape)
    for at in range(1, g.shape[0]):
        sides = [slice(0, at), slice(at, None)]
        columns = [(g[s].sum(0), h[s].sum(0), n[s].sum(0)) for s in sides]
        if min(c[2].sum() for c in columns) < least:
            continue
        gain = sum(_gain(c[0].sum(), c[1].sum()) for c in columns) - _gain(g.sum(), h.sum())
        cuts = [_cut(*c, least) for c in columns]
        gain += sum(c[0] for c in cuts)
        if gain > best + 1e-9:
            best, out = float(gain), np.zeros(g.shape)
            for s, c, (own, where) in zip(sides, columns, cuts, strict=True):
                if own > 0:
                    out[s, :where], out[s, where:] = _leaf(c[0][:where], c[1][:where]), _leaf(c[0][where:], c[1][where:])
                else:
                    out[s] = _leaf(c[0], c[1])
    return best, out


def _sums(cells: np.ndarray, size: int, error: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.bincount(cells, error, size), np.bincount(cells, weight, size), np.bincount(cells, minlength=size)


def fit(features: list[str], values: np.ndarray, labels: np.ndarray) -> Model:
    """Main tables first, then those of the pairs that explain most of the rest."""
    share = float(labels.mean()) if len(labels) else 0.5
    base = float(np.log(np.clip(share, 1e-6, 1 - 1e-6) / np.clip(1 - share, 1e-6, 1 - 1e-6)))
    width = len(features)
    if not len(labels) or share in (0.0, 1.0):
        return Model(features, base, [np.empty(0)] * width, [np.zeros(1)] * width, [], [np.zeros(1, int)] * width, [])
    edges = [np.unique(np.quantile(values[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(width)]
    model = Model(features, base, edges, [np.zeros(len(e) + 1) for e in edges], [], [], [])
    bins = model.bins(values)
    total = np.full(len(labels), base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k in range(width):
            tree = RATE * _tree(*_sums(bins[:, k], len(model.tables[k]), *slopes()), LEAST)
            model.tables[k][:] += tree
            total += tree[bins[:, k]]
    coarse = [np.minimum(np.arange(len(e) + 1) * PAIR_BINS // (len(e) + 1), PAIR_BINS - 1) for e in edges]
    rough = np.stack([coarse[k][bins[:, k]] for k in range(width)], axis=1)

    def grid(a: int, b: int) -> list[np.ndarray]:
        return [x.reshape(PAIR_BINS, PAIR_BINS) for x in _sums(rough[:, a] * PAIR_BINS + rough[:, b], PAIR_BINS**2, *slopes())]

    gains = [(_pair_tree(*grid(a, b), LEAST)[0], a, b) for a in range(width) for b in range(a + 1, width)]
    pairs = [(a, b) for gain, a, b in sorted(gains, reverse=True)[:PAIRS] if gain > 0]
    lookups = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), lookup in zip(pairs, lookups, strict=True):
            tree = RATE * _pair_tree(*grid(a, b), LEAST)[1]
            lookup += tree
            total += tree[rough[:, a], rough[:, b]]
    return model._replace(pairs=pairs, coarse=coarse, pair_tables=lookups)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(features: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """The model of the labelled documents that are not held out."""
    names = [c for c in features.columns if c != "doc_id"]
    marked = labels.where("quality IS NOT NULL").select(F.col("doc_id").alias("of"), F.col("quality").cast("double").alias("label"))
    known = features.where(F.col("doc_id").isNotNull() & ~held_out()).join(marked, F.col("doc_id") == F.col("of"))
    # the highest hashes go before the sort, so that the tasks together send little more than the sample
    prefix = F.shiftright(F.xxhash64("doc_id"), 64 - PREFIX_BITS)
    last, seen = None, 0
    for row in sorted(known.groupBy(prefix.alias("prefix")).count().collect()):  # 2 ** PREFIX_BITS rows at most
        last, seen = row["prefix"], seen + row["count"]
        if seen >= max_rows:
            break
    known = known.where(prefix <= F.lit(last))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label", *names).limit(max_rows).select("label", *names).toPandas()
    return fit(names, sample[names].to_numpy(np.float64), sample["label"].to_numpy(np.float64))


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    let_workers_import(docs.sparkSession)
    features = stored(statistics(docs), "quality-features")
    model = learn(features, labels, max_rows)

    def score(rows: pd.DataFrame) -> pd.Series:
        return pd.Series(model.score(rows[model.features].to_numpy(np.float64)))

    of = F.pandas_udf(score, "double")
    scored = features.select("doc_id", held_out().alias("held_out"), of(F.struct(*model.features)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
