"""SimHash near-duplicates by the general pigeonhole principle.

Fingerprints of 64 bits are linked where at most ``DISTANCE`` bits differ. The bits are divided into
partitions that hold correlated bits together; each partition has a threshold of its own, and the
thresholds and the number of partitions add up so that two linked fingerprints agree within the threshold
in one partition at least. How the thresholds are dealt out is found by dynamic programming on the
candidates and probes that each would cost, estimated from counts over all fingerprints (4,096 counts of bits
that are set together and 256 for each byte; no fingerprint goes to the driver). Whatever is chosen, the
links are the same.

Equal fingerprints are one node. A node's values within the threshold in a partition are looked up among
all nodes' values there; the bit distance is part of the join's condition, and a pair that several
partitions would find is emitted by the first, so the join emits each link once and nothing else.

Defined results: a null or empty text has fingerprint zero, and such texts are linked like any others;
rows of one doc_id each get a row, and a null doc_id is never a component's id unless no other is there;
an empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, repeat
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from repotide.llm.common import full_text, let_workers_import, row_hash, stored, table
from repotide.llm.components import components

SHINGLE, DISTANCE, SEED = 3, 3, 42
#: Partitions of the 64 bits. Two of 32 bits keep the candidates of 10^10 fingerprints to hundreds each.
PARTITIONS = 2
#: What making and shuffling one probe costs, in comparisons of two fingerprints.
PROBE_COST = 20.0


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = text.encode("utf-8").lower().split()  # of bytes: lower-cases A-Z only, splits at ASCII blanks
    if not words:
        return 0
    if len(words) < shingle:
        joined: Iterator[bytes] = iter([b" ".join(words)])
        n = 1
    else:
        joined = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
        n = len(words) - shingle + 1
    hashes = np.fromiter(map(xxh64_intdigest, joined, repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, 65_536):
        ones += np.unpackbits(hashes[start : start + 65_536].view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, the row's hash and the fingerprint as a signed long."""

    def make(texts: pd.Series) -> pd.Series:
        values = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(values.view(np.int64))

    of = F.pandas_udf(make, "long")
    return docs.select("doc_id", row_hash("text").alias("row_hash"), of(full_text()).alias("fp"))


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(values).view(np.uint8), bitorder="little").reshape(-1, 64)


def _together(nodes: DataFrame) -> np.ndarray:
    """How often each two bits are set in one fingerprint; the diagonal has the single counts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((64, 64))
        for batch in batches:
            bits = _bits(batch["fp"].to_numpy()).astype(np.float64)
            total += bits.T @ bits
        yield pd.DataFrame({"cell": np.arange(4096), "n": total.ravel().astype(np.int64)})

    cells = nodes.select("fp").mapInPandas(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(4096)
    for row in cells.collect():  # 4,096 rows
        out[row["cell"]] = row["n"]
    return out.reshape(64, 64)


def _partition(together: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size; each starts with the strongest pair left and grows by correlation."""
    share = together / max(n, 1)
    single = np.diag(share)
    spread = np.sqrt(np.maximum(np.outer(single * (1 - single), single * (1 - single)), 1e-12))
    tie = np.abs(share - np.outer(single, single)) / spread
    np.fill_diagonal(tie, 0.0)
    free, groups = list(range(64)), []
    for k in range(parts):
        size = -(-len(free) // (parts - k))
        inside = tie[np.ix_(free, free)]
        group = [free[int(np.argmax(inside.max(axis=1)))]]
        while len(group) < size:
            rest = [b for b in free if b not in group]
            group.append(rest[int(np.argmax(tie[np.ix_(rest, group)].mean(axis=1)))])
        free = [b for b in free if b not in group]
        groups.append(sorted(group))
    return groups


def _byte_counts(nodes: DataFrame, groups: list[list[int]]) -> list[list[np.ndarray]]:
    """For each partition, the counts of the values of each eight of its bits."""
    eights = [(k, g[i : i + 8]) for k, g in enumerate(groups) for i in range(0, len(g), 8)]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(eights), 256), np.int64)
        for batch in batches:
            bits = _bits(batch["fp"].to_numpy())
            for e, (_, chosen) in enumerate(eights):
                values = bits[:, chosen] @ (1 << np.arange(len(chosen)))
                total[e] += np.bincount(values, minlength=256)
        yield pd.DataFrame({"cell": np.arange(total.size), "n": total.ravel()})

    cells = nodes.select("fp").mapInPandas(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(len(eights) * 256)
    for row in cells.collect():  # 256 rows for each eight bits
        out[row["cell"]] = row["n"]
    counts = out.reshape(len(eights), 256)
    return [[counts[e] for e, (of, _) in enumerate(eights) if of == k] for k in range(len(groups))]


def _pair_shares(counts: list[np.ndarray], most: int) -> np.ndarray:
    """Share of all pairs that differ in 0, 1, ..., ``most`` bits of a partition, its eights taken as independent."""
    apart = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])
    shares = np.array([1.0])
    for c in counts:
        p = c / max(c.sum(), 1)
        weight = np.outer(p, p)
        shares = np.convolve(shares, [weight[apart == d].sum() for d in range(9)])
    return np.cumsum(shares)[: most + 1]


def allocate(counts: list[list[np.ndarray]], widths: list[int], n: int, distance: int = DISTANCE) -> list[int]:
    """A threshold from -1 (not probed) for each partition, adding up to ``distance`` - partitions + 1, at least cost."""
    cost = []
    for own, width in zip(counts, widths, strict=True):
        pairs = _pair_shares(own, distance) * n * n / 2
        probes = [n * sum(comb(width, d) for d in range(t + 1)) for t in range(distance + 1)]
        cost.append([0.0] + [float(pairs[min(t, len(pairs) - 1)] + PROBE_COST * probes[t]) for t in range(distance + 1)])
    # best[r]: least cost of the partitions so far, which have taken r of the distance + 1 (threshold + 1 each)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in cost:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for taken, (so_far, chosen) in best.items():
            for more, c in enumerate(own):
                at = taken + more
                if at <= distance + 1 and (at not in nxt or so_far + c < nxt[at][0]):
                    nxt[at] = (so_far + c, [*chosen, more - 1])
        best = nxt
    return best[distance + 1][1]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def links(nodes: DataFrame, distance: int = DISTANCE, parts: int = PARTITIONS) -> DataFrame:
    """``a`` < ``b`` for all pairs of distinct fingerprints ``fp`` of ``nodes`` at most ``distance`` bits apart."""
    n = nodes.count()
    groups = _partition(_together(nodes), n, parts)
    thresholds = allocate(_byte_counts(nodes, groups), [len(g) for g in groups], n, distance)
    masks = [sum(1 << b for b in g) for g in groups]
    apart = F.col("a").bitwiseXOR(F.col("b"))
    found, earlier = [], []
    for bits, mask, threshold in zip(groups, masks, thresholds, strict=True):
        if threshold < 0:
            continue
        flips = [_signed(sum(1 << b for b in c)) for t in range(threshold + 1) for c in combinations(bits, t)]
        key = F.col("fp").bitwiseAND(F.lit(_signed(mask)))
        index = nodes.select(F.col("fp").alias("b"), key.alias("value"))
        probes = nodes.select(F.col("fp").alias("a"), key.alias("own")).select(
            "a", F.explode(F.transform(F.array(*[F.lit(f) for f in flips]), lambda f: F.col("own").bitwiseXOR(f))).alias("probe")
        )
        near = (F.col("a") < F.col("b")) & (F.bit_count(apart) <= distance)
        for other, limit in earlier:
            near &= F.bit_count(apart.bitwiseAND(F.lit(_signed(other)))) > limit
        found.append(probes.join(index, (F.col("probe") == F.col("value")) & near).select("a", "b"))
        earlier.append((mask, threshold))
    return reduce(DataFrame.union, found)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, parts: int = PARTITIONS) -> DataFrame:
    """doc_id, row_hash, fingerprint, component_id (the smallest doc_id that the document reaches) and component."""
    let_workers_import(docs.sparkSession)
    marked = stored(fingerprints(docs, shingle), "fingerprints")
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-nodes")
    linked = components(links(nodes, distance, parts))
    joined = nodes.join(linked, F.col("fp") == F.col("node"), "left")
    joined = joined.select("fp", "first", F.coalesce("component", "fp").alias("component"))
    roots = joined.groupBy("component").agg(F.min("first").alias("component_id"))
    named = joined.join(roots, "component").select(F.col("fp").alias("of"), "component_id", "component")
    return marked.join(named, F.col("fp") == F.col("of")).select(
        "doc_id", "row_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component"
    )


def keep_first(docs: DataFrame, **settings) -> DataFrame:
    """One document of each component, that of the smallest doc_id, with all its columns.

    A null doc_id stays only where the component has no other. Of equal rows one stays.
    """
    chosen = near_duplicates(docs, **settings).groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fingerprint", "row_hash")).alias("kept")
    )
    chosen = chosen.select(F.col("kept.doc_id").alias("kept_id"), F.col("kept.row_hash").alias("kept_hash"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), row_hash("text").alias("own_hash"))
    same = F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_hash") == F.col("kept_hash"))
    return rows.join(chosen, same, "left_semi").dropDuplicates(["own_id", "own_hash"]).select("row.*")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("row_hash", "component")
