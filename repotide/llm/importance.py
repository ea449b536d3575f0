"""Target-distribution importance resampling with hashed word n-grams.

Arrow kernels do the text work: ``ascii_lower``, ``split_pattern_regex`` at what is no word,
``list_flatten`` and ``dictionary_encode``. Grams of n words are pairs of a gram of n - 1 words and the word
that follows, both as dictionary indices; a CRC is worked out once per distinct pair, by carrying the shorter
gram's CRC on. A gram's bucket is its CRC modulo ``BUCKETS``. The corpus and the target are counted by
bucket, each task giving one row per bucket; a bucket's gain is the log ratio of its smoothed shares. A
second pass takes the gains of a document's features, sums them by segment and adds Gumbel noise from a hash
of the doc_id, so that taking the highest scores samples without replacement.

The text is read twice and never shuffled. What goes to the driver are ``BUCKETS`` sums, the number of
documents at each score (scores are whole numbers in a range that the logarithms bound to some 100,000 values) and
the number of rows of each output part. Drawn documents are numbered in parts of a range sort, so no task holds
them all and a score that very many share is split.

Defined results: a null or empty text has no words, weight 0 and a score, and is not drawn; a text of any
length is read whole; a null doc_id hashes like an empty one and comes after all others; rows equal in doc_id
and text are documents of their own with equal scores, ranked one after the other; an empty corpus gives no rows,
an empty target gives gains that favour rare words. Equal scores are ranked by doc_id. ``rank_documents``
reads doc_id and text only; ``draw`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repotide.llm.common import let_workers_import, row_hash, stored, table

#: Buckets of the hashed features and the smoothing added to each total.
BUCKETS = 10_000
#: Words in the shortest and longest feature.
SHORTEST, LONGEST = 1, 1
SEED = 2024
#: Documents with fewer words are never drawn; of the others this share is, in percent.
LEAST_WORDS, PERCENT = 20, 10
#: Bytes that stand between words: all of ASCII but digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text that one pass of the kernels takes, unless a single text is longer.
SLICE_BYTES = 16 << 20


def word_indices(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Dictionary index of every word, place of every text's first word (and the end), dictionary."""
    # lower case first: the cast of a slice keeps its offset, and ascii_lower then takes bytes of the rows before it
    parts = pc.split_pattern_regex(pc.ascii_lower(texts).cast(pa.large_string()), pattern=BETWEEN)
    words, text_of = pc.list_flatten(parts), pc.list_parent_indices(parts)
    real = pc.not_equal(words, "")
    words, text_of = words.filter(real), text_of.filter(real)
    encoded = words.dictionary_encode()
    counts = np.bincount(text_of.to_numpy(zero_copy_only=False), minlength=len(texts))
    starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    dictionary = encoded.dictionary.cast(pa.large_binary()).to_pylist()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), starts, dictionary


def buckets_of(texts: pa.Array, shortest: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of features: their buckets in text order and where each text's start (and the end)."""
    word, starts, dictionary = word_indices(texts)
    crc = np.fromiter(map(zlib.crc32, dictionary), np.int64, len(dictionary))
    gram, gram_starts = word, starts
    for length in range(1, longest + 1):
        if length > 1:
            # a gram is followed by a word of its text unless it is the text's last
            has_next = np.ones(len(gram), bool)
            has_next[gram_starts[1:][np.diff(gram_starts) > 0] - 1] = False
            follows = np.ones(len(word), bool)
            for skipped in range(length - 1):
                at = starts[:-1] + skipped
                follows[at[at < starts[1:]]] = False
            pairs, gram = np.unique(gram[has_next] * len(dictionary) + word[follows], return_inverse=True)
            before, after = np.divmod(pairs, max(1, len(dictionary)))
            crc = np.fromiter((zlib.crc32(b" " + dictionary[w], c) for w, c in zip(after, crc[before].tolist())), np.int64, len(pairs))
            gram_starts = np.concatenate([[0], np.cumsum(np.maximum(np.diff(gram_starts) - 1, 0))])
        if length >= shortest:
            yield (crc % BUCKETS)[gram], gram_starts


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about SLICE_BYTES of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for first, last in zip(cuts, cuts[1:]):
        if last > first:
            yield batch.slice(first, last - first)


def bucket_counts(docs: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST) -> np.ndarray:
    """Number of features of all texts in each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch):
                for buckets, _ in buckets_of(part.column("text"), shortest, longest):
                    total += np.bincount(buckets, minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(used, pa.int32()), "n": pa.array(total[used], pa.int64())})

    let_workers_import(docs.sparkSession)
    sums = docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in sums.collect():  # BUCKETS rows at most
        out[bucket] = n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandfold log ratio of each bucket's smoothed share in the target and in the corpus."""
    in_corpus, in_target = float(corpus.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * in_corpus / ((s + 1.0) * in_target))) for s, t in zip(corpus.tolist(), target.tolist())],
        np.int64,
    )


def weigh(docs: DataFrame, gains: np.ndarray, shortest: int = SHORTEST, longest: int = LONGEST) -> DataFrame:
    """doc_id, text_hash, n_words, n_features and weight (floored mean of the features' gains) of every row."""

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = np.zeros(part.num_rows, np.int64)
                features, sums = words.copy(), words.copy()
                for length, (buckets, starts) in enumerate(buckets_of(part.column("text"), 1, longest), 1):
                    if length == 1:
                        words = np.diff(starts)
                    if length >= shortest:
                        running = np.concatenate([[0], np.cumsum(gains[buckets])])
                        features += np.diff(starts)
                        sums += running[starts[1:]] - running[starts[:-1]]
                weight = np.floor_divide(sums, np.maximum(features, 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), *map(pa.array, (words, features, weight))],
                    names=["doc_id", "text_hash", "n_words", "n_features", "weight"],
                )

    let_workers_import(docs.sparkSession)
    rows = docs.select("doc_id", row_hash("text").alias("text_hash"), "text")
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_hash long, n_words long, n_features long, weight long"
    return rows.mapInArrow(weights, schema)


def gumbel(doc_id: str = "doc_id", seed: int = SEED):
    """Noise of a document, in thousandths: the same in every run, whatever the other rows are."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` stored with ``name``, its rows' numbers from 1 in ``order``, without bringing them together.

    Rows are sorted in ranges, and each range starts where the ones before it end.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # Spark's id holds the partition in the upper 31 bits and the row's place in the lower 33
    spread = stored(spread.withColumn("place", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("place", 33)
    sizes = spread.groupBy(part.alias("part")).count().collect()  # one row per shuffle partition
    starts, before = [], 0
    for row in sorted(sizes):
        starts.append((row["part"], before))
        before += row["count"]
    starts = spark.createDataFrame(starts, "part long, before long")
    inside = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        spread.withColumn("part", part)
        .join(F.broadcast(starts), "part")
        .withColumn(name, F.col("before") + inside + 1)
        .drop("part", "place", "before")
    )


def rank_documents(
    docs: DataFrame, target: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, percent: int = PERCENT
) -> DataFrame:
    """doc_id, text_hash, n_words, n_features, weight, score and rank of every row; ``rank`` is null if not drawn."""
    gains = bucket_gains(bucket_counts(docs, shortest, longest), bucket_counts(target, shortest, longest))
    scored = weigh(docs, gains, shortest, longest).withColumn("score", (F.col("weight") + gumbel()).cast("long"))
    scored = stored(scored, "importance-scores")
    may_draw = F.col("n_words") >= LEAST_WORDS
    at_score = scored.where(may_draw).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    wanted = percent * (at_score.agg(F.sum("n")).first()[0] or 0) // 100
    # one row per score: the lowest of which a document is drawn
    above = F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1))
    lowest = at_score.withColumn("above", F.coalesce(above, F.lit(0))).where(F.col("above") < wanted).agg(F.min("score")).first()[0]
    unranked = F.lit(None).cast("long").alias("rank")
    if lowest is None:
        return scored.select("*", unranked)
    near = may_draw & (F.col("score") >= lowest)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), "text_hash"]
    first = numbered(scored.where(near), order, "rank")
    first = first.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return first.unionByName(scored.where(~near).select("*", unranked))


def draw(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The drawn rows of ``docs``, all columns kept; rows equal in doc_id and text are drawn together."""
    drawn = rank_documents(docs, target, **settings).where(F.col("rank").isNotNull())
    keys = drawn.select(F.col("doc_id").alias("drawn_id_"), F.col("text_hash").alias("drawn_hash_")).distinct()
    same = docs["doc_id"].eqNullSafe(keys["drawn_id_"]) & (F.xxhash64(docs["text"]) == keys["drawn_hash_"])
    return docs.join(keys, same, "left_semi")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


#: CRC-32 by its table, for distinct words only.
OP11_SQL = r"""
WITH RECURSIVE steps AS (
    SELECT range AS byte, CAST(range AS UBIGINT) AS value, 0 AS step FROM range(256)
    UNION ALL
    SELECT byte, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384::UBIGINT) ELSE value >> 1 END, step + 1
    FROM steps WHERE step < 8),
crc_table AS (SELECT list(value ORDER BY byte) AS t FROM steps WHERE step = 8),
texts AS (
    SELECT 'd' AS side, doc_id, text FROM documents
    UNION ALL SELECT 'b', item_id, text FROM benchmark),
split AS (
    SELECT side, doc_id, list_filter(
        regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
        lambda w: w <> '') AS words
    FROM texts),
occurrences AS (SELECT side, doc_id, unnest(words) AS word FROM split),
counted AS (SELECT side, doc_id, word, count(*) AS n FROM occurrences GROUP BY ALL),
vocabulary AS (SELECT DISTINCT word FROM counted),
hashed AS (
    SELECT word, xor(list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(range(1, octet_length(encode(word)) + 1),
            lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i - 1, 2) AS UBIGINT))),
        lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295::UBIGINT) % 10000 AS bucket
    FROM vocabulary, crc_table),
features AS (SELECT side, doc_id, bucket, n FROM counted JOIN hashed USING (word)),
sums AS (
    SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t
    FROM features GROUP BY bucket),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln(
        (t + 1)::DOUBLE * ((SELECT sum(s) FROM sums) + 10000)::DOUBLE
        / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM sums) + 10000)::DOUBLE))) AS BIGINT) AS gain
    FROM sums),
weights AS (
    SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight
    FROM features JOIN gains USING (bucket) WHERE side = 'd' GROUP BY doc_id),
scored AS (
    SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
               (CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE)
               / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM documents LEFT JOIN weights USING (doc_id)),
ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS eligible
    FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * eligible // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""
