"""Line dedup: winnowing over line hashes.

Lines are compared without outer blanks; lines without a word are passed over. In every document the
smallest hash of each ``WINDOW`` neighbouring lines is selected as a fingerprint, so any run of ``WINDOW``
lines that two places share has a fingerprint in common; a line of ``LONG`` words is one by itself.
Fingerprints are counted over the corpus, and those found once end there. The positions of the others are
joined back and extended both ways to all runs of ``WINDOW`` lines around them. Runs that agree in all
lines meet by hash, and all but the first, by doc_id and position, are deleted. Longer repeats are
overlapping runs. So what goes is exactly: every line in a run of ``WINDOW`` lines with ``MIN_WORDS`` words
that stands earlier too, and every line of ``LONG`` words that does.

Only counts per hash and first places meet, both aggregated in part before the shuffle, so a line that is
in a third of all documents costs a row per task there; the join of its later places is one that Spark
splits. Whole texts are moved once, to meet the numbers of their lost lines.

Defined results: the first place keeps a run, also within one document; rows with the same doc_id and text
lose the same lines, and a null doc_id counts as later than all others. A null text stays null; a text may
become empty, and an empty one stays so. All columns are kept; columns other than doc_id and text are not
read, but n_chars, where there is one, follows the text. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.llm.common import BLANKS, let, row_hash, split_words, stored, table

#: Lines of a run and words that it needs.
WINDOW, MIN_WORDS = 2, 8
#: Words that make a single line a run.
LONG = 12


def _lines(text: Column) -> Column:
    """Lines with a word: hash, number of words, and the line's place in the text."""
    every = F.transform(
        F.split(text, "\n"),
        lambda line, i: F.struct(
            F.xxhash64(F.trim(F.translate(line, BLANKS, " " * len(BLANKS)))).alias("h"),
            F.size(split_words(line)).alias("n"),
            i.alias("at"),
        ),
    )
    return F.filter(every, lambda x: x["n"] > 0)


def _run(lines: Column, start: Column, length: int) -> Column:
    part = F.slice(lines, start + 1, F.lit(length))
    return let(
        part,
        lambda x: F.struct(
            F.xxhash64(F.transform(x, lambda y: y["h"])).alias("run"),
            F.aggregate(x, F.lit(0), lambda total, y: total + y["n"]).alias("n"),
            F.transform(x, lambda y: y["at"]).alias("at"),
        ),
    )


def _marks(lines: Column, window: int, min_words: int, long: int) -> Column:
    """Fingerprints, each with the runs around it that are long enough."""

    def minima(x: Column) -> Column:
        starts = F.when(F.size(x) >= window, F.sequence(F.lit(0), F.size(x) - window)).otherwise(F.array().cast("array<int>"))
        least = F.transform(
            starts,
            lambda s: F.array_min(
                F.transform(F.slice(x, s + 1, F.lit(window)), lambda y, k: F.struct(y["h"].alias("h"), (-(s + k)).alias("i")))
            )["i"],
        )
        return F.array_distinct(least)

    def around(x: Column, i: Column) -> Column:
        starts = F.sequence(F.greatest(i - (window - 1), F.lit(0)), F.least(i, F.size(x) - window))
        return F.filter(F.transform(starts, lambda s: _run(x, s, window)), lambda r: r["n"] >= min_words)

    def of(x: Column) -> Column:
        winnowed = F.transform(
            minima(x), lambda i: F.struct(F.get(x, -i)["h"].alias("mark"), around(x, -i).alias("runs"))
        )
        longs = F.filter(x, lambda y: y["n"] >= long)
        alone = F.transform(
            longs,
            lambda y: F.struct(
                y["h"].alias("mark"),
                F.array(F.struct(F.xxhash64(F.array(y["h"])).alias("run"), y["n"].alias("n"), F.array(y["at"]).alias("at"))).alias("runs"),
            ),
        )
        return F.concat(winnowed, alone)

    return let(lines, of)


def repeated_lines(docs: DataFrame, window: int = WINDOW, min_words: int = MIN_WORDS, long: int = LONG) -> DataFrame:
    """doc_id, row_hash and the places ``gone`` of the lines to delete, for documents that have any."""
    marks = docs.select(
        "doc_id", row_hash("text").alias("row_hash"), F.explode(_marks(_lines(F.col("text")), window, min_words, long)).alias("m")
    ).select("doc_id", "row_hash", "m.mark", "m.runs")
    marks = stored(marks.where(F.size("runs") > 0), "line-fingerprints")
    shared = marks.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("mark").alias("shared"))
    anchors = marks.join(shared, F.col("mark") == F.col("shared"), "left_semi")
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row_hash", F.get("r.at", F.lit(0)).alias("at"))
    runs = anchors.select("doc_id", "row_hash", F.explode("runs").alias("r"))
    runs = stored(runs.select("doc_id", "row_hash", "r.run", "r.at", place.alias("place")), "line-runs")
    repeated = runs.groupBy("run").agg(F.min("place").alias("keeps"), F.max("place").alias("last")).where("keeps < last")
    repeated = repeated.select(F.col("run").alias("of"), "keeps")
    later = runs.join(repeated, F.col("run") == F.col("of")).where("place > keeps")
    return later.groupBy("doc_id", "row_hash").agg(F.array_distinct(F.flatten(F.collect_set("at"))).alias("gone"))


def _marked(docs: DataFrame, **settings) -> DataFrame:
    """The documents as ``row`` with the places ``gone`` of their lost lines, null where none is lost."""
    lost = repeated_lines(docs, **settings).select(F.col("doc_id").alias("lost_id"), F.col("row_hash").alias("lost_hash"), "gone")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), row_hash("text").alias("own_hash"))
    same = F.col("own_id").eqNullSafe(F.col("lost_id")) & (F.col("own_hash") == F.col("lost_hash"))
    return rows.join(lost, same, "left").select("row", "gone")


def _rest() -> Column:
    """The text without its lost lines."""
    text = F.col("row.text")
    left = F.array_except(F.sequence(F.lit(0), F.size(F.split(text, "\n")) - 1), F.col("gone"))
    kept = let(F.split(text, "\n"), lambda lines: F.transform(left, lambda i: F.get(lines, i)))
    return F.when(F.col("gone").isNull(), text).otherwise(F.array_join(kept, "\n"))


def drop_repeated_lines(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` without the later runs of repeated lines."""
    row = F.col("row").withField("text", _rest())
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        row = row.withField("n_chars", F.when(F.col("gone").isNull(), F.col("row.n_chars")).otherwise(F.char_length(_rest()).cast(kind)))
    return _marked(docs, **settings).select(row.alias("row")).select("row.*")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the number of lines that go and a digest of what stays."""
    marked = _marked(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return marked.select(
        "row.doc_id",
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.sha2(F.coalesce(_rest(), F.lit("")), 256).alias("kept_sha256"),
    )


OP3_SQL = r"""
WITH split AS (
  SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, i - 1 AS pos, trim(translate(parts[i], chr(9) || chr(11) || chr(12) || chr(13), '    ')) AS line,
    len(regexp_extract_all(parts[i], '[^\x20\x09-\x0D]+')) AS n
  FROM split, unnest(range(1, len(parts) + 1)) AS r(i)
), counted AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM lines WHERE n > 0
), runs AS (
  SELECT a.doc_id, a.pos, [a.pos, b.pos] AS spots, a.line || chr(10) || b.line AS run
  FROM counted a JOIN counted b ON a.doc_id = b.doc_id AND b.i = a.i + 1 WHERE a.n + b.n >= 8
  UNION ALL
  SELECT doc_id, pos, [pos], line FROM counted WHERE n >= 12
), firsts AS (
  SELECT run, min((doc_id, pos)) AS keeps FROM runs GROUP BY run
), gone AS (
  SELECT DISTINCT doc_id, unnest(spots) AS pos FROM runs JOIN firsts USING (run) WHERE (doc_id, pos) > keeps
), lost AS (
  SELECT doc_id, list(pos) AS spots FROM gone GROUP BY doc_id
)
SELECT doc_id, coalesce(len(spots), 0) AS n_removed,
  sha256(array_to_string(list_filter(parts, lambda x, i: NOT list_contains(coalesce(spots, []), i - 1)), chr(10))) AS kept_sha256
FROM split LEFT JOIN lost USING (doc_id)
"""
