"""Quality rules: robust multivariate outliers per language and source.

Each text gets a vector of transformed statistics. Per (language, source) the minimum-covariance-
determinant estimate of location and scatter is found by concentration steps: from a start made of
medians, keep the half of the documents nearest by Mahalanobis distance, take mean and covariance of
these, and repeat. Documents further away than the cutoff go, as do those that fail the base rule.

One concentration step is one aggregation. Distances are counted in fixed bins together with the sums
of the values and of their products, so the nearest half and its mean and covariance are running sums
over at most ``BINS`` rows per group. Values are whole numbers (``UNIT`` parts) and sums of them exact, so
results do not depend on the order of rows. Groups are aggregated in part before the shuffle, and the
only table that meets all documents holds one row per group.

Defined results: a null or empty text has no words and fails the base rule; null languages and sources
are groups of their own; groups under ``MIN_ROWS`` documents are judged with their language's, languages
under it with all small ones' documents, and if these are under it too, only the base rule counts.
Documents with equal vectors always get equal verdicts, so do repeated rows. Columns other than
doc_id, text, lang and source are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repotide.llm.common import BLANKS, full_text, let, row_hash, split_words, stored, table

#: Fewer documents give no estimate of their own.
MIN_ROWS = 100
#: Parts of a unit to which transformed statistics are rounded.
UNIT = 256
STEPS = 5
#: Bins per doubling of a squared distance, and their number.
PER_DOUBLING, BINS = 8, 512
#: Squared distance at which a document is an outlier, in terms of a chi-square of five degrees: its
#: median is 4.351, and 30 has a tail of 1.5e-5.
CHI_MEDIAN, CUTOFF = 4.351, 30.0
#: Least spread of each statistic: where most documents agree exactly, small differences are no outliers.
SPREAD = (0.6, 0.15, 0.35, 1.2, 1.2)
SIZE = len(SPREAD)
PRODUCTS = [(i, j) for i in range(SIZE) for j in range(i + 1)]
GROUP = ["g_lang", "g_source"]
#: Tables of groups are broadcast up to this many rows (about 200 bytes each), else rows are salted.
BROADCAST_GROUPS, SALTS = 50_000, 64
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeated_words(words: Column) -> Column:
    """Words within three-word windows found twice or more."""

    def places(windows: Column) -> Column:
        def covered(ordered: Column) -> Column:
            twins = F.filter(
                ordered,
                lambda w, i: ((i > 0) & (F.get(ordered, i - 1)["window"] == w["window"]))
                | F.coalesce(F.get(ordered, i + 1)["window"] == w["window"], F.lit(False)),
            )
            at = F.array_sort(F.transform(twins, lambda w: w["at"]))
            return let(
                at,
                lambda p: F.aggregate(
                    F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(3)), F.lit(3))),
                    F.lit(0).cast("long"),
                    lambda total, n: total + n,
                ),
            )

        ordered = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("window"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
            let(ordered, covered)
        )

    def of(w: Column) -> Column:
        starts = F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0)))
        return let(F.transform(starts, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))), places)

    return let(words, of)


def _repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, BLANKS, "") != "")
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the row's hash, the five counts and whether the base rule fails."""
    text = full_text()
    words = docs.select("doc_id", "lang", "source", row_hash("text", "lang", "source").alias("row_hash"), text.alias("text"))
    counted = words.select(
        "doc_id",
        "lang",
        "source",
        "row_hash",
        let(
            split_words(F.col("text")),
            lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeated_words(w).alias("n_repeat_words")),
        ).alias("w"),
        F.char_length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        _repeated_lines(F.col("text")).alias("n_dup_lines"),
    ).select("doc_id", "lang", "source", "row_hash", "w.n_words", "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def _vector() -> list[Column]:
    """Transformed statistics in ``UNIT`` parts."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    values = [
        F.log1p("n_words"),
        F.log1p(F.col("word_chars") / words),
        F.log1p(100 * F.col("n_symbols") / (F.col("word_chars") + 1)),
        F.log1p(100 * F.col("n_dup_lines") / words),
        F.log1p(100 * F.col("n_repeat_words") / words),
    ]
    return [F.round(v * UNIT).cast("long").alias(f"x{i}") for i, v in enumerate(values)]


def _named(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit("null"))


def _with_groups(stats: DataFrame, min_rows: int) -> DataFrame:
    """Adds the group by which a document is judged; small groups are pooled."""
    stats = stats.withColumn("of_lang", _named("lang")).withColumn("of_source", _named("source"))
    by_source = stored(stats.groupBy("of_lang", "of_source").agg(F.count(F.lit(1)).alias("n")), "quality-sources")
    small = F.col("n") < min_rows
    pooled = stored(by_source.where(small).groupBy("of_lang").agg(F.sum("n").alias("pooled")), "quality-pools")
    groups = _beside(by_source, pooled, ["of_lang"], "left").select(
        "of_lang",
        "of_source",
        F.when(small & (F.col("pooled") < min_rows), F.lit("all")).otherwise(F.col("of_lang")).alias("g_lang"),
        F.when(small, F.lit("all")).otherwise(F.col("of_source")).alias("g_source"),
    )
    return _beside(stats, stored(groups, "quality-groups"), ["of_lang", "of_source"]).drop("of_lang", "of_source")


def _beside(df: DataFrame, groups: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``df`` joined with a table of one row per group, without gathering a large group's rows in one task."""
    if groups.count() <= BROADCAST_GROUPS:
        return df.join(F.broadcast(groups), keys, how)
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return df.withColumn("salt", F.floor(F.rand(0) * SALTS).cast("int")).join(salted, [*keys, "salt"], how).drop("salt")


def _medians(values: DataFrame) -> DataFrame:
    """g_lang, g_source, j, x: the lower median of each statistic in each group."""
    counted = values.groupBy(*GROUP, "j", "x").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*GROUP, "j")
    upto = F.sum("n").over(whole.orderBy("x").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.withColumn("upto", upto).withColumn("rows", F.sum("n").over(whole))
    return ranked.where(2 * F.col("upto") >= F.col("rows")).groupBy(*GROUP, "j").agg(F.min("x").alias("x"))


def _start(vectors: DataFrame) -> DataFrame:
    """One row per group: medians as location, median deviations as a diagonal scatter."""
    long = vectors.select(
        *GROUP, F.posexplode(F.array(*[F.col(f"x{i}") for i in range(SIZE)])).alias("j", "x")
    )
    centre = stored(_medians(long), "mcd-median").withColumnRenamed("x", "m")
    spread = _medians(_beside(long, centre, [*GROUP, "j"]).select(*GROUP, "j", F.abs(F.col("x") - F.col("m")).alias("x")))
    both = centre.join(spread, [*GROUP, "j"])
    at = [F.max(F.when(F.col("j") == i, F.col("m"))).cast("double").alias(f"m{i}") for i in range(SIZE)]
    deviation = [F.max(F.when(F.col("j") == i, F.col("x"))) * 1.4826 for i in range(SIZE)]
    rows = both.groupBy(*GROUP).agg(*at, *[d.alias(f"d{i}") for i, d in enumerate(deviation)])
    zero = F.lit(0.0)
    return rows.select(
        *GROUP,
        *[f"m{i}" for i in range(SIZE)],
        *[(F.col(f"d{i}") * F.col(f"d{i}") if i == j else zero).alias(f"s{i}_{j}") for i, j in PRODUCTS],
    )


def _factored(groups: DataFrame) -> DataFrame:
    """Cholesky factor of the scatter, widened by the least spreads, in place of the scatter."""
    done = [c for c in groups.columns if not c.startswith("s")]
    for i in range(SIZE):
        for j in range(i + 1):
            inner = [F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)]
            rest = reduce(lambda a, b: a - b, inner, F.col(f"s{i}_{j}") + (F.lit((SPREAD[i] * UNIT) ** 2) if i == j else 0.0))
            groups = groups.withColumn(f"l{i}_{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}_{j}"))
    return groups.select(*done, *[f"l{i}_{j}" for i, j in PRODUCTS])


def _distances(vectors: DataFrame, groups: DataFrame, how: str = "inner") -> DataFrame:
    """Adds the squared Mahalanobis distance ``d`` and the bin it falls into."""
    df = _beside(vectors, groups, GROUP, how)
    for i in range(SIZE):
        inner = [F.col(f"l{i}_{k}") * F.col(f"z{k}") for k in range(i)]
        df = df.withColumn(f"z{i}", reduce(lambda a, b: a - b, inner, F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"l{i}_{i}"))
    distance = reduce(lambda a, b: a + b, [F.col(f"z{i}") * F.col(f"z{i}") for i in range(SIZE)])
    level = F.floor(F.log2(F.col("d") + 1e-3) * PER_DOUBLING) + 10 * PER_DOUBLING
    level = F.least(F.greatest(level, F.lit(0)), F.lit(BINS - 1)).cast("int")
    return df.withColumn("d", distance).withColumn("bin", level)


def _nearest_half(vectors: DataFrame, groups: DataFrame) -> DataFrame:
    """Count, sums and edge of the half of each group that is nearest under ``groups``."""
    bins = _distances(vectors, groups).groupBy(*GROUP, "bin").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(f"x{i}").alias(f"t{i}") for i in range(SIZE)],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}_{j}") for i, j in PRODUCTS],
    )
    names = bins.columns[len(GROUP) + 1 :]
    upto = Window.partitionBy(*GROUP).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    running = bins.select(
        *GROUP, "bin", F.sum("n").over(Window.partitionBy(*GROUP)).alias("rows"), *[F.sum(c).over(upto).alias(c) for c in names]
    )
    half = running.where(2 * F.col("n") >= F.col("rows"))
    edge = F.pow(F.lit(2.0), (F.col("bin") + 1 - 10 * PER_DOUBLING) / PER_DOUBLING) - 1e-3
    return half.groupBy(*GROUP).agg(F.min(F.struct("bin", *names)).alias("s")).select(*GROUP, "s.*").withColumn("half", edge)


def _concentrated(vectors: DataFrame, groups: DataFrame) -> DataFrame:
    """Location and factored scatter of the half of each group that is nearest under ``groups``."""
    mean = [(F.col(f"t{i}") / F.col("n")).alias(f"m{i}") for i in range(SIZE)]
    scatter = [
        (F.col(f"q{i}_{j}") / F.col("n") - (F.col(f"t{i}") / F.col("n")) * (F.col(f"t{j}") / F.col("n"))).alias(f"s{i}_{j}")
        for i, j in PRODUCTS
    ]
    return _factored(_nearest_half(vectors, groups).select(*GROUP, *mean, *scatter))


def judge_quality(docs: DataFrame, min_rows: int = MIN_ROWS, cutoff: float = CUTOFF, steps: int = STEPS) -> DataFrame:
    """One row per document: doc_id, the row's hash, the counts, base_failed, kept and the distance.

    ``distance`` is the squared robust distance in chi-square terms, null where the group is too small
    for an estimate.
    """
    stats = stored(_with_groups(stored(text_statistics(docs), "quality-counts"), min_rows), "quality-statistics")
    vectors = stored(stats.select(*GROUP, *_vector()), "quality-vectors")
    sizes = vectors.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= min_rows)
    groups = stored(_factored(_start(vectors).join(sizes, GROUP, "left_semi")), "mcd-start")
    for step in range(steps):
        groups = stored(_concentrated(vectors, groups), f"mcd-step-{step}")
    # the last estimate's own distances, once more, give its median
    centre = stored(groups.join(_nearest_half(vectors, groups).select(*GROUP, "half"), GROUP), "mcd-last")
    judged = _distances(stats.select("*", *_vector()), centre, "left")
    # the nearest half understates the scatter, but the least spreads never do
    distance = F.col("d") / F.greatest(F.col("half") / CHI_MEDIAN, F.lit(1.0))
    kept = ~F.col("base_failed") & F.coalesce(distance <= cutoff, F.lit(True))
    return judged.select("doc_id", "row_hash", *COUNTS, "base_failed", kept.alias("kept"), distance.alias("distance"))


def keep_good(docs: DataFrame, **settings) -> DataFrame:
    """The documents that ``judge_quality`` keeps, with all their columns."""
    good = judge_quality(docs, **settings).where("kept").select(F.col("doc_id").alias("good_id"), F.col("row_hash").alias("good_hash"))
    same = docs["doc_id"].eqNullSafe(good["good_id"]) & (row_hash("text", "lang", "source") == good["good_hash"])
    return docs.join(good, same, "left_semi")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents")).drop("row_hash")
