"""Benchmark decontamination by templates.

Texts are put into a canonical form in which numbers, names and units become typed placeholders; other
words lose case and punctuation. Windows of ``WINDOW`` words of the benchmark items' templates are joined
by hash with those of the documents. A re-parameterised question has the same template with other values,
so per document, item and alignment the placeholders' values are compared: equal values of the item must be
equal in the document and different ones different, or the match is dropped.

A number is a run of digits; commas before groups of three digits are left out of it and points between digits
belong to it, so that 3.5 is not 35 and 10,20,30 are three. A unit is a word of ``UNITS`` after a number. A name is
a capitalised word. Whether one that opens a sentence is a name cannot be seen, so texts have two forms, of which each
window may match: all capitalised words are names, or only those inside sentences are. Items have a third
one without names, for copies that are all in small or all in capital letters. An opener that some item has in small letters is a word of the language: it
takes the place of a name in the form, but a document must have the same there. Windows with more placeholders than
words would match any list of numbers or names, so these are looked up with their values. Items shorter than
a window are one window; ``not_searched`` returns the items under ``SHORTEST`` words, which say too little.

The benchmark's window hashes are broadcast if they are at most ``BROADCAST_ROWS``, else joined by
shuffle. Matching windows alone are stored, with their placeholders' values, and no text is moved; the
documents to drop are broadcast under the same bound.

Defined results: null and empty texts match nothing, whether of documents or items; very long texts are searched
as a whole, in one row; characters that mark placeholders here count as blanks in a text; repeated rows get equal
results; an item found several times in a document is one row; empty tables give no rows. Columns other
than doc_id, text and item_id are not read, whatever they are called; ``drop_contaminated`` keeps all columns of
the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.llm.common import row_hash, stored, table

WINDOW, SHORTEST = 10, 5
BROADCAST_ROWS = 500_000
#: Marks of numbers, names and units, and the point inside a number.
NUMBER, NAME, UNIT, POINT = "\x01", "\x02", "\x03", "\x04"
#: Which capitalised words are names: all, those inside sentences, none.
ALL, INNER, NONE = "all", "inner", "none"
#: Units of measure.
UNITS = (
    "mm|cm|m|km|inch|inches|foot|feet|ft|yard|yards|mile|miles|mg|g|kg|t|ton|tons|tonne|tonnes|oz|ounce|ounces|lb|lbs|pound|pounds"
    "|ml|l|litre|litres|liter|liters|gallon|gallons|s|sec|second|seconds|min|minute|minutes|h|hr|hour|hours|day|days|week|weeks"
    "|month|months|year|years|percent|euro|euros|dollar|dollars|cent|cents|degree|degrees|km/h|mph|kb|mb|gb|tb"
)


def marked(text: Column) -> Column:
    """The text with marks before numbers and their units."""
    # patterns that look behind first look at the character itself, as most places end there
    text = F.regexp_replace(text, f"[{NUMBER}-{POINT}]", " ")
    joined = F.regexp_replace(text, "(?=,)(?<![0-9]{4})(?<=[0-9]),(?=[0-9]{3}(?![0-9]))", "")
    pointed = F.regexp_replace(joined, "(?=[.])(?<=[0-9])[.](?=[0-9])", POINT)
    numbers = F.regexp_replace(pointed, f"([0-9][0-9{POINT}]*)", f" {NUMBER}$1 ")
    units = F.regexp_replace(numbers, f"({NUMBER}[0-9{POINT}]+) +({UNITS})(?!\\p{{L}})", f"$1 {UNIT}$2")
    return F.when(text.rlike("[0-9]"), units).otherwise(text)


def form(named: Column, names: str) -> Column:
    """Words of the canonical form of a ``marked`` text."""
    if names == ALL:
        named = F.regexp_replace(named, f"(?=\\p{{Lu}})(?<![\\p{{L}}\\p{{N}}{NUMBER}-{POINT}])(\\p{{Lu}}\\p{{Ll}})", f"{NAME}$1")
    elif names == INNER:
        named = F.regexp_replace(named, "(?=\\p{Lu})(?<=[\\p{Ll},;] )(\\p{Lu}\\p{Ll})", f"{NAME}$1")
        named = F.regexp_replace(named, f"({NAME}\\p{{L}}+ )(\\p{{Lu}}\\p{{Ll}})", f"$1{NAME}$2")
    plain = F.regexp_replace(F.lower(named), f"[^\\p{{L}}\\p{{N}}{NUMBER}-{POINT}]+", " ")
    return F.array_remove(F.split(plain, " "), "")


def template(text: Column, names: str = ALL) -> Column:
    """Words of the canonical form; a placeholder is its mark followed by its value.

    A text has the same number of words whatever ``names`` is.
    """
    return form(marked(text), names)


def _is_slot(word: Column) -> Column:
    return F.ascii(word) <= 3


def _hashes(words: Column) -> Column:
    """One number for each word of the template; a placeholder's, whatever its value, is that of its mark, 1 to 3."""
    return F.transform(words, lambda w: F.when(_is_slot(w), F.ascii(w).cast("long")).otherwise(F.xxhash64(w)))


def _windows(rows: DataFrame, lengths: Column) -> DataFrame:
    """A row for each window of each of ``lengths`` words of ``words``, with its place ``at`` and its hash ``found``.

    Hashes are taken from rows, as Spark compiles that, and interprets functions over arrays.
    """
    rows = rows.withColumn("hashes", _hashes(F.col("words"))).withColumn("length", F.explode(lengths))
    n = F.size("hashes") - F.col("length")
    rows = rows.withColumn("at", F.explode(F.when(n >= 0, F.sequence(F.lit(0), n))))
    here = F.slice("hashes", F.col("at") + 1, F.col("length"))
    others = here
    for mark in (NUMBER, NAME, UNIT):
        others = F.array_remove(others, F.lit(ord(mark)).cast("long"))
    by_value = F.xxhash64(F.slice("words", F.col("at") + 1, F.col("length")))
    return rows.withColumn("found", F.when(2 * F.size(others) < F.col("length"), by_value).otherwise(F.xxhash64(here)))


def _slots() -> Column:
    """The placeholders of a window."""
    return F.filter(F.slice("words", F.col("at") + 1, F.col("length")), _is_slot)


def not_searched(benchmark: DataFrame) -> DataFrame:
    """item_id and number of words of the items that are too short to be searched for."""
    size = F.coalesce(F.size(template(F.col("text"), NONE)), F.lit(0))
    return benchmark.select("item_id", size.alias("n_words")).where(F.col("n_words") < SHORTEST)


def _items(benchmark: DataFrame, window: int) -> DataFrame:
    """item_id, window length, start, hash and placeholders of the items' windows, and the openers that must stay."""
    forms = [template(F.col("text"), names).alias(names) for names in (ALL, INNER, NONE)]
    items = benchmark.select("item_id", F.xxhash64("text").alias("text_hash"), *forms).where(F.size(NONE) >= SHORTEST)
    small = items.select(F.explode(F.filter(ALL, lambda w: ~_is_slot(w))).alias("word")).distinct()
    pairs = F.arrays_zip(F.col(ALL).alias("a"), F.col(INNER).alias("b"), F.col(NONE).alias("word"))
    openers = F.filter(pairs, lambda p: _is_slot(p["a"]) & ~_is_slot(p["b"]))
    openers = items.select("text_hash", F.explode(openers["word"]).alias("word")).distinct()
    stay = openers.join(small, "word", "left_semi").groupBy("text_hash").agg(F.collect_set(F.concat(F.lit(NAME), "word")).alias("stay"))
    items = items.join(stay, "text_hash", "left").withColumn("length", F.least(F.size(NONE), F.lit(window)))
    items = items.select("item_id", "length", "stay", F.explode(F.array_distinct(F.array(ALL, INNER, NONE))).alias("words"))
    items = _windows(items.withColumnRenamed("length", "own_length"), F.array("own_length"))
    names = [F.col("at").alias("start"), F.col("found").alias("hash"), _slots().alias("item_slots")]
    return items.select("item_id", "length", "stay", *names).distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, row_hash, item_id, the number of windows found and of placeholders compared."""
    items = stored(_items(benchmark, window), "benchmark-windows")
    lengths = [r["length"] for r in items.select("length").distinct().orderBy("length").collect()]  # at most ``window``
    keys = items.select(F.col("hash").alias("sought")).distinct()
    if items.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    texts = docs.select("doc_id", row_hash("text").alias("row_hash"), marked(F.col("text")).alias("marked"))
    # a window that both forms have is found twice, which counts once below
    forms = texts.select("doc_id", "row_hash", *[form(F.col("marked"), names).alias(names) for names in (ALL, INNER)])
    words = forms.select("doc_id", "row_hash", F.explode(F.array_distinct(F.array(ALL, INNER))).alias("words"))
    windows = _windows(words, F.array(*[F.lit(n) for n in lengths or [window]]))
    hits = windows.join(keys, F.col("found") == F.col("sought"), "left_semi")
    hits = stored(hits.select("doc_id", "row_hash", "length", "found", "at", _slots().alias("slots")), "benchmark-hits")
    parts = items.withColumnRenamed("length", "item_length")
    both = (F.col("found") == F.col("hash")) & (F.col("length") == F.col("item_length"))
    # equal templates have their placeholders in the same places, so these pair up in order
    none = F.array().cast("array<string>")
    values = F.arrays_zip(F.col("item_slots").alias("item"), F.col("slots").alias("doc"))
    pairs = hits.join(parts, both).select(
        "doc_id", "row_hash", "item_id", (F.col("at") - F.col("start")).alias("shift"), "start", "stay", values.alias("slots")
    )
    stay = F.coalesce("stay", none)
    pairs = pairs.where(~F.exists("slots", lambda p: F.array_contains(stay, p["item"]) & (p["item"] != p["doc"])))
    aligned = pairs.groupBy("doc_id", "row_hash", "item_id", "shift").agg(
        F.count_distinct("start").alias("n_windows"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"),
    )
    n = F.size("slots")
    one_way = F.size(F.array_distinct(F.transform("slots", lambda p: p["item"]))) == n
    other_way = F.size(F.array_distinct(F.transform("slots", lambda p: p["doc"]))) == n
    consistent = aligned.where(one_way & other_way)
    return consistent.groupBy("doc_id", "row_hash", "item_id").agg(
        F.max("n_windows").cast("long").alias("n_windows"), F.max(n).cast("long").alias("n_slots")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    bad = contaminated(docs, benchmark, window).select(F.col("doc_id").alias("leak_id"), F.col("row_hash").alias("leak_hash"))
    bad = stored(bad.distinct(), "contaminated")
    if bad.count() <= BROADCAST_ROWS:
        bad = F.broadcast(bad)
    same = docs["doc_id"].eqNullSafe(bad["leak_id"]) & (row_hash("text") == bad["leak_hash"])
    return docs.join(bad, same, "left_anti")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item found in it."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("row_hash")
