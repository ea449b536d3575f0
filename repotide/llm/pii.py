"""Personal data: base patterns, and terms that give protected values away.

E-mail addresses, IP addresses, card and phone numbers are found by pattern. Each value found is a
protected entity. How strongly other terms reveal it is estimated from the corpus: a term's documents are
counted over all documents, its documents together with the entity over the entity's surroundings
(``AROUND`` characters on both sides). A term discloses an entity if the pointwise mutual information of the two
is at least ``SHARE`` of the entity's information content, that is, if knowing the term tells most of what
there is to tell. Disclosing terms are spans of kind ``term`` in the documents that name their entity.
In the sanitised text, values become their kind's name, terms that identify the entity fully are removed and
other disclosing terms become a general word.

An estimate needs ``SUPPORT`` different surroundings, so that copies of one text, and words that happen to
stand beside a value once, tell nothing.

Positions are found by the lengths of the parts between matches. The patterns run in linear time and without
recursion on any text. Only documents with a value take part in joins with terms, and each meets the disclosing
terms among its own words, so an entity in a third of all documents is no product of documents and terms; all
documents' words are counted once, by each task before they move.

Defined results: null and empty texts have no spans; repeated rows get equal results and count as
one document; an empty table gives no rows. Columns other than doc_id and text are not read by ``find_pii``;
``sanitise`` keeps all columns; n_chars, where there is one, follows the text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.llm.common import full_text, let, row_hash, stored, table

#: Kinds in order, and what is found for each. The patterns match what
#: ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+``, ``[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)``,
#: ``[0-9]([\x20-]?[0-9])+`` and ``\+[0-9][\x20().0-9-]+[0-9]`` match, leftmost and without overlaps, but give up
#: no character once taken and start only where a longer match could not have started.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Texts that cannot match are told apart cheaply first.
SIGNS = {
    "email": lambda text: F.contains(text, F.lit("@")),
    "ip": lambda text: text.rlike(r"[0-9]\.[0-9]"),
    "card": lambda text: text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
    "phone": lambda text: F.contains(text, F.lit("+")),
}
TERM = "term"
AROUND, SUPPORT, SHARE = 100, 3, 0.8
#: Candidate and disclosing terms are broadcast up to this number, else joined by shuffle.
BROADCAST_ROWS = 100_000
NOT_WORD = "[^\\p{L}\\p{N}]+"
SPAN = "array<struct<start:int,end:int,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    places = F.sequence(F.lit(1), F.length(digits))

    def at(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) + 1 - i, F.lit(1)).cast("int")
        twice = 2 * d
        return F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(places, F.lit(0), lambda total, i: total + at(i)) % 10 == 0


CHECKS = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"),
    "card": lambda v: F.when(F.length(_digits(v)).between(13, 19), let(_digits(v), _luhn)).otherwise(False),
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}


def matches(text: Column, pattern: Column) -> Column:
    """Start, end (exclusive) and value of the matches of a pattern, in code points."""

    def of(found: Column) -> Column:
        gaps = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda gap, v: F.struct(F.char_length(gap).alias("gap"), v.alias("value")))
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

        def step(so_far: Column, x: Column) -> Column:
            start = so_far["at"] + x["gap"]
            end = start + F.char_length(x["value"])
            span = F.array(F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value")))
            return F.struct(end.alias("at"), F.concat(so_far["spans"], span).cast(SPAN).alias("spans"))

        return F.aggregate(gaps, zero, step, lambda r: r["spans"])

    return let(F.regexp_extract_all(text, pattern, F.lit(0)), of)


def _found(text: Column, kind: str) -> Column:
    passed = F.filter(matches(text, F.lit(PATTERNS[kind])), lambda s: CHECKS[kind](s["value"]))
    spans = F.when(SIGNS[kind](text), passed).otherwise(F.array().cast(SPAN))
    return F.transform(
        spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"))
    )


def _base(text: Column) -> Column:
    """All base spans with their kind, by kind and start."""
    return F.concat(*[_found(text, kind) for kind in KINDS])


def _terms(text: Column) -> Column:
    """Distinct words of letters and digits, in lower case."""
    return F.array_distinct(F.array_remove(F.split(F.regexp_replace(F.lower(text), NOT_WORD, " "), " "), ""))


def _surroundings(text: Column, spans: Column) -> Column:
    """Each value with the words around it; words cut at the outer ends are left out."""

    def around(s: Column) -> Column:
        first = F.greatest(s["start"] - AROUND, F.lit(0))
        before = F.substring(text, first + 1, s["start"] - first)
        before = F.when(first > 0, F.regexp_replace(before, "^[\\p{L}\\p{N}]+", "")).otherwise(before)
        after = F.substring(text, s["end"] + 1, F.lit(AROUND))
        after = F.when(F.char_length(text) > s["end"] + AROUND, F.regexp_replace(after, "[\\p{L}\\p{N}]+$", "")).otherwise(after)
        return F.struct(F.lower(s["value"]).alias("entity"), _terms(F.concat(before, F.lit(" "), after)).alias("terms"))

    return F.transform(spans, around)


def _text_of(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _one_each(docs: DataFrame, based: DataFrame) -> DataFrame:
    """``docs`` with one of the rows that are equal in doc_id and row_hash; texts move only where there are some."""
    again = based.groupBy(F.col("doc_id").alias("again_id"), F.col("row_hash").alias("again_hash")).count().where("count > 1")
    again = stored(again.drop("count"), "pii-repeated")
    number = again.count()
    if not number:
        return docs
    if number <= BROADCAST_ROWS:
        again = F.broadcast(again)
    same = F.col("doc_id").eqNullSafe(F.col("again_id")) & (F.col("row_hash") == F.col("again_hash"))
    return docs.join(again, same, "left_anti").union(docs.join(again, same, "left_semi").dropDuplicates(["doc_id", "row_hash"]))


def disclosing_terms(docs: DataFrame, based: DataFrame, support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """entity, term and ``certain``: whether the term is found with the entity only.

    ``based`` has doc_id, row_hash and ``near``, the surroundings of the documents' values.
    """
    seen = based.where(F.size("near") > 0).select("doc_id", "row_hash", F.explode("near").alias("n"))
    seen = stored(seen.select("doc_id", "row_hash", "n.entity", "n.terms", F.xxhash64("n.terms").alias("words")).distinct(), "pii-surroundings")
    # supported entities first, so that lone values' words go no further
    entities = seen.groupBy("entity").agg(
        F.count_distinct("words").alias("contexts"), F.count_distinct(F.struct("doc_id", "row_hash")).alias("entity_docs")
    ).where(F.col("contexts") >= support)
    pairs = seen.join(entities, "entity").select("entity", "entity_docs", "doc_id", "row_hash", "words", F.explode("terms").alias("term"))
    pairs = pairs.groupBy("entity", "entity_docs", "term").agg(
        F.count_distinct("words").alias("contexts"), F.count_distinct(F.struct("doc_id", "row_hash")).alias("pair_docs")
    ).where(F.col("contexts") >= support)
    pairs = stored(pairs, "pii-pairs")
    sought = pairs.select(F.col("term").alias("sought")).distinct()
    if pairs.count() <= BROADCAST_ROWS:
        sought = F.broadcast(sought)
    # each task's words are counted before anything else, so a word has a row per task, not per occurrence
    rows = _one_each(docs.select("doc_id", row_hash("text").alias("row_hash"), "text"), based)
    counts = rows.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("term_docs"))
    # an inner join: Spark would push a semi join below the count, where a word has a row per occurrence
    counts = counts.join(sought, F.col("term") == F.col("sought")).drop("sought")
    total = based.select("doc_id", "row_hash").distinct().count()
    information = F.log2(F.lit(float(max(total, 1))) / F.col("entity_docs"))
    mutual = F.log2(F.col("pair_docs") * F.lit(float(max(total, 1))) / (F.col("entity_docs") * F.col("term_docs")))
    told = pairs.join(counts, "term").where((information > 0) & (mutual >= share * information))
    return told.select("entity", "term", (F.col("pair_docs") >= F.col("term_docs")).alias("certain"))


def find_pii(docs: DataFrame, support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """doc_id, row_hash, ``spans`` of the base kinds, and ``terms``: spans of disclosing terms."""
    text = full_text()
    own = docs.select("doc_id", row_hash("text").alias("row_hash"), text.alias("text"))
    based = own.withColumn("spans", _base(F.col("text")))
    based = based.select("doc_id", "row_hash", "spans", F.when(F.size("spans") > 0, _surroundings(F.col("text"), F.col("spans"))).alias("near"))
    based = stored(based, "pii-base")
    told = stored(disclosing_terms(docs, based, support, share), "pii-terms")
    # a document meets the terms that it has itself, never all terms of its entities
    named = based.where(F.size("spans") > 0).select(
        F.col("doc_id").alias("named_id"),
        F.col("row_hash").alias("named_hash"),
        F.explode(F.array_distinct(F.transform("spans", lambda s: F.lower(s["value"])))).alias("named"),
    ).distinct()
    if told.count() <= BROADCAST_ROWS:
        told = F.broadcast(told)
    hinted = reduce(lambda a, b: a | b, [SIGNS[kind](F.col("text")) for kind in KINDS])
    words = own.where(hinted).select("doc_id", "row_hash", F.explode(_terms(F.col("text"))).alias("word"))
    its = F.col("doc_id").eqNullSafe(F.col("named_id")) & (F.col("row_hash") == F.col("named_hash")) & (F.col("entity") == F.col("named"))
    lists = words.join(told, F.col("word") == F.col("term")).join(named, its).groupBy(F.col("doc_id").alias("term_id"), F.col("row_hash").alias("term_hash")).agg(
        F.collect_set("term").alias("found"), F.collect_set(F.when(F.col("certain"), F.col("term"))).alias("certain")
    )
    lists = stored(lists, "pii-term-lists")
    # spans of the terms in the few documents that have any
    same = F.col("doc_id").eqNullSafe(F.col("term_id")) & (F.col("row_hash") == F.col("term_hash"))
    pattern = F.concat(F.lit("(?iu)(?<![\\p{L}\\p{N}])(?:"), F.array_join("found", "|"), F.lit(")(?![\\p{L}\\p{N}])"))
    inside = own.dropDuplicates(["doc_id", "row_hash"]).join(lists, same).select("term_id", "term_hash", "certain", matches(F.col("text"), pattern).alias("m"))
    inside = inside.select(
        "term_id",
        "term_hash",
        F.transform(
            "m",
            lambda s: F.struct(
                F.lit(TERM).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.array_contains("certain", F.lower(s["value"])).alias("certain")
            ),
        ).alias("terms"),
    )
    return based.drop("near").join(inside, same, "left").drop("term_id", "term_hash")


def sanitise(docs: DataFrame, support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """``docs`` with values replaced by their kind's name, and disclosing terms generalised or removed."""
    found = find_pii(docs, support, share).dropDuplicates(["doc_id", "row_hash"])
    words = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")).alias("by")))
    terms = F.transform(
        F.coalesce("terms", F.array().cast("array<struct<kind:string,start:int,end:int,certain:boolean>>")),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["certain"], "").otherwise("<TERM>").alias("by")),
    )
    edits = found.select(F.col("doc_id").alias("pii_id"), F.col("row_hash").alias("pii_hash"), F.array_sort(F.concat(words, terms)).alias("edits"))
    edits = edits.where(F.size("edits") > 0)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), row_hash("text").alias("own_hash"))
    same = F.col("own_id").eqNullSafe(F.col("pii_id")) & (F.col("own_hash") == F.col("pii_hash"))
    text = F.col("row.text")
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(so_far: Column, s: Column) -> Column:
        """A span that overlaps the one before only lengthens it."""
        new = F.array(F.substring(text, so_far["at"] + 1, s["start"] - so_far["at"]), s["by"])
        parts = F.when(s["start"] >= so_far["at"], F.concat(so_far["parts"], new)).otherwise(so_far["parts"])
        return F.struct(F.greatest(so_far["at"], s["end"]).alias("at"), parts.alias("parts"))

    rest = F.aggregate("edits", zero, step, lambda r: F.concat(F.array_join(r["parts"], ""), F.substring(text, r["at"] + 1, F.char_length(text))))
    edited = F.when(F.col("edits").isNull(), text).otherwise(rest)
    row = F.col("row").withField("text", edited)
    if "n_chars" in docs.columns:
        length = F.char_length(rest).cast(dict(docs.dtypes)["n_chars"])
        row = row.withField("n_chars", F.when(F.col("edits").isNull(), F.col("row.n_chars")).otherwise(length))
    return rows.join(edits, same, "left").select(row.alias("row")).select("row.*")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in KINDS]
    base = _text_of(F.col("spans"))
    terms = _text_of(F.coalesce("terms", F.array().cast("array<struct<kind:string,start:int,end:int,certain:boolean>>")))
    every = F.concat_ws(",", *[F.when(x != "", x) for x in (base, terms)])
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), every.alias("spans"))
