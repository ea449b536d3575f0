import pytest


@pytest.fixture
def documents(spark):
    """Makes a documents table of (doc_id, text) pairs or (doc_id, text, lang, source) rows."""

    def make(rows):
        full = [(*r, "en", "s0")[:4] if len(r) == 2 else tuple(r) for r in rows]
        full = [(*r, len(r[1]) if r[1] is not None else None) for r in full]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make


#: Rows that every operator must bear: nulls in every column, empty, blank and very long texts, equal rows.
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
ODD = [
    (None, None, None, None),
    (1, None, "en", None),
    (2, "", None, "s0"),
    (3, " \n\t \n", "en", "s0"),
    (4, "one", "en", "s0"),
    (5, LONG, "en", "s0"),
    (6, LONG, "en", "s0"),
    (7, "same row here with a few words", "de", "s1"),
    (7, "same row here with a few words", "de", "s1"),
    (None, "no id but some words in a line", "en", "s0"),
    (8, "x" * 60_000, "en", "s0"),
    (9, "1 " * 20_000, "en", "s0"),
    (10, "é€😀 ß\x00\x01 a@b.c", "en", "s0"),
]


@pytest.fixture
def odd(documents):
    return documents(ODD)


@pytest.fixture
def none(documents):
    return documents([])


@pytest.fixture
def clashing(odd):
    """The odd rows with columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ["score", "row_hash", "fingerprint", "component", "shard", "slot", "size", "kept", "spans", "gone", "found", "node",
             "owner", "to", "part", "a", "b", "text_id", "line_dedup_gone_", "n_words", "good_id", "kept_id", "leak_id", "number"]
    return odd.select("*", *[F.lit("own").alias(n) for n in names])
