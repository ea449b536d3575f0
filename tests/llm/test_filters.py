"""Quality rules, line dedup, decontamination, PII and URL filters against plain Python."""

import math
import re

import numpy as np
import pytest

from repotide.llm import decontamination, line_dedup, pii, quality_rules, url_filters
from tests.llm import plain
from tests.llm.conftest import ODD


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def corpus(n=400, seed=3):
    rng = np.random.default_rng(seed)
    words = [f"word{i}" for i in range(500)]
    out = []
    for i in range(n):
        lines = [" ".join(rng.choice(words, rng.integers(4, 16))) for _ in range(rng.integers(8, 30))]
        out.append((i, "\n".join(lines)))
    return out


def test_text_counts(odd):
    got = quality_rules.text_statistics(odd).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert rows_of(got) == sorted([(r[0], *plain.text_counts(r[1])) for r in ODD], key=repr)


def test_outliers_go_and_clean_documents_stay(spark, documents):
    clean = corpus()
    junk = [(1000 + i, text.replace(" ", "*** ")) for i, text in corpus(40, seed=5)]
    got = {r["doc_id"]: r for r in quality_rules.judge_quality(documents(clean + junk)).collect()}
    assert all(got[i]["kept"] for i, _ in clean)
    assert not any(got[i]["kept"] or got[i]["base_failed"] for i, _ in junk)


def concentrated(x, steps):
    """The estimate of ``judge_quality`` for one group, in numpy."""
    floor = np.diag((np.array(quality_rules.SPREAD) * quality_rules.UNIT) ** 2)

    def lower(v):
        return np.sort(v)[(len(v) + 1) // 2 - 1]

    centre = np.array([lower(c) for c in x.T], float)
    spread = np.diag([(1.4826 * lower(np.abs(c - m))) ** 2 for c, m in zip(x.T, centre, strict=True)])
    half = None
    for step in range(steps + 1):
        z = np.linalg.solve(np.linalg.cholesky(spread + floor), (x - centre).T)
        d = (z**2).sum(0)
        level = np.clip(np.floor(np.log2(d + 1e-3) * quality_rules.PER_DOUBLING) + 10 * quality_rules.PER_DOUBLING, 0, quality_rules.BINS - 1)
        edge = next(e for e in np.unique(level) if 2 * (level <= e).sum() >= len(x))
        half = 2.0 ** ((edge + 1 - 10 * quality_rules.PER_DOUBLING) / quality_rules.PER_DOUBLING) - 1e-3
        if step < steps:
            near = x[level <= edge]
            centre, spread = near.mean(0), np.cov(near.T, bias=True)
    return d / max(half / quality_rules.CHI_MEDIAN, 1.0)


def test_distances_are_those_of_the_estimate(documents):
    docs = documents(corpus(150) + [(900 + i, "a b *** c d\n" * 30) for i in range(5)])
    got = {r["doc_id"]: r for r in quality_rules.judge_quality(docs).collect()}
    ids = sorted(got)
    counts = np.array([[got[i][c] for c in quality_rules.COUNTS] for i in ids], float)
    n, chars, symbols, lines, repeated = counts.T
    words = np.maximum(n, 1)
    raw = [np.log1p(n), np.log1p(chars / words), np.log1p(100 * symbols / (chars + 1)), np.log1p(100 * lines / words), np.log1p(100 * repeated / words)]
    x = np.floor(np.stack(raw, 1) * quality_rules.UNIT + 0.5)
    expected = concentrated(x, quality_rules.STEPS)
    assert np.allclose([got[i]["distance"] for i in ids], expected, rtol=1e-6)


def test_rules_bear_odd_rows(odd, clashing, none):
    got = quality_rules.judge_quality(odd)
    assert got.count() == len(ODD)
    kept = quality_rules.keep_good(clashing)
    assert kept.columns == clashing.columns and kept.count() == got.where("kept").count()
    assert quality_rules.judge_quality(none).count() == 0 and quality_rules.keep_good(none).count() == 0


def test_repeated_lines(documents):
    a, b, c = "first line of five words", "second line has five words", "third line with some words"
    long = " ".join(f"t{i}" for i in range(15))
    docs = [
        (1, f"{a}\n{b}\n{c}"), (2, f"new start here\n {a} \n{b}\nnew end"), (3, f"{b}\n{c}\n{long}"), (4, f"x\n{long}\n{a}"),
        (5, f"{a}\n{b}\n{a}\n{b}"), (6, "short\nlines\nshort\nlines"), (7, f"{a}\n\n{b}"), *[(10 + i, t) for i, t in corpus(30)],
        *[(100 + i, t) for i, t in corpus(30)],
    ]
    got = {r["doc_id"]: set(r["gone"]) for r in line_dedup.repeated_lines(documents(docs)).collect()}
    assert got == plain.lost_lines(docs)
    assert got[2] == {1, 2} and got[3] == {0, 1} and got[4] == {1} and 6 not in got
    left = {r["doc_id"]: r for r in line_dedup.drop_repeated_lines(documents(docs)).collect()}
    assert left[2]["text"] == "new start here\nnew end" and left[2]["n_chars"] == len(left[2]["text"])
    assert left[1]["text"] == docs[0][1] and left[100]["text"] == ""


@pytest.mark.parametrize("window", [1, 3, 4])
def test_winnowing_misses_no_run(documents, window):
    rng = np.random.default_rng(window)
    docs = [(i, "\n".join(f"line number {k} of the few" for k in rng.integers(0, 12, 25))) for i in range(25)]
    got = line_dedup.repeated_lines(documents(docs), window=window, min_words=1, long=99)
    assert {r["doc_id"]: set(r["gone"]) for r in got.collect()} == plain.lost_lines(docs, window, 1, 99)


def test_line_dedup_bears_odd_rows(clashing, none):
    got = line_dedup.drop_repeated_lines(clashing)
    assert got.columns == clashing.columns and got.count() == len(ODD)
    texts = {(r["doc_id"], r["source"]): r["text"] for r in got.collect()}
    assert texts[5, "s0"] and texts[6, "s0"] == "" and texts[1, None] is None
    assert line_dedup.drop_repeated_lines(none).count() == 0


ITEM = "A train leaves Berlin with 120 people and stops after 30 km where 15 people step out while Anna waits at 30 km"


@pytest.fixture
def benchmark(spark):
    rows = [(1, ITEM), (2, "one two three four five six"), (3, None), (4, ""), (5, "1 2 3 4 5 6 7 8 9 10 11 12")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_templates_find_other_values(documents, benchmark):
    docs = [
        (1, f"before it, {ITEM} after it"),
        (2, "so a train leaves Paris with 7 people, and stops after 55 miles where 90 people step out while Maria waits at 55 miles"),
        (3, "a train leaves Paris with 7 people and stops after 55 km where 55 people step out while Maria waits at 3 km"),
        (4, "One, two; three FOUR five six!"),
        (5, "one two three four five"),
        (6, "4 5 6 7 8 9 10 11 12 13 14 15 16 17"),
        (7, "a plane leaves Berlin with 120 people and lands elsewhere while nobody waits"),
    ]
    got = decontamination.contaminated(documents(docs), benchmark).select("doc_id", "item_id").collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 1), (4, 2)]
    left = decontamination.drop_contaminated(documents(docs), benchmark)
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 5, 6, 7]


def test_decontamination_bears_odd_rows(clashing, none, benchmark):
    left = decontamination.drop_contaminated(clashing, benchmark)
    assert left.columns == clashing.columns and left.count() == len(ODD)
    assert decontamination.drop_contaminated(none, benchmark).count() == 0
    assert decontamination.drop_contaminated(clashing, benchmark.limit(0)).count() == len(ODD)


SUMS = [
    (1, "Sarah has 12 apples and gives 5 to Tom"),
    (2, "What is the capital of France and who wrote there?"),
    (3, "10,20,30 apples cost 3.5 euros in all of the town"),
    (4, "Tom walks 1,200 km. How far is it, and what does Anna say to Tom about it?"),
    (5, "Ada Bob Cleo Dan Eve Fay Gus Hal"),
    (6, "see the table"),
]


def test_short_questions_with_other_names_and_numbers(spark, documents):
    items = spark.createDataFrame(SUMS, "item_id long, text string")
    docs = [
        (1, "John has 30 apples and gives 7 to Bill"),
        (2, "It says: Mary has 3,000 apples and gives 7.5 to Bill. Then they left"),
        (3, "SARAH HAS 12 APPLES AND GIVES 5 TO TOM"),
        (4, "John has 30 apples and gives 7 to John"),
        (5, "What is the capital of Spain and who wrote there?"),
        (6, "Paris is the capital of Spain and who wrote there?"),
        (7, "so 10, 20, 30 apples cost 3.5 euros in all of the town"),
        (8, "so 10,20,30 apples cost 35 euros in all of the town"),
        (9, "so 102030 apples cost 3.5 euros in all"),
        (10, "Bill walks 80 km. How far is it, and what does Kate say to Bill about it?"),
        (11, "Bill walks 80 km. How far is it, and what does Bill say to Bill about it?"),
        (12, "here are Ada Bob Cleo Dan Eve Fay Gus Hal"),
        (13, "here are Hal Gus Fay Eve Dan Cleo Bob Ada"),
        (14, "see the table"),
        (15, "\x02john has \x0130 apples and gives 7 to Bill"),
    ]
    got = decontamination.contaminated(documents(docs), items).select("doc_id", "item_id").collect()
    expected = {(1, 1), (2, 1), (3, 1), (5, 2), (7, 3), (8, 3), (10, 4), (12, 5)}
    assert set(map(tuple, got)) == expected and len(got) == len(expected)
    assert plain.contaminated(docs[:14], SUMS, UNITS) == expected
    assert [tuple(r) for r in decontamination.not_searched(items).collect()] == [(6, 3)]


UNITS = set(decontamination.UNITS.split("|"))


@pytest.mark.parametrize("bound", [decontamination.BROADCAST_ROWS, 0])
def test_contamination_is_that_of_brute_force(spark, documents, monkeypatch, bound):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", bound)
    rng = np.random.default_rng(11)
    words = ["Tom", "Ada", "Bob", "has", "a", "red", "The", "the", "Who", "who", "12", "3.5", "1,000", "7", "km", "days", "of", "to"]

    def text(n):
        return "".join(w + rng.choice([" ", " ", " ", ". ", ", ", "; "]) for w in rng.choice(words, n))

    items = [(i, text(rng.integers(3, 16))) for i in range(40)]
    docs = [(i, text(30)) for i in range(60)]
    for i, item in items:
        other = item.replace("Tom", "Kim").replace("7", "88").replace("12", "9") if i % 3 else item.lower()
        docs.append((100 + i, f"{text(6)}. {other} {text(6)}"))
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in decontamination.contaminated(documents(docs), table).select("doc_id", "item_id").collect()}
    assert got == plain.contaminated(docs, items, UNITS) and len(got) > 15


def test_texts_are_put_into_form_once_whatever_lengths_items_have(spark, documents):
    """Items of six lengths are searched in one reading of the documents, and windows are rows of compiled code."""
    words = [c * 3 for c in "abcdefghijklmnopqrstuvwxyz"] + [c * 4 for c in "abcd"]
    items = spark.createDataFrame([(n, " ".join(words[n : 2 * n])) for n in range(5, 11)], "item_id long, text string")
    docs = documents([(1, " ".join(words)), (2, " ".join(words[10:20])), (3, " ".join(words[:9]))])
    read = spark.sparkContext.accumulator(0)

    def seen(rows):
        for row in rows:
            read.add(1)
            yield row

    counted = spark.createDataFrame(docs.rdd.mapPartitions(seen), docs.schema)
    got = decontamination.contaminated(counted, items).select("doc_id", "item_id").collect()
    assert sorted(map(tuple, got)) == [(1, n) for n in range(5, 11)] + [(2, 10)]
    assert read.value == 3


PERSONAL = [
    "mail a.b+c@d-e.co.uk, x@y.z@w.v and a@b.c_d@e.f. no@dot",
    "ip 1.2.3.4 9.1.2.3.4.5.6.7 256.1.1.1 0001.2.3.255 1.2.3",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 41111111111111111111111 5 4111111111111111",
    "call +49 (30) 123-456.78) or +1 2 or +1234567890123456 + 12 é😀+44 20 7946 0958",
    "@@ .. ++ 1@1.1 1.1.1.1@2.2 +1.1.1.1.1.1.1",
]


def test_base_spans(documents):
    docs = list(enumerate(PERSONAL + [r[1] for r in ODD]))
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in pii.find_pii(documents(docs)).collect()}
    assert got == {i: plain.base_spans(t) for i, t in docs}


def test_disclosing_terms(documents):
    fill = [f"nothing to see in text {i} of the many" for i in range(200)]
    near = [f"the surgeon of Larkspur{k} may be reached at head@clinic.org or by post{i}, says number {i}" for i, k in enumerate(["", "", "", "", ""])]
    copies = ["write to lone@host.org about zebra"] * 5
    docs = list(enumerate(fill + near + copies))
    found = {r["doc_id"]: r for r in pii.find_pii(documents(docs)).collect()}
    first = len(fill)
    text = docs[first][1]
    words = {text[s["start"] : s["end"]] for s in found[first]["terms"]}
    assert {"surgeon", "Larkspur"} <= words and not {"the", "of"} & words
    assert not any(found[i]["terms"] for i, _ in docs[first + len(near) :])  # one text, however often
    assert not any(found[i]["terms"] for i, _ in docs[:first])
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(documents(docs)).collect()}
    assert "<EMAIL>" in clean[first] and "Larkspur" not in clean[first] and "head@" not in clean[first]
    assert clean[0] == fill[0] and clean[docs[-1][0]] == "write to <EMAIL> about zebra"


def test_pii_bears_odd_rows(clashing, none):
    assert pii.find_pii(clashing).count() == len(ODD)
    out = pii.sanitise(clashing)
    assert out.columns == clashing.columns and out.count() == len(ODD)
    assert pii.find_pii(none).count() == 0 and pii.sanitise(none).count() == 0


def link(target, quote='"'):
    return f"<html><head><link href={quote}{target}{quote} rel={quote}canonical{quote}></head></html>"


def test_aliases_share_verdicts(spark):
    pages = [
        (1, "https://a.org/x", link("http://bad.net/x")),
        (2, "https://b.org/y", '<META http-equiv=refresh content="0; URL=https://a.org/x/#top">'),
        (3, "https://c.org/z", "<p>nothing</p>"),
        (4, "https://d.org/q", link("https://b.org/y?utm_source=m", "'")),
        (5, "https://e.org/1", link("https://www.example.net/en/1")),
        (6, "https://f.org/2", link("https://e.org/1")),
        (7, "https://g.net/2", link("https://e.org/1")),
        (8, "https://h.org/c", f"<!-- {link('http://bad.net/x')} -->"),
        (9, "http://EXAMPLE.com/de/7?x=1", "see"),
        (10, "http://example.com/dex/", None),
        (11, "no scheme", link("http://bad.net/x")),
        (12, None, None),
        (13, "http://bad.net?x", ""),
        (14, "https://i.org/a/b", link("../x")),
        (15, "https://i.org/k/fr", link("/fr/ok")),
        (16, "https://a.b.org/fr/1", ""),
        (17, "https://notorg/fr/1", ""),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in url_filters.filter_urls(df, url_filters.rule_table(spark, url_filters.RULES)).collect()}
    verdicts = {i: (r["rule"], r["verdict"]) for i, r in got.items()}
    assert verdicts == {
        1: (None, "block"), 2: (None, "block"), 3: (None, "allow"), 4: (None, "block"), 5: (None, "allow"), 6: (None, "allow"),
        7: ("net/", "block"), 8: (None, "allow"), 9: ("example.com/de/", "block"), 10: (None, "allow"), 11: (None, "allow"),
        12: (None, "allow"), 13: (None, "allow"), 14: (None, "allow"), 15: (None, "allow"), 16: ("org/fr/", "allow"), 17: (None, "allow"),
    }
    assert (got[9]["host"], got[9]["path"]) == ("example.com", "/de/7") and (got[12]["host"], got[12]["path"]) == ("", "")


def test_url_filter_of_no_pages_and_equal_rows(spark):
    rules = url_filters.rule_table(spark, url_filters.RULES)
    none = spark.createDataFrame([], "page_id long, url string, html string, verdict string, node string")
    assert url_filters.filter_urls(none, rules).count() == 0
    twice = spark.createDataFrame([(1, "http://x.net/", None, "?")] * 2, "page_id long, url string, html string, verdict string")
    assert [r["verdict"] for r in url_filters.filter_urls(twice, rules).collect()] == ["block", "block"]


def told(docs, support=pii.SUPPORT, share=pii.SHARE):
    """(entity, term, certain) worked out document by document."""
    docs = sorted(set(docs))
    near, having, context, together = {}, {}, {}, {}
    words = [set(w for w in re.split(r"[^\w]+|_+", t.lower()) if w) for _, t in docs]
    for k, (_, text) in enumerate(docs):
        for _, a, b in plain.base_spans(text):
            before, after = text[max(0, a - pii.AROUND) : a], text[b : b + pii.AROUND]
            before = re.sub(r"^[^\W_]+", "", before) if a > pii.AROUND else before
            after = re.sub(r"[^\W_]+$", "", after) if len(text) > b + pii.AROUND else after
            terms = tuple(dict.fromkeys(w for w in re.split(r"[^\w]+|_+", f"{before} {after}".lower()) if w))
            near.setdefault(text[a:b].lower(), set()).add((k, terms))
    out = set()
    for entity, seen in near.items():
        if len({t for _, t in seen}) < support:
            continue
        own = {k for k, _ in seen}
        for term in {w for _, t in seen for w in t}:
            beside = {(k, t) for k, t in seen if term in t}
            if len({t for _, t in beside}) < support:
                continue
            both, every = len({k for k, _ in beside}), sum(term in w for w in words)
            information = math.log2(len(docs) / len(own))
            if information > 0 and math.log2(both * len(docs) / (len(own) * every)) >= share * information:
                out.add((entity, term, both >= every))
    return out


def entities_and_terms(seed=4, n=400):
    rng = np.random.default_rng(seed)
    common = [f"word{i}" for i in range(60)]
    out = []
    for i in range(n):
        words = list(rng.choice(common, 25))
        if i % 9 == 0:
            who = i // 9 % 3
            near = [f"nick{who}", f"job{who}" if rng.random() < 0.8 else "clerk", f"mail p{who}@x.org now"]
            words[10:10] = near
        elif i % 40 == 1:
            words[3:3] = [f"job{i % 3}", "nick1"]
        out.append((i, " ".join(words)))
    return out


@pytest.mark.parametrize("bound", [pii.BROADCAST_ROWS, 0])
@pytest.mark.parametrize("copies", ["none", "all thrice", "those with values"])
def test_disclosing_terms_are_those_of_brute_force(documents, monkeypatch, copies, bound):
    monkeypatch.setattr(pii, "BROADCAST_ROWS", bound)
    docs = entities_and_terms()
    again = {"none": [], "all thrice": docs * 2, "those with values": [d for d in docs if "@" in d[1]]}[copies]
    expected = told(docs)
    assert {t for _, t, _ in expected} >= {"nick0", "nick2"} and len({c for *_, c in expected}) == 2
    frame = documents(docs + again)
    text = pii.full_text()
    own = frame.select("doc_id", pii.row_hash("text").alias("row_hash"), text.alias("text")).withColumn("spans", pii._base(pii.F.col("text")))
    based = own.select("doc_id", "row_hash", pii._surroundings(pii.F.col("text"), pii.F.col("spans")).alias("near"))
    got = pii.disclosing_terms(frame, based)
    assert {tuple(r) for r in got.collect()} == expected
    spans = pii.find_pii(frame).where("size(terms) > 0").select("doc_id").distinct().count()
    assert spans == len({i for i, t in docs if any(e in t and re.search(rf"\b{w}\b", t) for e, w, _ in expected)})


def test_words_are_counted_before_the_join_with_candidates(documents):
    """The plan that Spark makes has no join between the words' occurrences and their count."""
    frame = documents(entities_and_terms())
    text = pii.full_text()
    own = frame.select("doc_id", pii.row_hash("text").alias("row_hash"), text.alias("text")).withColumn("spans", pii._base(pii.F.col("text")))
    based = own.select("doc_id", "row_hash", pii._surroundings(pii.F.col("text"), pii.F.col("spans")).alias("near"))
    plan = pii.disclosing_terms(frame, based)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(plan) if "Generate explode" in line)
    above = [line for line in plan[:at] if line.index(line.lstrip(" :+-")) < plan[at].index("Generate")]
    counted = max(i for i, line in enumerate(above) if "Aggregate" in line)
    assert not any("Join" in line for line in above[counted:])


def test_sanitised_texts_have_their_length(documents):
    got = pii.sanitise(documents(entities_and_terms())).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in got) and any("<EMAIL>" in r["text"] for r in got)


FORMS = [
    ("HTTPS://A.org:443/x/./y/../%7Ez%2f%zz?q=1#f", "a.org/x/~z%2F%zz?q=1"),
    ("http://a.org:80/../../b/.", "a.org/b"),
    ("http://a.org:443/%41%2D%5f%C3%a9", "a.org:443/A-_%C3%A9"),
    ("https://a.org:80", "a.org:80"),
    ("http://a.org/a//b/..c/...", "a.org/a//b/..c/..."),
    ("http://a.org/%2e%2E/x/%2", "a.org/x/%2"),
    ("ftp://a.org:21/%", "a.org:21/%"),
    ("http://a.org/x/..?utm_a=1&b=2&gclid=3", "a.org?b=2"),
    ("no scheme/../x", None),
    (None, None),
]


def test_addresses_have_one_form(spark):
    frame = spark.createDataFrame([(u,) for u, _ in FORMS], "url string")
    assert [r[0] for r in frame.select(url_filters.node_of(frame["url"])).collect()] == [n for _, n in FORMS]


def test_links_to_other_spellings_of_a_blocked_address(spark):
    pages = [
        (1, "https://i.org/a/b", link("../../../bad/x")),
        (2, "https://j.org/", link("https://BAD.net:443/%41")),
        (3, "https://k.org/", link("http://bad.net:80/q/../A")),
        (4, "https://l.org/", link("https://i.org/bad/./x")),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rules = url_filters.rule_table(spark, [("block", "net", "/A"), ("block", "i.org", "/bad/")])
    got = {r["page_id"]: r["verdict"] for r in url_filters.filter_urls(df, rules).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block"}


def test_verdicts_are_those_of_union_find(spark):
    """A chain, a hub, a ring and random links, with blocked and allowed addresses among them."""
    rng = np.random.default_rng(6)
    n, hosts = 400, []
    for i in range(n):
        hosts.append(f"n{i}.{['org', 'net', 'com'][int(rng.integers(0, 12)) // 5] if i > 120 else 'org'}")
    links = {i: i + 1 for i in range(60)}  # a chain, blocked at its end
    links |= {i: 100 for i in range(62, 100)}  # a hub, allowed
    links |= {i: 102 + (i - 101) % 15 for i in range(102, 117)}  # a ring of no verdict
    links |= {int(i): int(rng.integers(121, n)) for i in rng.choice(np.arange(121, n), 150, replace=False)}
    rules = [("block", "net", "/"), ("block", hosts[60], "/"), ("block", hosts[62], "/"), ("allow", hosts[100], "/"), ("allow", "com", "/p/3")]
    url = [f"https://{h}/p/{i}" for i, h in enumerate(hosts)]
    pages = [(i, url[i], link(url[links[i]]) if i in links else "<p>x</p>") for i in range(n)]

    def rule_of(i):
        fits = [(len(h + p), a == "allow", a) for a, h, p in rules if f".{hosts[i]}".endswith(f".{h}") and f"/p/{i}".startswith(p)]
        return max(fits)[2] if fits else None

    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links.items():
        root[find(a)] = find(b)
    said = {}
    for i in range(n):
        said.setdefault(find(i), set()).add(rule_of(i))
    expected = {}
    for i in range(n):
        of = said[find(i)]
        expected[i] = rule_of(i) or ("allow" if "allow" in of or "block" not in of else "block")
    assert list(expected.values()).count("block") > 80 and expected[0] == expected[59] == "block"
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in url_filters.filter_urls(frame, url_filters.rule_table(spark, rules)).collect()}
    assert got == expected
