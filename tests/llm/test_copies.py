"""Suffix-array dedup, SimHash near-dedup, packing, sharding, the classifier and the pipeline."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from repotide.llm import packing, quality_gam, sharding, simhash, suffix_dedup
from repotide.llm.common import gapless
from repotide.llm.components import components
from tests.llm import plain
from tests.llm.conftest import ODD
from tests.llm.test_filters import corpus, rows_of


# ---- suffix arrays ----


@pytest.mark.parametrize("letters", [1, 2, 4, 26])
def test_suffixes_and_prefixes(letters):
    rng = random.Random(letters)
    for n in (0, 1, 2, 49, 50, 51, 400):
        data = np.array([97 + rng.randrange(letters) for _ in range(n)] * 2, np.uint8)
        text = data.tobytes()
        order, group = suffix_dedup.suffix_array(data)
        assert [text[i : i + 50] for i in order] == sorted(text[i : i + 50] for i in range(len(text)))
        full = [i for i in range(len(text)) if i + 50 <= len(text)]
        assert all((group[i] == group[j]) == (text[i : i + 50] == text[j : j + 50]) for i in full[::7] for j in full)
        shared = suffix_dedup.common_prefixes(data, order)
        for k in range(1, len(text)):
            a, b = text[order[k - 1] :][:50], text[order[k] :][:50]
            assert shared[k] == next((m for m, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("block", [100, 1000, 1 << 20])
def test_blocks_are_merged(block):
    rng = random.Random(block)
    texts = [bytes(rng.choices(b"ab", k=rng.randrange(50, 120))) for _ in range(60)]
    texts += [t[3:60] + b"zz" for t in texts if len(t) > 60]
    owners = np.array([rng.randrange(1000) for _ in texts])
    low = defaultdict(lambda: 1 << 62)
    for text, owner in zip(texts, owners, strict=True):
        for p in range(len(text) - 49):
            low[text[p : p + 50]] = min(low[text[p : p + 50]], owner)
    got = suffix_dedup.earliest(texts, owners, block)
    assert [g.tolist() for g in got] == [[low[t[p : p + 50]] for p in range(len(t) - 49)] for t in texts]


def test_blocks_without_a_common_key_are_not_compared(monkeypatch):
    rng = random.Random(5)
    # every key has letters of its own, so that its texts have no string of another key
    groups = [[bytes(rng.choices(letters, k=rng.randrange(50, 120))) for _ in range(20)] for letters in (b"ab", b"cd", b"ef", b"gh", b"ij")]
    texts = [t for g in groups for t in [*g, *[x[3:60] + x[:9] for x in g]]]
    keys = np.repeat(np.arange(5), 40)
    owners = np.array([rng.randrange(1000) for _ in texts])
    expected = suffix_dedup.earliest(texts, owners, 1 << 20)
    found, calls = np.searchsorted, []
    monkeypatch.setattr(np, "searchsorted", lambda *a, **k: calls.append(1) or found(*a, **k))
    got = suffix_dedup.earliest(texts, owners, 700, keys)
    blocks = sum(map(len, texts)) // 700
    assert [g.tolist() for g in got] == [e.tolist() for e in expected]
    assert 0 < len(calls) < blocks * blocks / 4


def repetitive(n=120, seed=4):
    rng = random.Random(seed)
    passages = [" ".join(f"p{rng.randrange(400)}é" for _ in range(rng.randrange(6, 60))) for _ in range(8)]
    out = []
    for i in range(n):
        parts = [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(1, 60))) for _ in range(3)]
        parts.insert(1, rng.choice(passages)[rng.randrange(20) :])
        out.append((i, rng.choice([" ", "\n"]).join(parts)))
    out += [(n + k, out[k][1]) for k in range(20)] + [(n + 20, "ab" * 200), (n + 21, "ab" * 150), (n + 22, "z" * 49), (n + 23, "z" * 50), (n + 24, "z" * 51)]
    rng.shuffle(out)
    return out


def test_removed_bytes(documents, monkeypatch):
    docs = repetitive()
    monkeypatch.setattr(suffix_dedup, "LEAST_GROUP", 4000)
    monkeypatch.setattr(suffix_dedup, "MOST_GROUP", 4000)
    got = {r[0]: tuple(r[1:]) for r in suffix_dedup.removed(documents(docs)).collect()}
    assert got == plain.repeats(docs)
    assert sum(r[1] for r in got.values()) > 5000


def test_suffix_dedup_shares_the_documents_exchange(documents):
    df = suffix_dedup.removed(documents(repetitive(20)))
    df.collect()
    assert df._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") >= 2


def test_suffix_dedup_bears_odd_rows(clashing, none):
    got = suffix_dedup.removed(clashing, with_kept=True).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(ODD) and by_id[5]["n_removed"] == 0 and by_id[6]["kept"] == b""
    assert by_id[8]["n_removed"] == 0 and by_id[7]["n_removed"] == 0
    assert suffix_dedup.removed(none).count() == 0


# ---- SimHash ----


def test_fingerprints(odd):
    got = simhash.near_duplicates(odd).select("doc_id", "fingerprint")
    assert rows_of(got) == sorted([(r[0], f"{plain.simhash(r[1]):016x}") for r in ODD], key=repr)


def nearby(spark, n=300):
    rng = random.Random(8)
    base = [rng.getrandbits(64) for _ in range(n // 10)]
    values = set()
    for b in base:
        for _ in range(10):
            v = b
            for bit in rng.sample(range(64), rng.randrange(6)):
                v ^= 1 << bit
            values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    return spark.createDataFrame([(v,) for v in signed], "fp long"), signed


@pytest.mark.parametrize("parts, distance", [(1, 1), (2, 3), (3, 3), (4, 3), (5, 4)])
def test_links_are_all_found_once(spark, parts, distance):
    nodes, values = nearby(spark)
    got = rows_of(simhash.links(nodes, distance, parts))
    expected = [(a, b) for a in values for b in values if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= distance]
    assert got == sorted(expected, key=repr) and expected


def test_thresholds_add_up_at_least_cost():
    rng = np.random.default_rng(0)
    for parts in (1, 2, 3, 4):
        widths = [64 // parts] * parts
        counts = [[rng.integers(0, 9, 256) ** 3 for _ in range(w // 8)] for w in widths]
        got = simhash.allocate(counts, widths, 1000)
        assert sum(got) == 3 - parts + 1 and min(got) >= -1


def test_components(spark, documents):
    rng = random.Random(2)
    nodes = list(range(400))
    edges = {tuple(rng.sample(nodes, 2)) for _ in range(230)} | {(i, i + 1) for i in range(50)} | {(399, i) for i in range(300, 380)}
    joined = {frozenset(e) for e in edges}
    expected = plain.grouped(nodes, lambda a, b: frozenset((a, b)) in joined)
    df = spark.createDataFrame([*edges, (5, 5), (None, 3), (7, None)], "x long, y long")
    got = dict(map(tuple, components(df).collect()))
    assert got == {i: expected[i] for i in {x for e in edges for x in e}}
    assert components(df.limit(0)).count() == 0


def test_near_copies_are_grouped(documents):
    docs = corpus(60)
    near = [(100 + i, t.replace(t.split()[5], "changed", 1)) for i, t in docs[:20]] + [(200 + i, t) for i, t in docs[:10]]
    every = docs + near
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(documents(every)).collect()}
    prints = {i: plain.simhash(t) for i, t in every}
    assert got == plain.grouped(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    kept = simhash.keep_first(documents(every))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(got.values()))


def test_simhash_bears_odd_rows(clashing, none):
    kept = simhash.keep_first(clashing)
    assert kept.columns == clashing.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(7) == 1 and 1 in ids and 2 not in ids and 6 not in ids and None in ids
    assert simhash.keep_first(none).count() == 0


# ---- packing ----


def checked(rows, docs, length):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    left = sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=repr)
    expected = []
    for i, text, *_ in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), length)):
            part = ids[start : start + length]
            expected.append((i, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert left == sorted(expected, key=repr)
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= length
    return len(places)


def test_packing(documents):
    docs = corpus(300) + [(i + 500, " ".join(f"t{k}" for k in range(i))) for i in range(0, 600, 7)]
    rows = packing.pack(documents(docs), length=256).collect()
    used = checked(rows, docs, 256)
    least = -(-sum(r["length"] for r in rows) // 256)
    assert least <= used <= least * 1.02 + 1


@pytest.mark.parametrize("seed", range(6))
def test_plan_fills_sequences(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 50, 100])
    counts = {s: rng.randrange(1, 30) for s in rng.sample(range(1, capacity + 1), capacity // 2)}
    plan = packing.Plan(counts, capacity)
    seen, room = defaultdict(int), defaultdict(int)
    for size, first, sequence, each, offset in plan.runs:
        assert first == seen[size]
        later = [r[1] for r in plan.runs if r[0] == size and r[1] > first]
        n = (min(later) if later else counts[size]) - first
        seen[size] += n
        for k in range(n):
            at = sequence + k // each
            assert room[at] == offset + (k % each) * size
            room[at] += size
    assert dict(seen) == counts and max(room.values()) <= capacity and len(room) == plan.sequences
    assert plan.sequences <= -(-sum(s * n for s, n in counts.items()) // capacity) * 1.25 + 1


def test_words_are_encoded_like_texts():
    path = public_tokenizers.path(packing.TOKENIZER)
    texts = [
        "it's. it's, IT'S 'tis don't.. a'b c'. d'.' x<|endoftext|>y <|STARTOFTEXT|> É. é é, 3.14. abc1. ...a..b.. İ. AΣ x y. z\x0b.\x1cq.",
        "ß. ﬁ. 's. 'S. 've! we'Ve!", " .a . b", "", "\n", "a.", *[t for _, t in corpus(20)], *plain.KINDS.values(),
    ]
    tokenizer = Tokenizer.from_file(path)
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in packing.Encoder(path).encode(texts)] == expected


def test_packing_bears_odd_rows(clashing, none):
    rows = packing.pack(clashing, with_ids=True).collect()
    checked(rows, ODD, 2048)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)
    assert packing.pack(none).count() == 0


# ---- sharding ----


def jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash():
    keys = np.random.default_rng(0).integers(0, 1 << 63, 3000).astype(np.uint64)
    for shards in (1, 2, 24, 25, 1000):
        got = sharding.jump_hash(keys, shards)
        assert got.tolist() == [jump(int(k), shards) for k in keys]
    before, after = sharding.jump_hash(keys, 24), sharding.jump_hash(keys, 25)
    moved = before != after
    assert set(after[moved]) == {24} and 0.02 < moved.mean() < 0.06


def test_sharding(odd, clashing, none):
    rows = sharding.place(odd).collect()
    facts = sorted(((r["doc_id"], r["size"], r["text_crc32"], r["law"]) for r in rows), key=repr)
    data = [(r[0], (r[1] or "").encode()) for r in ODD]
    assert facts == sorted([(i, len(b) + 8, zlib.crc32(b), "key") for i, b in data], key=repr)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert 0 <= r["shard"] < 24 and r["grown_shard"] in (r["shard"], 24)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_documents(clashing.drop("shard")).columns == [*clashing.drop("shard").columns, "shard"]
    assert sharding.place(none).count() == 0


def test_gapless_numbers_do_not_change(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), "id")
    got = gapless(df, ["k"], ["id"], "n", 7)
    assert rows_of(got) == rows_of(gapless(df.repartition(5), ["k"], ["id"], "n", 7))
    by = defaultdict(list)
    for r in got.collect():
        by[r["k"]].append(r["n"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


# ---- classifier ----


def labelled(spark, n=600):
    good = corpus(n, seed=1)
    docs = [(i, t if i % 4 else t.upper().replace(" ", "!! ")) for i, t in good]
    return docs, spark.createDataFrame([(i, int(i % 4 > 0), 0) for i, _ in docs] + [(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, documents):
    docs, labels = labelled(spark)
    rows = quality_gam.classify(documents(docs), labels).collect()
    out = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert np.mean([r["predicted"] == (r["doc_id"] % 4 > 0) for r in out]) > 0.97


def test_held_out_labels_are_not_learnt(spark, documents):
    docs, labels = labelled(spark)
    turned = labels.withColumn("quality", F.when(quality_gam.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r["doc_id"]: r["score"] for r in quality_gam.classify(documents(docs), labels).collect()}
    b = {r["doc_id"]: r["score"] for r in quality_gam.classify(documents(docs), turned).collect()}
    assert a == b


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(["a", "b", "c"], x, y)
    assert (0, 1) in model.pairs and ((model.score(x) > 0.5) == y).mean() > 0.95


def test_classifier_bears_odd_rows(spark, clashing, none):
    labels = spark.createDataFrame([(5, 1), (4, 0), (None, None)], "doc_id long, quality int")
    rows = quality_gam.classify(clashing, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in quality_gam.classify(clashing, labels.limit(0)).collect()} == {0.5}
    assert quality_gam.classify(none, labels).count() == 0


# ---- pipeline ----


def test_pipeline(spark, tmp_path, documents):
    sample = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = sample.unionByName(documents(ODD))
    item = spark.createDataFrame([(1, " ".join(sample.where("n_chars > 2000").first()["text"].split()[20:60]))], "item_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    item.write.parquet(f"{tmp_path}/benchmark.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = now
        now = stage(spark, now, str(tmp_path))
        now.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert now.columns == docs.columns and 0 < now.count() <= before.count()
    assert now.select("doc_id").distinct().count() == before.count()
    whole = corpus_pipeline.run(spark, str(tmp_path)).drop("sequence_id", "offset")
    assert rows_of(whole) == rows_of(now.drop("sequence_id", "offset"))


def test_the_sample_is_that_of_the_least_hashes(spark, documents, monkeypatch):
    """Counting by prefix first leaves the rows that a sort of all would give."""
    docs = [(i, f"some words of text {i} " * (1 + i % 7)) for i in range(600)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, quality int")
    features = quality_gam.statistics(documents(docs))
    seen = {}
    monkeypatch.setattr(quality_gam, "fit", lambda names, x, y: seen.update(x=x, y=y))
    for most in (50, 10_000):
        quality_gam.learn(features, labels, most)
        names = [c for c in features.columns if c != "doc_id"]
        known = features.where(~quality_gam.held_out()).join(labels, "doc_id")
        plain = known.orderBy(F.xxhash64("doc_id")).limit(most).toPandas()
        assert len(seen["y"]) == min(most, known.count()) and sorted(map(tuple, seen["x"])) == sorted(map(tuple, plain[names].to_numpy(float)))
    quality_gam.learn(features, labels.limit(0))
    assert len(seen["y"]) == 0
