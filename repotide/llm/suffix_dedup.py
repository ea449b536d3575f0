"""Suffix-array dedup: bytes of 50-byte strings that an earlier document has too.

Every 50-byte string is owned by its minimizer, the least hash among its 16-byte strings. Neighbouring strings
with the same minimizer form one stretch of text, and equal strings lie in stretches with equal minimizers. So:

1. documents are dealt to groups of bounded size; each group sends its distinct minimizers, as packed
   numbers, to buckets, and a bucket tells every group which of its own are found in other documents too;
2. only stretches with such a minimizer go on, once per group, to the minimizer's shard. A shard joins equal
   stretches. Where a minimizer has different stretches, their strings are compared by a suffix array,
   refined after Larsson and Sadakane (each round doubles the sorted length and sorts only groups that are
   still open), with common prefixes after Kasai. A shard's stretches are taken in blocks of bounded size
   with a suffix array each, and blocks that share a minimizer are merged by binary search of the one's strings in the other's;
3. the shard answers each group with the smallest doc_id of every string, and the group removes what is
   found in a smaller one than its own.

It is one lazy job; the documents' exchange is shared by the three steps that read it, and a lost
executor's part is done again from the exchanges. A passage in a third of all documents is sent once per group,
never once per document, and minimizers' buckets and shards are dealt by hash.

Defined results: a null or empty text has no bytes, and texts under 50 bytes lose none; a null doc_id is larger
than all others; rows with equal doc_ids do not remove each other's strings, and repeated rows get equal
results; an empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.llm.common import full_text, let_workers_import, table

WIDTH, GRAM = 50, 16
#: Bytes of text in a group (the least and the most), of numbers in a bucket, of a shard's share of the text.
LEAST_GROUP, MOST_GROUP, BUCKET, SHARD = 4 << 20, 64 << 20, 64 << 20, 12 << 20
#: Bytes of text that are hashed at a time, and bytes of stretches in one suffix array.
CHUNK, BLOCK = 1 << 20, 2 << 20
LAST = np.iinfo(np.int64).max


# ---- suffix arrays ----------------------------------------------------------------------------


def packed(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number, zeros after the end."""
    value = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    for size in (1, 2, 4):
        value = (value[:-size] << np.uint64(8 * size)) | value[size:]
    return value[: len(data)]


def suffix_array(data: np.ndarray, depth: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``depth`` bytes, and each position's group: the place of its first member."""
    n = len(data)
    first = packed(data)
    order = np.argsort(first, kind="stable")
    heads = np.empty(n, bool)
    heads[:1] = True
    np.not_equal(first[order[1:]], first[order[:-1]], out=heads[1:])
    group = np.empty(n, np.int64)
    group[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    done = 8
    while done < depth and n:
        step = min(done, depth - done)
        ends = np.append(heads[1:], True)
        open_places = np.flatnonzero(~(heads & ends))
        if not len(open_places):
            break
        at = order[open_places]
        behind = at + step
        second = np.where(behind < n, group[np.minimum(behind, n - 1)] + 1, 0)
        key = (group[at] << 32) | second
        turn = np.argsort(key, kind="stable")
        order[open_places] = at[turn]
        key = key[turn]
        heads[open_places[1:]] |= key[1:] != key[:-1]
        starts = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
        group[order[open_places]] = starts[open_places]
        done += step
    return order, group


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int = WIDTH) -> np.ndarray:
    """Bytes, up to ``depth``, that each suffix shares with the one before it in ``order``.

    After Kasai: what a suffix shares is at least one less than what the suffix one position to its left
    shares, unless that is all of ``depth``, beyond which ``order`` is not sorted. Even positions are compared
    from the start, odd ones from there on, eight bytes at a time.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    eights = np.append(packed(data), np.zeros(depth + 8, np.uint64))
    shared = np.zeros(n, np.int64)
    for parity in (0, 1):
        at = np.arange(parity, n, 2)
        if parity:
            left = shared[at - 1]
            shared[at] = np.where(left < depth, np.maximum(left - 1, 0), 0)
        at = at[before[at] >= 0]
        while len(at):
            now, other = at + shared[at], before[at] + shared[at]
            inside = np.maximum(now, other) < n
            at, now, other = at[inside], now[inside], other[inside]
            differ = eights[now] ^ eights[other]
            same = np.zeros(len(at), np.int64)
            for byte in range(8):
                same += differ < np.uint64(1 << (8 * byte))
            shared[at] = np.minimum(shared[at] + np.minimum(same, n - np.maximum(now, other)), depth)
            at = at[(same == 8) & (shared[at] < depth)]
    shared[before < 0] = 0
    return shared[order]


def earliest(texts: list[bytes], owners: np.ndarray, block: int = BLOCK, keys: np.ndarray | None = None) -> list[np.ndarray]:
    """For each text the least owner of every ``WIDTH``-byte string in it, by position.

    ``keys`` are numbers in ascending order, one a text, if texts with different ones have no string in common. Blocks
    without a common key are then not compared.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // block)) + 1
    blocks, least = [], []
    for part in np.split(np.arange(len(texts)), cuts):
        data = np.frombuffer(b"".join([texts[i] for i in part]), np.uint8)
        ends = np.cumsum(sizes[part])
        text = np.repeat(np.arange(len(part)), sizes[part])
        starts = np.flatnonzero(np.arange(len(data)) + WIDTH <= ends[text])
        order, _ = suffix_array(data)
        order_is_start = np.zeros(len(data), bool)
        order_is_start[starts] = True
        # a group runs on while neighbours share the full width
        number = np.cumsum(common_prefixes(data, order) < WIDTH) - 1
        keep = order_is_start[order]
        at, number = order[keep], number[keep]
        number = np.cumsum(np.diff(number, prepend=number[:1]) != 0)
        low = np.full(number.max(initial=-1) + 1, LAST)
        np.minimum.at(low, number, owners[part][text[at]])
        firsts = at[np.flatnonzero(np.diff(number, prepend=-1))]
        strings = np.lib.stride_tricks.sliding_window_view(data, WIDTH)[firsts] if len(firsts) else np.empty((0, WIDTH), np.uint8)
        strings = np.ascontiguousarray(strings).view(f"S{WIDTH}").ravel()
        blocks.append((part, at, number, low, strings, ends))
    for i, (part, *_, low, strings, _) in enumerate(blocks):
        for other_part, *_, other_low, other, _ in blocks[i + 1 :]:
            if keys is not None and len(part) and keys[part[-1]] != keys[other_part[0]]:
                break
            if len(strings) and len(other):
                where = np.minimum(np.searchsorted(strings, other), len(strings) - 1)
                found = strings[where] == other
                both = np.minimum(low[where[found]], other_low[found])
                low[where[found]] = both
                other_low[found] = both
    for part, at, number, low, _, ends in blocks:
        values = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
        values[at] = low[number]
        begins = ends - sizes[part]
        least += [values[a : b - WIDTH + 1] for a, b in zip(begins, ends, strict=True)]
    return least


# ---- stretches of text ------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Stretches(NamedTuple):
    """Text number, first and last + 1 of the strings' starts, and the mixed minimizer of each stretch."""

    text: np.ndarray
    first: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def _in_chunk(texts: list[bytes], number: int) -> Stretches:
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    count = len(data) - WIDTH + 1
    if count <= 0:
        none = np.empty(0, np.int64)
        return Stretches(none, none, none, none.view(np.uint64))
    eights = packed(data)
    hashes = _mixed(eights[:-8] * np.uint64(0x9E3779B97F4A7C15) + _mixed(eights[8:]))
    window, least = 1, hashes
    target = WIDTH - GRAM + 1
    while window < target:
        step = min(window, target - window)
        least = np.minimum(least[:-step], least[step:])
        window += step
    least = least[:count]
    owner = np.searchsorted(ends, np.arange(count), side="right")
    valid = np.arange(count) + WIDTH <= ends[owner]
    change = np.ones(count + 1, bool)
    change[1:count] = (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])
    edges = np.flatnonzero(change)
    first, end = edges[:-1], edges[1:]
    good = valid[first]
    first, end = first[good], end[good]
    text = owner[first]
    begin = ends[text] - sizes[text]
    return Stretches(text + number, first - begin, end - begin, _mixed(least[first]))


def stretches(texts: list[bytes]) -> Stretches:
    """All stretches of the texts, in order."""
    parts, held, size, number = [], [], 0, 0
    for k, text in enumerate(texts):
        held.append(text)
        size += len(text)
        if size >= CHUNK or k == len(texts) - 1:
            parts.append(_in_chunk(held, number))
            number, held, size = k + 1, [], 0
    if not parts:
        parts = [_in_chunk([], 0)]
    return Stretches(*[np.concatenate(x) for x in zip(*parts, strict=True)])


def _blob(values: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(values, kind).tobytes()


def _numbers(blob: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(blob, kind)


def _split(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of a hash and its number there."""
    return (hashes & np.uint64(0xFFFFFFFF)) % np.uint64(buckets), (hashes >> np.uint64(32)).astype(np.uint32)


class Shared(NamedTuple):
    """A group's stretches whose minimizer other documents have too."""

    runs: Stretches
    #: of each stretch: its shard and its number among the group's different ones there
    shard: np.ndarray
    number: np.ndarray
    #: by shard: the different stretches, the least and largest owner of each, its minimizer
    sent: dict[int, tuple[list[bytes], list[int], list[int], list[int]]]


def _shared(texts: list[bytes], owners: np.ndarray, known: pd.DataFrame, buckets: int, shards: int) -> Shared:
    runs = stretches(texts)
    bucket, value = _split(runs.hash, buckets)
    found = [np.uint64(b) << np.uint64(32) | _numbers(x, "<u4").astype(np.uint64) for b, x in zip(known["part"], known["a"], strict=True)]
    found = np.sort(np.concatenate(found)) if found else np.empty(0, np.uint64)
    whole = bucket << np.uint64(32) | value
    here = np.searchsorted(found, whole)
    mask = np.zeros(len(whole), bool) if not len(found) else found[np.minimum(here, len(found) - 1)] == whole
    runs = Stretches(*[x[mask] for x in runs])
    shard = (_mixed(runs.hash) % np.uint64(shards)).astype(np.int64)
    numbers = np.empty(len(shard), np.int64)
    index: dict[bytes, int] = {}
    sent: dict[int, tuple[list[bytes], list[int], list[int], list[int]]] = {}
    rows = zip(runs.text.tolist(), runs.first.tolist(), runs.end.tolist(), shard.tolist(), runs.hash.tolist(), strict=True)
    for k, (text, first, end, s, h) in enumerate(rows):
        piece = texts[text][first : end + WIDTH - 1]
        mine = sent.setdefault(s, ([], [], [], []))
        number = index.get(piece)
        owner = int(owners[text])
        if number is None:
            number = index[piece] = len(mine[0])
            for column, new in zip(mine, (piece, owner, owner, h), strict=True):
                column.append(new)
        else:
            mine[1][number] = min(mine[1][number], owner)
            mine[2][number] = max(mine[2][number], owner)
        numbers[k] = number
    return Shared(runs, shard, numbers, sent)


def _texts(docs: pd.DataFrame) -> tuple[list[bytes], np.ndarray]:
    return [t.encode("utf-8") for t in docs["text"]], docs["owner"].to_numpy(np.int64)


# ---- the job ----------------------------------------------------------------------------------

#: What travels between groups, buckets and shards: where to, where from or which part, and packed arrays.
MESSAGE = "to long, part long, a binary, b binary, c binary, d binary, e binary"


def _message(to: int, part: int, *blobs: bytes) -> tuple:
    return (to, part, *blobs, *[b""] * (5 - len(blobs)))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["to", "part", "a", "b", "c", "d", "e"])


def _sorted(docs: pd.DataFrame) -> pd.DataFrame:
    """A fixed order, so that numbers given in one step mean the same in another."""
    return docs.sort_values(["owner", "text"], kind="stable")


def removed(docs: DataFrame, with_kept: bool = False) -> DataFrame:
    """Per document its bytes, those removed, the removed runs and a digest of the rest.

    ``with_kept`` adds the remaining bytes as ``kept``; they need not be whole characters.
    """
    let_workers_import(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    group_bytes = min(max(total // 256, LEAST_GROUP), MOST_GROUP)
    groups = max(1, -(-total // group_bytes))
    buckets = max(8, total * 4 * 2 // (WIDTH - GRAM + 2) // BUCKET)
    shards = max(8, -(-total // SHARD))
    text = full_text()
    dealt = docs.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(int(LAST))).cast("long").alias("owner"),
        text.alias("text"),
        F.pmod(F.xxhash64("doc_id", text), F.lit(groups)).alias("to"),
    )

    def minimizers(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        texts, _ = _texts(own)
        runs = stretches(texts)
        turn = np.argsort(runs.hash, kind="stable")
        value, text = runs.hash[turn], runs.text[turn]
        first = np.flatnonzero(np.diff(value, prepend=~value[:1]))
        several = np.zeros(len(first), bool)
        if len(first):
            several = np.minimum.reduceat(text, first) != np.maximum.reduceat(text, first)
        bucket, number = _split(value[first], buckets)
        rows = []
        for b in np.unique(bucket):
            mine = bucket == b
            rows.append(_message(int(b), key[0], _blob(np.sort(number[mine & ~several]), "<u4"), _blob(np.sort(number[mine & several]), "<u4")))
        return _frame(rows)

    def repeated(key: tuple, sent: pd.DataFrame) -> pd.DataFrame:
        once = [_numbers(x, "<u4") for x in sent["a"]]
        several = [_numbers(x, "<u4") for x in sent["b"]]
        every = np.sort(np.concatenate([*once, *[np.repeat(x, 2) for x in several]]))
        common = every[1:][every[1:] == every[:-1]]
        common = common[np.append(True, common[1:] != common[:-1])[: len(common)]]  # sorted; np.unique would hash them
        rows = []
        for group, a, b in zip(sent["part"], once, several, strict=True):
            own = np.concatenate([a, b])
            if len(common):
                own = own[common[np.minimum(np.searchsorted(common, own), len(common) - 1)] == own]
                if len(own):
                    rows.append(_message(int(group), key[0], _blob(own, "<u4")))
        return _frame(rows)

    def to_shards(key: tuple, own: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(known) or not len(own):
            return _frame([])
        texts, owners = _texts(_sorted(own))
        sent = _shared(texts, owners, known, buckets, shards).sent
        return _frame(
            [
                _message(shard, key[0], b"".join(pieces), _blob([len(p) for p in pieces], "<i4"), _blob(low, "<i8"), _blob(high, "<i8"), _blob(h, "<u8"))
                for shard, (pieces, low, high, h) in sent.items()
            ]
        )

    def answers(key: tuple, sent: pd.DataFrame) -> pd.DataFrame:
        index: dict[bytes, int] = {}
        texts: list[bytes] = []
        ids, highs, lows, hashes = [], [], [], []
        for blob, sizes, low, high, h in zip(sent["a"], sent["b"], sent["c"], sent["d"], sent["e"], strict=True):
            ends = np.cumsum(_numbers(sizes, "<i4"))
            mine = []
            for a, b in zip((ends - _numbers(sizes, "<i4")).tolist(), ends.tolist(), strict=True):
                piece = blob[a:b]
                number = index.setdefault(piece, len(texts))
                if number == len(texts):
                    texts.append(piece)
                mine.append(number)
            ids.append(np.array(mine, np.int64))
            lows.append(_numbers(low, "<i8"))
            highs.append(_numbers(high, "<i8"))
            hashes.append(_numbers(h, "<u8"))
        every = np.concatenate(ids)
        least = np.full(len(texts), LAST)
        np.minimum.at(least, every, np.concatenate(lows))
        owner_hash = np.empty(len(texts), np.uint64)
        owner_hash[every] = np.concatenate(hashes)
        # a minimizer with one stretch only: its strings are in no other stretch
        _, inverse, n = np.unique(owner_hash, return_inverse=True, return_counts=True)
        open_ids = np.flatnonzero(n[inverse] > 1)
        open_ids = open_ids[np.argsort(owner_hash[open_ids], kind="stable")]
        runs: dict[int, list[tuple[int, int, int]]] = {}
        for i, values in zip(open_ids.tolist(), earliest([texts[i] for i in open_ids], least[open_ids], keys=owner_hash[open_ids]), strict=True):
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(values)) + 1, [len(values)]])
            runs[i] = [(int(a), int(b), int(values[a])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        rows = []
        for group, mine, high in zip(sent["part"], ids, highs, strict=True):
            out = []
            for number, (i, top) in enumerate(zip(mine.tolist(), high.tolist(), strict=True)):
                for a, b, low in runs.get(i) or [(0, len(texts[i]) - WIDTH + 1, int(least[i]))]:
                    if low < top:
                        out.append((number, a, b, low))
            if out:
                columns = np.array(out, np.int64)
                rows.append(_message(int(group), key[0], b"", *[_blob(columns[:, c], "<i8") for c in range(4)]))
        return _frame(rows)

    def cut(key: tuple, own: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        own = _sorted(own)
        texts, owners = _texts(own)
        known, replies = told[told["a"].str.len() > 0], told[told["a"].str.len() == 0]
        spans: dict[int, np.ndarray] = {}
        if len(replies):
            shared = _shared(texts, owners, known, buckets, shards)
            place = shared.shard << 32 | shared.number
            turn = np.argsort(place, kind="stable")
            place = place[turn]
            found = []
            for shard, n, a, b, low in zip(replies["part"], replies["b"], replies["c"], replies["d"], replies["e"], strict=True):
                n, a, b, low = (_numbers(x, "<i8") for x in (n, a, b, low))
                wanted = np.int64(shard) << 32 | n
                left, right = np.searchsorted(place, wanted), np.searchsorted(place, wanted, side="right")
                many = right - left
                row = np.repeat(np.arange(len(n)), many)
                member = turn[np.repeat(left, many) + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)]
                text, first = shared.runs.text[member], shared.runs.first[member]
                later = owners[text] > low[row]
                found.append(np.stack([text, first + a[row], first + b[row] + WIDTH - 1])[:, later])
            text, begin, end = np.concatenate(found, axis=1)
            turn = np.lexsort((begin, text))
            text, begin, end = text[turn], begin[turn], end[turn]
            for rows in np.split(np.arange(len(text)), np.flatnonzero(np.diff(text)) + 1):
                if len(rows):
                    reach = np.maximum.accumulate(end[rows])
                    new = np.flatnonzero(np.append(True, begin[rows][1:] > reach[:-1]))
                    spans[int(text[rows[0]])] = np.stack([begin[rows][new], reach[np.append(new[1:], len(rows)) - 1]], axis=1)
        out = []
        for k, (doc, data) in enumerate(zip(own["doc_id"], texts, strict=True)):
            gone = spans.get(k)
            rest = data
            if gone is not None:
                borders = [0, *gone.ravel().tolist(), len(data)]
                rest = b"".join([data[a:b] for a, b in zip(borders[::2], borders[1::2], strict=True)])
            out.append((doc, len(data), len(data) - len(rest), 0 if gone is None else len(gone), hashlib.sha256(rest).hexdigest(), *[rest] * with_kept))
        frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_kept])
        frame["doc_id"] = own["doc_id"].astype("Int64").to_numpy()
        return frame

    sent = dealt.groupBy("to").applyInPandas(minimizers, MESSAGE)
    known = sent.groupBy("to").applyInPandas(repeated, MESSAGE)
    pieces = dealt.groupBy("to").cogroup(known.groupBy("to")).applyInPandas(to_shards, MESSAGE)
    told = known.union(pieces.groupBy("to").applyInPandas(answers, MESSAGE))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_kept else "")
    return dealt.groupBy("to").cogroup(told.groupBy("to")).applyInPandas(cut, schema)


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(table(spark, sf_dir, "documents"))
