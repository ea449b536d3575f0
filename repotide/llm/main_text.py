"""Main text of web pages by a suffix array over each host's pages.

A page is cut into blocks at block elements. Where it marks its article (``article``, else ``main``), the
blocks inside are the article's, less those in elements that say what they are (navigation, asides, forms,
adverts, notices, comments and so on). The words of all blocks of a page, inside and outside, are its token stream, in which
the host's boilerplate is searched:

1. Pages are dealt by a hash of host and stream to shards of ``SHARD_TOKENS`` to ``MOST_TOKENS``, once, as packed blocks.
   Streams that a host repeats word for word lie in one shard and count once there.
2. A shard's streams are concatenated, with tokens of their hosts. A suffix array by prefix doubling sorts all
   suffixes by their first ``RUN`` tokens; equal neighbours of different streams are strings that the host repeats.
3. Shards are merged by string. The leading bits of all different strings' hashes go to buckets, sorted and as differences,
   and a bucket tells every shard which of its own another shard may have; of those alone the whole 64-bit hashes are
   compared in the same way. Replies are bits in the order of the shard's strings. What they mark is found by binary search,
   and overlapping strings join to runs.
4. Covered runs are removed and unique runs kept. In a page that marks its article, the marks then check the outcome: what
   other pages repeat of the article is put back (``n_restored``), since copies of an article are no boilerplate, and
   what is unique outside it goes.

No task holds more than a shard and a page, or a bucket of ``BUCKET`` numbers; a host with a third of all pages is dealt over
all shards. Strings are compared by 64-bit hashes.

Defined results: null or empty html, or html without text, gives an empty text; null and odd addresses share the
host of the empty name; repeated rows get equal results and count as one page; markup that is cut off or not
closed ends with the page; pages of any length are read whole, each by one task; an empty table gives no
rows. Columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.llm.common import let_workers_import, table
from repotide.llm.url_filters import host_of

#: Tokens in the shortest string that counts as repeated: a power of two.
RUN = 8
#: Tokens of a shard, and of the largest ones; larger tables have larger shards.
SHARD_TOKENS, MOST_TOKENS = 1 << 20, 1 << 22
#: Bytes of html that are taken as one token when shards are counted.
TOKEN_BYTES = 6
#: Numbers in a bucket, and bits of a number beyond those that tell all strings apart on average.
BUCKET, SPARE_BITS = 1 << 23, 7
#: Runs that were broadcast at most. Runs stay in their shards now, so that nothing is broadcast.
BROADCAST_RUNS = 200_000
#: Stands where a stream has a gap.
GAP = 0

#: Element names.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never part of an article.
ASIDE = frozenset(
    "aside audio button canvas datalist dialog footer form head iframe map menu nav noscript object search select svg template "
    "textarea video".split()
)
#: Words of class, id and role that say the same.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement alert banner breadcrumb breadcrumbs comment comments complementary consent contentinfo "
    "cookie cookies dialog disqus footer masthead menu modal nav navbar navigation newsletter notice notices popup promo related "
    "search share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
#: Elements that are closed by a later one of these.
CLOSED_BY = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
#: An open paragraph or item is searched no further out than these.
BARRIERS = frozenset("article aside body div footer form header main nav ol section table td th ul".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|textarea|iframe|noframes|xmp)(?=[\s/>]).*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<rest>(?>[^>\"']+|\"[^\"]*\"|'[^']*')*)>"
    r"|<[a-z/!?][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
NAMED = re.compile(r"(?:^|[\s\"'/])(class|id|role|aria-hidden|hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?", re.IGNORECASE)
WORDS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


def _marks(rest: str) -> tuple[bool, bool]:
    """Whether attributes say that an element is no part of an article, and whether they say it is the main one."""
    aside = main = False
    for name, value in NAMED.findall(rest):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden":
            aside |= name == "hidden" or value.lower() == "true"
        else:
            words = {w.lower() for w in WORDS.findall(value)}
            main |= name == "role" and bool(words & {"main", "article"})
            aside |= bool(words & ASIDE_WORDS)
    return aside, main


def blocks_of(html: str) -> list[tuple[str, bool, bool, bool]]:
    """Text, in article, in main, aside: of every block with text, in page order."""
    out: list[tuple[str, bool, bool, bool]] = []
    parts: list[str] = []
    # open elements: name, in article, in main, aside, in a header of an article
    stack = [("", False, False, False, False)]

    def flush() -> None:
        text = " ".join(references.unescape("".join(parts)).split())
        parts.clear()
        if text:
            _, article, main, aside, header = stack[-1]
            heading = any(e[0] in HEADINGS for e in stack[-3:])
            out.append((text, article, main, aside or (header and not heading)))

    at = 0
    for token in TOKEN.finditer(html):
        if token.start() > at:
            parts.append(html[at : token.start()])
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            continue
        if name == "br":
            parts.append(" ")
        if name in BLOCKS:
            flush()
        if token["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        if name in VOID:
            continue
        for k in range(len(stack) - 1, 0, -1):
            if name in CLOSED_BY.get(stack[k][0], ()):
                del stack[k:]
                break
            if stack[k][0] in BARRIERS:
                break
        if token["rest"].endswith("/") and name not in BLOCKS:
            continue
        _, article, main, aside, header = stack[-1]
        says_aside, says_main = _marks(token["rest"]) if token["rest"] else (False, False)
        if name == "header":
            header, aside = header or article or main, aside or not (article or main)
        if name not in ("html", "body", "article", "main") or article or main:
            aside |= says_aside or name in ASIDE
        stack.append((name, article or name == "article", main or name == "main" or says_main, aside, header))
    if at < len(html):
        parts.append(html[at:])
    flush()
    return out


def hashed(words: list[str]) -> np.ndarray:
    """A 32-bit hash of each word, never GAP; strings of ``RUN`` words are compared by 64 bits."""
    table = {w: xxhash.xxh32_intdigest(w) or 1 for w in set(words)}
    return np.fromiter(map(table.__getitem__, words), np.int64, len(words))


def page_blocks(html: str | None) -> tuple[bool, list[str], list[bool]]:
    """Whether the page marks its article; all blocks, and whether each is aside or outside that article."""
    blocks = blocks_of(html or "")
    scope = next((k for k in (1, 2) if any(b[k] and not b[3] for b in blocks)), None)
    return scope is not None, [b[0] for b in blocks], [b[3] or (scope is not None and not b[scope]) for b in blocks]


def page_parts(html: str | None) -> tuple[str | None, list[str], list[bool], np.ndarray]:
    """The text of a marked article, else None; all blocks with whether they are aside; the page's token stream."""
    marked, blocks, asides = page_blocks(html)
    return unique_text(blocks, asides) if marked else None, blocks, asides, hashed(" ".join(blocks).split(" ") if blocks else [])


def string_hashes(tokens: np.ndarray, width: int = RUN) -> np.ndarray:
    """Hash of the ``width`` tokens from each place on."""
    n = max(0, len(tokens) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = (out ^ tokens[k : k + n].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def suffix_ranks(tokens: np.ndarray, width: int = RUN) -> np.ndarray:
    """Rank of every suffix by its first ``width`` tokens; equal ranks are equal strings.

    Prefix doubling: ranks by h tokens, taken in pairs, give ranks by 2h. Gaps differ from everything, so no
    string goes over one.
    """
    order = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    gaps = np.flatnonzero(tokens == GAP)
    rank = order + 1
    rank[gaps] = order.max(initial=0) + 2 + np.arange(len(gaps))
    length = 1
    while length < width:
        after = np.concatenate([rank[length:], np.zeros(min(length, len(rank)), np.int64)])[: len(rank)]
        # a suffix that ends at once is lower than any other and, being of its own length, equal to none
        pairs = rank * (rank.max(initial=0) + 1) + after
        rank = np.unique(pairs, return_inverse=True)[1].astype(np.int64) + 1
        length *= 2
    return rank


def _sorted_once(numbers: np.ndarray) -> np.ndarray:
    numbers = np.sort(numbers)  # np.unique without inverse goes by a hash table, which takes many times longer
    return numbers[np.append(True, numbers[1:] != numbers[:-1])[: len(numbers)]]


def _packed(numbers: np.ndarray) -> bytes:
    """Sorted numbers as compressed differences, byte by byte of their places."""
    steps = np.diff(numbers, prepend=np.uint64(0))
    return len(numbers).to_bytes(8, "little") + pa.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def _unpacked(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    places = np.frombuffer(pa.decompress(blob[8:], 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(places.T).view(np.uint64).ravel(), dtype=np.uint64)


def _bits(mask: np.ndarray) -> bytes:
    return pa.compress(np.packbits(mask).tobytes(), "zstd", asbytes=True)


def _mask(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(pa.decompress(blob, -(-n // 8), "zstd", asbytes=True), np.uint8), count=n).astype(bool)


def _text_of(blob: bytes, size: int) -> bytes:
    return pa.decompress(blob, size, "zstd", asbytes=True)


class Streams(NamedTuple):
    """A shard's different streams one after the other, each with a gap after it."""

    #: places of the streams' rows in the shard
    rows: np.ndarray
    tokens: np.ndarray
    #: each token's stream
    of: np.ndarray
    #: places of whole strings, without gaps, and the strings' hashes
    starts: np.ndarray
    hashes: np.ndarray


def _streams(shard: pa.Table) -> Streams:
    """The shard's streams of ``RUN`` tokens or more, once each, with tokens that differ from host to host."""
    rows = np.sort(np.unique(shard.column("stream").to_numpy(), return_index=True)[1])
    texts = [_text_of(b, n).replace(b"\n", b" ") for b, n in zip(shard.column("blocks").take(rows).to_pylist(), shard.column("size").take(rows).to_pylist())]
    long = np.array([t.count(b" ") + 1 >= RUN for t in texts], bool)
    rows, texts = rows[long], [t for t, keep in zip(texts, long.tolist()) if keep]
    words = pc.split_pattern(pa.array(texts, pa.large_binary()), b" ")
    lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.flatten().dictionary_encode()
    known = np.fromiter((xxhash.xxh32_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    hosts = np.repeat(shard.column("host").to_numpy()[rows].view(np.uint64), lengths)
    own = (known[coded.indices.to_numpy(zero_copy_only=False)] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ hosts
    own = (own ^ (own >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    own[own == GAP] = 1
    tokens = np.insert(own.view(np.int64), np.cumsum(lengths), GAP)
    gaps_until = np.concatenate([[0], np.cumsum(tokens == GAP)])
    starts = np.arange(max(0, len(tokens) - RUN + 1))
    starts = starts[gaps_until[starts + RUN] == gaps_until[starts]]
    return Streams(rows, tokens, np.repeat(np.arange(len(lengths)), lengths + 1), starts, string_hashes(tokens)[starts].view(np.uint64))


def _strings(streams: Streams) -> tuple[np.ndarray, np.ndarray]:
    """The shard's different strings, as sorted hashes, and whether several of its streams have them."""
    ranks = suffix_ranks(streams.tokens)[streams.starts]
    turn = np.argsort(ranks, kind="stable")
    first = np.flatnonzero(np.diff(ranks[turn], prepend=-1))
    # equal suffixes stand together, in the order of their streams
    of = streams.of[streams.starts][turn]
    last = np.append(first[1:], len(of))[: len(first)] - 1
    several, strings = of[first] != of[last], streams.hashes[turn[first]]
    turn = np.argsort(strings, kind="stable")
    strings, several = strings[turn], several[turn]
    first = np.flatnonzero(np.append(True, strings[1:] != strings[:-1])[: len(strings)])
    return strings[first], np.logical_or.reduceat(several, first) if len(first) else several


def _ends(strings: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's part of the sorted strings ends."""
    bucket = ((strings >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(bucket, np.arange(buckets, dtype=np.uint64), side="right")


#: What travels between shards and buckets: where to, where from, whether whole hashes, and packed arrays.
MESSAGE = pa.schema([("to", pa.int64()), ("part", pa.int64()), ("whole", pa.bool_()), ("numbers", pa.binary()), ("several", pa.binary())])
_MESSAGE = "to long, part long, whole boolean, numbers binary, several binary"


def _messages(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_pylist([dict(zip(MESSAGE.names, r)) for r in rows], MESSAGE)


def _met(key: tuple, sent: pa.Table) -> pa.Table:
    """Tells every shard which of its numbers other shards have too."""
    own = [_unpacked(b) for b in sent.column("numbers").to_pylist()]
    every = np.sort(np.concatenate([_sorted_once(x) for x in own]))
    common = _sorted_once(every[1:][every[1:] == every[:-1]])
    rows = []
    for part, whole, several, x in zip(sent.column("part").to_pylist(), sent.column("whole").to_pylist(), sent.column("several").to_pylist(), own):
        if len(common):
            found = common[np.minimum(np.searchsorted(common, x), len(common) - 1)] == x
        else:
            found = np.zeros(len(x), bool)
        rows.append((part, key[0].as_py(), whole, _bits(found), several))
    return _messages(rows)


def _told(strings: np.ndarray, buckets: int, told: pa.Table, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which strings the buckets marked, and which several streams of the shard have."""
    ends = _ends(strings, buckets)
    marked, several = np.zeros(len(strings), bool), np.zeros(len(strings), bool)
    told = told.filter(pc.equal(told.column("whole"), whole))
    for bucket, bits, own in zip(told.column("part").to_pylist(), told.column("numbers").to_pylist(), told.column("several").to_pylist()):
        a, b = (int(ends[bucket - 1]) if bucket else 0), int(ends[bucket])
        marked[a:b] = _mask(bits, b - a)
        if own is not None:
            several[a:b] = _mask(own, b - a)
    return marked, several


def _covered(streams: Streams, repeated: np.ndarray) -> list[list[int]]:
    """Runs of each stream that repeated strings (sorted) cover: start and end in turn."""
    runs: list[list[int]] = [[] for _ in range(len(streams.rows))]
    if not len(repeated):
        return runs
    at = np.minimum(np.searchsorted(repeated, streams.hashes), len(repeated) - 1)
    hits = streams.starts[repeated[at] == streams.hashes]
    depth = np.zeros(len(streams.tokens) + 1, np.int64)
    depth[hits] += 1
    depth[hits + RUN] -= 1
    covered = (np.cumsum(depth)[:-1] > 0) & (streams.tokens != GAP)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]])))
    begins = np.flatnonzero(np.diff(streams.of, prepend=-1))
    for k, a, b in zip(streams.of[edges[::2]].tolist(), edges[::2].tolist(), edges[1::2].tolist()):
        runs[k] += [a - int(begins[k]), b - int(begins[k])]
    return runs


_PAGE = "page_id {id}, url string, host long, stream long, to long, marked boolean, size int, blocks binary, asides array<boolean>"


def _parsed(pages: DataFrame, shards: int) -> DataFrame:
    """Each page's blocks, compressed, with the shard that they go to."""

    def longs(numbers: list[int]) -> pa.Array:
        return pa.array(numbers, pa.uint64()).cast(pa.int64(), safe=False)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=6)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [page_blocks(h) for h in part.column("html").to_pylist()]
                texts = ["\n".join(f[1]).encode("utf-8", "replace") for f in found]
                streams = [xxhash.xxh3_64_intdigest(t.replace(b"\n", b" "), h % (1 << 64)) for t, h in zip(texts, part.column("host").to_pylist())]
                columns = [part.column("page_id"), part.column("url"), part.column("host"), longs(streams)]
                columns += [pa.array([x % shards for x in streams], pa.int64()), pa.array([f[0] for f in found], pa.bool_())]
                columns += [pa.array([len(t) for t in texts], pa.int32()), pa.array([codec.compress(t, asbytes=True) for t in texts], pa.binary())]
                columns += [pa.array([f[2] for f in found], pa.list_(pa.bool_()))]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "host", "stream", "to", "marked", "size", "blocks", "asides"])

    rows = pages.select("page_id", "url", F.xxhash64(host_of(F.col("url"))).alias("host"), "html")
    return rows.mapInArrow(parse, _PAGE.format(id=rows.schema["page_id"].dataType.simpleString()))


def _searched(pages: DataFrame, finish: Callable[[pa.Table, dict[int, list[int]]], pa.Table], schema: str) -> DataFrame:
    """``finish`` of every shard of pages and the runs of its streams."""
    let_workers_import(pages.sparkSession)
    total = pages.agg(F.sum(F.octet_length("html").cast("long"))).first()[0] or 0
    tokens = max(1, total // TOKEN_BYTES)
    shards = max(1, -(-tokens // min(max(tokens // 256, SHARD_TOKENS), max(SHARD_TOKENS, MOST_TOKENS))))
    buckets = max(8, -(-tokens // BUCKET))
    # a number of a string that is in one shard only meets another by chance once in 2 ** SPARE_BITS
    dropped = np.uint64(64 - min(64, max(1, tokens.bit_length() + SPARE_BITS)))

    def sent(strings: np.ndarray, shift: np.uint64, own: np.ndarray | None, shard: int) -> pa.Table:
        ends = _ends(strings, buckets)
        rows = []
        for bucket, (a, b) in enumerate(zip(np.append(0, ends[:-1]).tolist(), ends.tolist())):
            if b > a:
                rows.append((bucket, shard, own is None, _packed(strings[a:b] >> shift), None if own is None else _bits(own[a:b])))
        return _messages(rows)

    def numbers(key: tuple, shard: pa.Table) -> pa.Table:
        strings, several = _strings(_streams(shard))
        return sent(strings, dropped, several, key[0].as_py())

    def suspects(key: tuple, shard: pa.Table, told: pa.Table) -> pa.Table:
        if not told.num_rows:
            return _messages([])
        strings = _sorted_once(_streams(shard).hashes)
        return sent(strings[_told(strings, buckets, told, False)[0]], np.uint64(0), None, key[0].as_py())

    def finished(key: tuple, shard: pa.Table, told: pa.Table) -> pa.Table:
        streams = _streams(shard)
        strings = _sorted_once(streams.hashes)
        asked, several = _told(strings, buckets, told, False)
        repeated = strings[several]
        if asked.any():
            asked = strings[asked]
            repeated = _sorted_once(np.concatenate([repeated, asked[_told(asked, buckets, told, True)[0]]]))
        ids = shard.column("stream").to_numpy()[streams.rows].tolist()
        return finish(shard, {k: r for k, r in zip(ids, _covered(streams, repeated)) if r})

    # each step reads the one exchange of the pages
    parsed = _parsed(pages, shards)
    known = parsed.groupBy("to").applyInArrow(numbers, _MESSAGE).groupBy("to").applyInArrow(_met, _MESSAGE)
    confirmed = parsed.groupBy("to").cogroup(known.groupBy("to")).applyInArrow(suspects, _MESSAGE).groupBy("to").applyInArrow(_met, _MESSAGE)
    return parsed.groupBy("to").cogroup(known.union(confirmed).groupBy("to")).applyInArrow(finished, schema)


def _run_rows(shard: pa.Table, runs: dict[int, list[int]]) -> pa.Table:
    hosts = dict(zip(shard.column("stream").to_pylist(), shard.column("host").to_pylist()))
    columns = [pa.array([hosts[k] for k in runs], pa.int64()), pa.array(list(runs), pa.int64()), pa.array(list(runs.values()), pa.list_(pa.int32()))]
    return pa.table(columns, names=["host", "stream", "runs"])


def repeated_runs(pages: DataFrame) -> DataFrame:
    """host (hash), stream (hash) and runs: start and end of each covered run of a host's different streams."""
    return _searched(pages, _run_rows, "host long, stream long, runs array<int>")


def unique_text(blocks: list[str], asides: list[bool], runs: list[int] | None = None) -> str:
    """Blocks that are not aside, without the runs."""
    if runs is None or not len(runs):
        return "\n\n".join(block for block, aside in zip(blocks, asides) if not aside)
    out, at = [], 0
    bounds = np.array(runs, np.int64)
    for block, aside, gone in zip(blocks, asides, repeated_in(blocks, runs).tolist()):
        n = block.count(" ") + 1
        if not aside and not gone:
            out.append(block)
        elif not aside and gone < n:
            # an odd number of bounds lies at or before a covered token
            inside = np.searchsorted(bounds, np.arange(at, at + n), side="right") % 2 == 1
            out.append(" ".join(w for w, covered in zip(block.split(" "), inside.tolist()) if not covered))
        at += n
    return "\n\n".join(out)


def repeated_in(blocks: list[str], runs: list[int] | None) -> np.ndarray:
    """Number of each block's tokens that the runs cover."""
    edges = np.cumsum([0, *(b.count(" ") + 1 for b in blocks)])
    if runs is None or not len(runs):
        return np.zeros(len(blocks), np.int64)
    # covered tokens before a place grow by one a token inside a run, and stay between runs
    before = np.repeat(np.cumsum(np.diff(runs)[::2]), 2)
    return np.diff(np.interp(edges, runs, np.concatenate([[0], before[:-1]]))).astype(np.int64)


def decided(marked: bool, blocks: list[str], asides: list[bool], runs: list[int] | None) -> tuple[str, int]:
    """A page's text, and how many of its tokens are there though other pages of the host repeat them.

    What the host repeats goes and what is unique stays. In a page that marks its article the marks then check this:
    copies of an article are put back, and unique blocks outside it go.
    """
    if not marked:
        return unique_text(blocks, asides, runs), 0
    return unique_text(blocks, asides), int(repeated_in(blocks, runs)[~np.array(asides, bool)].sum())


def _text_rows(shard: pa.Table, runs: dict[int, list[int]]) -> pa.Table:
    rows = zip(*(shard.column(c).to_pylist() for c in ("stream", "marked", "size", "blocks", "asides")))
    out = [
        (*decided(marked, _text_of(blob, size).decode("utf-8").split("\n") if size else [], asides, runs.get(stream)), runs.get(stream, []))
        for stream, marked, size, blob, asides in rows
    ]
    columns = [shard.column("page_id"), shard.column("url"), pa.array([t for t, _, _ in out], pa.string()), shard.column("marked")]
    columns += [pa.array([sum(r[1::2]) - sum(r[::2]) for *_, r in out], pa.int64()), pa.array([n for _, n, _ in out], pa.int64())]
    return pa.table(columns, names=["page_id", "url", "text", "has_article", "n_repeated", "n_restored"])


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, has_article, n_repeated and n_restored of every page.

    ``n_repeated`` counts the page's tokens that the host repeats on other pages, ``n_restored`` those of them that stand in
    the marked article and stay.
    """
    id_type = pages.schema["page_id"].dataType.simpleString()
    out = _searched(pages, _text_rows, f"page_id {id_type}, url string, text string, has_article boolean, n_repeated long, n_restored long")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "has_article", "n_repeated", "n_restored")


def op12_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).drop("n_restored")
