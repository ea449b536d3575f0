"""Best-fit packing of tokenised documents, after Martello and Toth's dominance reduction.

Documents become token ids and a closing id 0; longer ones are cut into pieces of the sequence length.
How many pieces there are of each length is all that the plan depends on, so the driver plans on at most
``LENGTH`` counts, whatever the size of the corpus:

* reduction: a piece and a partner that fill a sequence exactly dominate every other choice for that
  piece, as do a piece and the longest fitting partner where no two pieces fit beside it, and a piece
  alone where nothing fits. Such sets are fixed for good and leave the instance;
* best fit decreasing on what remains: each piece goes where the least room is left, all pieces of a
  length at a time.

The plan says for runs of equally long pieces where they go. Pieces are numbered within their length
(``gapless``) and look up their place. No text or ids are shuffled.

Defined results: a null or empty text is the closing id alone; repeated rows are packed one by one; an
empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from repotide.llm.common import full_text, gapless, let_workers_import, slices_for, stored, table

LENGTH = 2048
TOKENIZER = "word_bpe_49k.json"
CLOSING = np.array([0], "<u4").tobytes()
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Words whose ids a Python worker remembers before it starts anew, and words encoded in one call.
WORDS_KEPT, WORDS_AT_ONCE = 600_000, 4000
#: Signs, but for the apostrophe, that end a word after a letter.
AFTER_LETTERS = re.compile(rb"(?<=[a-z])([!-&(-/:-@\[-`{-~]+)(?=[ \t-\r]|$)")

_encoders: dict[str, Encoder] = {}


class Encoder:
    """Token ids as little-endian 32-bit bytes.

    The tokenizer ignores case, drops white space and never joins what it separates, nor letters with other
    signs after them. So a text's ids are those of its words in order, and words are looked up. A text with
    signs that may be a special token's is encoded as it stands.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}

    @classmethod
    def at(cls, path: str) -> Encoder:
        if path not in _encoders:
            _encoders[path] = cls(path)
        return _encoders[path]

    def _learn(self, words: list[bytes]) -> None:
        """Encodes new words, many at a time; a token's place tells its word."""
        for first in range(0, len(words), WORDS_AT_ONCE):
            some = [w.decode("utf-8") for w in words[first : first + WORDS_AT_ONCE]]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ends = np.cumsum([len(w) + 1 for w in some])
            at = np.array([a for a, _ in found.offsets], np.int64)
            cuts = np.searchsorted(at, ends)
            ids = np.array(found.ids, "<u4")
            for word, a, b in zip(words[first:], [0, *cuts[:-1].tolist()], cuts.tolist(), strict=False):
                self.known[word] = ids[a:b].tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [AFTER_LETTERS.sub(rb" \1", text.encode("utf-8").lower()).split() for text in texts]
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
        self._learn([w for w in set().union(*split) if w not in self.known])
        look_up = self.known.__getitem__
        return [self._whole(t) if "<|" in t else b"".join(map(look_up, words)) for t, words in zip(texts, split, strict=True)]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def portions(texts: list[str], characters: int = 4_000_000) -> Iterator[list[str]]:
    """The texts in lists of about so many characters."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= characters:
            yield held
            held, size = [], 0
    yield held


def pieces_of(ids: bytes, length: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Number, start, length and ids of each piece."""
    total = len(ids) // 4
    for piece, start in enumerate(range(0, total, length)):
        end = min(start + length, total)
        yield piece, start, end - start, ids[4 * start : 4 * end]


def tokenised(docs: DataFrame, length: int = LENGTH, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents; ``with_ids`` adds the array ``ids``."""
    let_workers_import(docs.sparkSession)
    path = path or public_tokenizers.path(TOKENIZER)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder.at(path)
        for batch in batches:
            encoded = [ids for texts in portions(batch["text"].tolist()) for ids in encoder.encode(texts)]
            rows = [
                (doc, piece, start, n, zlib.crc32(ids), *([np.frombuffer(ids, "<u4").astype(np.int32)] if with_ids else []))
                for doc, all_ids in zip(batch["doc_id"], encoded, strict=True)
                for piece, start, n, ids in pieces_of(all_ids + CLOSING, length)
            ]
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), full_text().alias("text"))
    schema = PIECES + (", ids array<int>" if with_ids else "")
    return given.mapInPandas(cut, schema)


class Plan:
    """Where the pieces of each length go: runs of them fill runs of sequences."""

    def __init__(self, counts: dict[int, int], capacity: int = LENGTH):
        self.capacity = capacity
        self.left = {size: n for size, n in counts.items() if n > 0}
        self.used: dict[int, int] = defaultdict(int)
        self.sequences = 0
        self.fixed = 0
        #: size, first number, first sequence, pieces for each sequence, offset of the first
        self.runs: list[tuple[int, int, int, int, int]] = []
        self._reduce()
        self.fixed = self.sequences
        self._best_fit()

    def _put(self, size: int, n: int, sequence: int, each: int, offset: int) -> None:
        self.runs.append((size, self.used[size], sequence, each, offset))
        self.used[size] += n
        self.left[size] -= n
        if not self.left[size]:
            del self.left[size]

    def _fix(self, first: int, second: int | None, n: int) -> None:
        if second == first:
            self._put(first, 2 * n, self.sequences, 2, 0)
        else:
            self._put(first, n, self.sequences, 1, 0)
            if second is not None:
                self._put(second, n, self.sequences, 1, first)
        self.sequences += n

    def _reduce(self) -> None:
        """Fixes dominating sets of one or two, longest pieces first, until none is found."""
        found = True
        while found:
            found = False
            for size in sorted(self.left, reverse=True):
                if size not in self.left:
                    continue
                room = self.capacity - size
                sizes = sorted(self.left)
                others = [s for s in sizes if s != size or self.left[s] > 1]
                at = bisect.bisect_right(others, room)
                if not at:
                    self._fix(size, None, self.left[size])
                    found = True
                    continue
                partner = others[at - 1]
                smallest = others[0]
                spare = self.left[smallest] - (smallest == size)
                two = smallest * 2 if spare > 1 else smallest + (others[1] if len(others) > 1 else self.capacity)
                if partner == room or two > room:
                    n = self.left[size] // 2 if partner == size else min(self.left[size], self.left[partner])
                    if n:
                        self._fix(size, partner, n)
                        found = True

    def _best_fit(self) -> None:
        """Best fit decreasing. A bin takes as many equal pieces as fit before the next bin is looked at."""
        rooms: dict[int, list[tuple[int, int]]] = {}
        open_rooms: list[int] = []

        def add(room: int, first: int, n: int) -> None:
            if n and room:
                if room not in rooms:
                    rooms[room] = []
                    bisect.insort(open_rooms, room)
                rooms[room].append((first, n))

        for size in sorted(self.left, reverse=True):
            while size in self.left:
                at = bisect.bisect_left(open_rooms, size)
                if at < len(open_rooms):
                    room = open_rooms[at]
                    first, bins = rooms[room].pop()
                    if not rooms[room]:
                        del rooms[room]
                        open_rooms.pop(at)
                else:
                    room, first = self.capacity, self.sequences
                    bins = -(-self.left[size] // (room // size))
                    self.sequences += bins
                each = room // size
                full = min(bins, self.left[size] // each)
                offset = self.capacity - room
                if full:
                    self._put(size, full * each, first, each, offset)
                    add(room - each * size, first, full)
                rest = self.left.get(size, 0) if full < bins else 0
                if rest:
                    self._put(size, rest, first + full, rest, offset)
                    add(room - rest * size, first + full, 1)
                if full < bins:
                    taken = full + (1 if rest else 0)
                    add(room, first + taken, bins - taken)

    def arrays(self) -> dict[int, np.ndarray]:
        """By length: columns first number, first sequence, pieces for each, offset, by first number."""
        by_size: dict[int, list] = defaultdict(list)
        for size, *rest in self.runs:
            by_size[size].append(rest)
        return {size: np.array(sorted(runs), np.int64) for size, runs in by_size.items()}


def pack(docs: DataFrame, length: int = LENGTH, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """All pieces with their sequence and their offset there; ``with_ids`` adds the array ``ids``."""
    pieces = stored(tokenised(docs, length, path, with_ids), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``length`` rows
    plan = Plan(counts, length).arrays()
    most = max(counts.values(), default=0)
    numbered = gapless(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "number", slices_for(most))

    def place(sizes: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        given, at = sizes.to_numpy(), numbers.to_numpy()
        order = np.argsort(given, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(given[order])) + 1) if len(order) else []:
            size = given[rows[0]]
            runs = plan[int(size)]
            run = runs[np.searchsorted(runs[:, 0], at[rows], side="right") - 1]
            turn, slot = np.divmod(at[rows] - run[:, 0], run[:, 2])
            sequence[rows], offset[rows] = run[:, 1] + turn, run[:, 3] + slot * size
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    where = F.pandas_udf(place, "sequence_id long, offset long")
    placed = numbered.withColumn("at", where("length", "number"))
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, "at.sequence_id", "at.offset"
    )


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
