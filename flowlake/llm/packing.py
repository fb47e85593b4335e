"""Packing documents into training sequences by order-preserving dynamic programming.

The documents of a partition, in their order, are one stream of ids. Window cuts are chosen among
document ends, sentence ends and, inside sentences longer than ``LONG_SENTENCE``, every ``STRIDE``
ids. The cuts minimise the sum over windows of padding, a penalty where a cut splits a document
(more where it splits a sentence) and a small charge per window. The best start of a window that
ends at a given cut is the minimum over the starts within reach, which a monotone queue yields in
constant amortised time; windows of a power of two take no padding and are looked up besides.

Nothing is shuffled. A task holds one block of the stream at a time; a block's last window goes on
into the next block. NULL text is empty; an empty text is the end id alone. Repeated rows are
packed as often as they come, a NULL doc_id stays NULL, other columns are not looked at, and an
empty table gives no rows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

LENGTH = 2048
END_ID = 1
SENTENCE_CUT = 6
INNER_CUT = 40
WINDOW_COST = 24
LONG_SENTENCE = 256
STRIDE = 32
BLOCK = 1 << 18
# About 0.2 KB each, in every Python worker.
CACHED_WORDS = 400_000
CACHED_CORES = 1_000_000

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class Encoder:
    """Ids of whole texts. The tokenizer never joins characters across a blank or a line end, so
    texts are encoded word by word, and a word's ids are kept while there is room.

    It lower-cases, and takes a mark after a letter or digit as a word of its own; so new words of
    ASCII letters and digits are looked up in lower case, without one such mark at their end. What
    is left is encoded in one call, with a mark between the words that is found again in the ids.
    """

    MARKS = ".,;:!?"
    BETWEEN = "\x01"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.cores: dict[str, bytes] = {}
        self.marks = {m: self._ids(m).tobytes() for m in self.MARKS}
        (self.between,) = self._ids(self.BETWEEN).tolist()
        ends = (".</w>", "!</w>", "?</w>")
        self.stops = np.array(sorted(i for t, i in self.tokenizer.get_vocab().items() if t.endswith(ends)), np.uint32)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _core(self, word: str) -> tuple[str, bytes]:
        mark = b""
        if word[-1:] in self.marks and word[-2:-1].isascii() and word[-2:-1].isalnum():
            word, mark = word[:-1], self.marks[word[-1]]
        return (word.lower() if word.isascii() and word.isalnum() else word), mark

    def _learn(self, words: list[str]) -> None:
        cores = [self._core(w) for w in words]
        new = list({c for c, _ in cores if c not in self.cores})
        plain = [c for c in new if self.BETWEEN not in c and c]
        for at in range(0, len(plain), 2048):
            part = plain[at : at + 2048]
            ids = self._ids(f" {self.BETWEEN} ".join(part))
            cuts = np.flatnonzero(ids == self.between)
            if len(cuts) != len(part) - 1:
                raise ValueError("the tokenizer joins words across blanks")
            begin, end = [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]
            for core, a, b in zip(part, begin, end):
                self.cores[core] = ids[a:b].tobytes()
        for core in new:
            if core not in self.cores:
                self.cores[core] = self._ids(core).tobytes()
        for word, (core, mark) in zip(words, cores):
            self.known[word] = self.cores[core] + mark

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        for cache, most in ((self.known, CACHED_WORDS), (self.cores, CACHED_CORES)):
            if len(cache) > most:
                cache.clear()
        split = [t.replace("\n", " ").split(" ") for t in texts]
        known = self.known
        self._learn([w for w in set().union(*split) if w not in known])
        return [np.frombuffer(b"".join([known[w] for w in words]), "<u4") for words in split]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def choose_cuts(places: np.ndarray, costs: np.ndarray, length: int = LENGTH) -> list[int]:
    """Indices into ``places`` of the cheapest windows' ends.

    ``places`` ascend from 0 to the stream's end in steps of at most ``length``; ``costs`` are
    the penalties of cutting there.
    """
    m = len(places)
    index = np.full(int(places[-1]) + 1, -1, np.int32)
    index[places] = np.arange(m)
    exact: dict[int, list[int]] = {}
    power = 1
    while power < length:
        starts = np.where(places >= power, index[np.maximum(places - power, 0)], -1)
        for j in np.flatnonzero(starts >= 0).tolist():
            exact.setdefault(j, []).append(int(starts[j]))
        power *= 2
    place, cost = places.tolist(), costs.tolist()
    total, shifted, back = [0.0] * m, [0.0] * m, [0] * m
    queue, head = [0], 0
    none: list[int] = []
    for j in range(1, m):
        p = place[j]
        while place[queue[head]] < p - length:
            head += 1
        i = queue[head]
        best = shifted[i] + length - p
        for k in exact.get(j, none):
            if total[k] < best:
                best, i = total[k], k
        total[j] = best = best + cost[j] + WINDOW_COST
        back[j] = i
        shifted[j] = g = best + p
        while len(queue) > head and shifted[queue[-1]] >= g:
            queue.pop()
        queue.append(j)
    ends, j = [], m - 1
    while j:
        ends.append(j)
        j = back[j]
    return ends[::-1]


def candidates(ids: np.ndarray, doc_ends: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window may end, from 0 to the end of the block, and what a cut costs there."""
    size = len(ids)
    cost = np.full(size + 1, -1.0)
    cost[np.flatnonzero(np.isin(ids, stops)) + 1] = SENTENCE_CUT
    cost[doc_ends] = 0
    cost[0] = cost[size] = 0
    places = np.flatnonzero(cost >= 0)
    wide = np.flatnonzero(np.diff(places) > LONG_SENTENCE)
    for a, b in zip(places[wide].tolist(), places[wide + 1].tolist()):
        cost[np.arange(a + STRIDE, b, STRIDE)] = INNER_CUT
    places = np.flatnonzero(cost >= 0)
    return places, cost[places]


class Stream:
    """The ids waiting to be cut, as runs (doc_id, start in its document, ids of the document)."""

    def __init__(self, stops: np.ndarray, task: int):
        self.stops, self.next, self.runs, self.size = stops, task << 32, [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[list[tuple]]:
        for start in range(0, len(ids), BLOCK):
            part = ids[start : start + BLOCK]
            self.runs.append((doc_id, start, len(ids), part))
            self.size += len(part)
            if self.size >= BLOCK:
                yield self.cut(last=False)

    def cut(self, last: bool) -> list[tuple]:
        """Pieces of the block's windows; unless ``last``, its final window waits."""
        if not self.size:
            return []
        ids = np.concatenate([r[3] for r in self.runs])
        begins = np.cumsum([0] + [len(r[3]) for r in self.runs])
        ends = np.array([e for r, e in zip(self.runs, begins[1:].tolist()) if r[1] + len(r[3]) == r[2]], int)
        places, costs = candidates(ids, ends, self.stops)
        windows = places[choose_cuts(places, costs)].tolist()
        if not last:
            windows.pop()
        pieces, at, run, begins = [], 0, 0, begins.tolist()
        for end in windows:
            offset = 0
            while at < end:
                if at >= begins[run + 1]:
                    run += 1
                doc_id, start, total, part = self.runs[run]
                inner = at - begins[run]
                took = part[inner : inner + end - at]
                pieces.append((doc_id, start + inner, len(took), total, self.next, offset, took.tobytes()))
                at, offset = at + len(took), offset + len(took)
            self.next += 1
        rest = []
        for (doc_id, start, total, part), begin in zip(self.runs, begins):
            if begin + len(part) > at:
                skip = max(0, at - begin)
                rest.append((doc_id, start + skip, total, part[skip:]))
        self.runs, self.size = rest, sum(len(r[3]) for r in rest)
        return pieces


def pack(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: its document, start, length, document's ids, sequence, offset and ids
    (little-endian unsigned 32-bit). ``tokenizer`` is the path of a vocabulary file that every
    executor has; by default the public 49k word vocabulary."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        encode = encoder(path)
        stream = Stream(encode.stops, TaskContext.get().partitionId())
        names = [f.split()[0] for f in PIECES.split(", ")]
        kinds = [pa.int64()] * 6 + [pa.binary()]
        tail = np.array([END_ID], "<u4")

        def out(pieces: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*pieces), kinds)], names=names)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc_id, ids in zip(part.column(0).to_pylist(), encode(texts)):
                    for pieces in stream.add(doc_id, np.concatenate([ids, tail])):
                        if pieces:
                            yield out(pieces)
        pieces = stream.cut(last=True)
        if pieces:
            yield out(pieces)

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(packed, PIECES)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )
