"""Packing whole documents into training sequences by bounded-space online best-fit.

A document's ids, with the end id behind them, are one piece, or, where they are more than a
sequence holds, full pieces behind a shorter first one. Pieces are placed as they come, batch by
batch, the longest of a batch first: each goes into the open sequence with the least free space
that still takes it. Open sequences are kept by their free space, with one bit of a bitset for each
amount of space in use, so that the best fit is the lowest set bit at or above the piece's length.
At most ``OPEN`` sequences are open; where one more is needed, the fullest closes. A full one
closes at once.

Nothing is shuffled, and a task holds its open sequences' numbers and one batch of texts only:
a piece is put out as soon as its place is known. Each task packs its own partition, so a table
of many small partitions leaves a few sequences open in each of them.

NULL text is empty; an empty text is the end id alone. Repeated rows are packed as often as they
come, a NULL doc_id stays NULL, other columns are not looked at, and an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

LENGTH = 1024
END_ID = 2
OPEN = 4096
BATCH_ROWS = 512
# Fixed value: how a byte-level vocabulary cuts texts.
LETTERS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PIECES = "doc_id long, piece int, start long, length long, sequence_id long, offset long, ids binary"


def _byte_of_letter() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 bytes
    stand for themselves, the others for the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ranked(path: str):
    """The vocabulary file as a table of byte strings by rank, or None where it is of another kind:
    one that changes texts, cuts them otherwise, or whose merges do not come in the order of ids."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    model, cut = whole["model"], whole.get("pre_tokenizer") or {}
    plain_cut = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    added = whole.get("added_tokens") or []
    plain_added = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)
    if model.get("type", "BPE") != "BPE" or whole.get("normalizer") or not plain_cut or not plain_added:
        return None
    if any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return None
    vocabulary = model["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [vocabulary["".join(pair)] for pair in pairs]
    if any(a >= b for a, b in zip(made, made[1:])):
        return None
    byte = _byte_of_letter()
    special = {t["content"]: t["id"] for t in added}
    ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items() if t not in special}
    import tiktoken

    return tiktoken.Encoding("ranked", pat_str=LETTERS, mergeable_ranks=ranks, special_tokens=special)


class Encoder:
    """Ids of whole texts as the vocabulary file says. The rank table gives the same ids as the file's
    own library, several times as fast; a vocabulary it cannot stand for is left to that library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.ranked = _ranked(path)
        if self.ranked is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)

    def __call__(self, text: str) -> np.ndarray:
        if self.ranked is None:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return self.ranked.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Bins:
    """Open sequences by free space. ``place`` gives the sequence and offset a piece goes to."""

    def __init__(self, length: int, most: int, first: int):
        self.length, self.most, self.next = length, most, first
        self.spaces = 0
        self.with_space: list[list[int]] = [[] for _ in range(length + 1)]
        self.open = 0

    def _take(self, space: int) -> int:
        bins = self.with_space[space]
        sequence = bins.pop()
        if not bins:
            self.spaces &= ~(1 << space)
        self.open -= 1
        return sequence

    def place(self, size: int) -> tuple[int, int]:
        fitting = self.spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            sequence = self._take(space)
        else:
            sequence, space = self.next, self.length
            self.next += 1
        left = space - size
        if left:
            if self.open == self.most:
                # The fullest closes.
                self._take((self.spaces & -self.spaces).bit_length() - 1)
            self.with_space[left].append(sequence)
            self.spaces |= 1 << left
            self.open += 1
        return sequence, self.length - space


def cut(total: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones behind a shorter first one."""
    first = total % length
    starts = [0] * bool(first) + list(range(first, total, length))
    return [(a, b - a) for a, b in zip(starts, starts[1:] + [total])]


def pack(
    docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end_id: int = END_ID, most_open: int = OPEN,
) -> DataFrame:
    """One row per piece: its document, number, start, length, sequence, offset and ids
    (little-endian unsigned 32-bit). ``tokenizer`` is the path of a vocabulary file that every
    executor has; by default the public 50k byte-level vocabulary."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        encode = encoder(path)
        bins = Bins(length, most_open, TaskContext.get().partitionId() << 32)
        names = [f.split()[0] for f in PIECES.split(", ")]
        kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.binary()]
        tail = np.array([end_id], "<u4")
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                pieces = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.concatenate([encode(text or ""), tail])
                    for number, (start, size) in enumerate(cut(len(ids), length)):
                        pieces.append((doc_id, number, start, size, ids[start : start + size].tobytes()))
                pieces.sort(key=lambda p: -p[3])
                rows = [(*p[:4], *bins.place(p[3]), p[4]) for p in pieces]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(packed, PIECES)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )
