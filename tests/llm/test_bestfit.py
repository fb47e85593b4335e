import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from flowlake.llm import bestfit

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)

TEXTS = [
    "One sentence here. Another one! don't we'll 123 4.5", "", None, " leading and trailing  ",
    "Tabs\tand odd   blanks\r\n\r\nlines \n twice\n", "été École ÉÉ é ́x İstanbul ΣΑΣ K 　 wide",
    "<|endoftext|> inside <|endoftext|>x <|endoftext|", "日本語 テスト مرحبا 👩‍👩‍👧 \x1c\x1f\x85 z\x00",
    "word. " * 3000, "x" * 9000, " " * 5000 + "a", "a,b;c " * 2500, "﻿­​ zero widths",
]


def truth(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [bestfit.END_ID]


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="ab' \n\t.,sdé<|endoftext>1", max_size=80)))
def test_ids_are_those_of_the_library(text):
    if any(0xD800 <= ord(c) <= 0xDFFF for c in text):
        return
    assert bestfit.encoder(PATH)(text).tolist() == truth(text)[:-1]


def test_fixed_texts():
    for text in TEXTS:
        assert bestfit.encoder(PATH)(text or "").tolist() == truth(text)[:-1]


def test_other_vocabularies_are_left_to_their_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    made = bestfit.encoder(path)
    assert made.ranked is None
    text = "Some WORDS, and more."
    assert made(text).tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def slow_best_fit(sizes, length, most):
    """The same rule with a plain list of open sequences (free space, number)."""
    open_, out, count = [], [], 0
    for size in sizes:
        fits = [b for b in open_ if b[0] >= size]
        if fits:
            least = min(b[0] for b in fits)
            place = [b for b in open_ if b[0] == least][-1]
            open_.remove(place)
        else:
            place = (length, count)
            count += 1
        left = place[0] - size
        out.append((place[1], length - place[0]))
        if left:
            if len(open_) == most:
                fullest = min(b[0] for b in open_)
                open_.remove([b for b in open_ if b[0] == fullest][-1])
            open_.append((left, place[1]))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120), st.integers(1, 6))
def test_places_equal_a_plain_search(sizes, most):
    bins = bestfit.Bins(40, most, 0)
    assert [bins.place(s) for s in sizes] == slow_best_fit(sizes, 40, most)


@pytest.mark.parametrize("total", [1, 1023, 1024, 1025, 2048, 2049, 5000])
def test_cut(total):
    parts = bestfit.cut(total)
    assert sum(n for _, n in parts) == total and parts[0][0] == 0
    assert [a + n for a, n in parts[:-1]] == [a for a, _ in parts[1:]]
    assert all(n == 1024 for _, n in parts[1:]) and 0 < parts[0][1] <= 1024


def check_pieces(rows, texts, length=bestfit.LENGTH):
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(docs) == set(texts)
    for doc_id, pieces in docs.items():
        ids = truth(texts[doc_id])
        pieces.sort(key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in pieces] == [(i, *c) for i, c in enumerate(bestfit.cut(len(ids), length))]
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return sequences


def test_round_trip(documents):
    rows = bestfit.digest(bestfit.pack(documents(list(enumerate(TEXTS))))).collect()
    check_pieces(rows, dict(enumerate(TEXTS)))


def test_whole_small_table_fills_its_sequences(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = bestfit.digest(bestfit.pack(docs)).collect()
    sequences = check_pieces(rows, {r.doc_id: r.text for r in docs.collect()})
    assert len(sequences) <= 1.03 * sum(r.length for r in rows) / bestfit.LENGTH + 1


def test_fills_better_than_two_thirds_with_few_open(documents):
    rng = np.random.default_rng(5)
    docs = documents([(i, "the " * int(rng.integers(20, 900))) for i in range(1200)]).coalesce(1)
    wide = bestfit.pack(docs).groupBy("sequence_id").count().count()
    narrow = bestfit.pack(docs, most_open=4).groupBy("sequence_id").count().count()
    total = sum(r.length for r in bestfit.pack(docs).select("length").collect())
    assert wide <= 1.03 * total / bestfit.LENGTH and wide <= narrow <= 1.5 * wide


def test_odd_rows(documents, spark):
    docs = documents([(None, "a b"), (1, "same"), (1, "same"), (2, None)])
    rows = bestfit.pack(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.length) for r in rows) == [
        (False, 1, len(truth("same"))), (False, 1, len(truth("same"))), (False, 2, 1), (True, 0, len(truth("a b"))),
    ]
    assert bestfit.pack(docs.limit(0)).collect() == []
    assert bestfit.digest(bestfit.pack(docs)).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
