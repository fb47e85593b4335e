import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from flowlake.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")

TEXTS = [
    "One sentence here. Another one! A third? And more",
    "", None, "Tabs\tand odd blanks\r\nlines  twice", "été École ÉÉ é ́x İstanbul ΣΑΣ K",
    "<|endoftext|> inside <|startoftext|>x", "don't we'll it's 123 4.5 $$$ ... | | |",
    "日本語 テスト 한국어 مرحبا 👩‍👩‍👧 \x1c\x1f\x85 z", "word. " * 3000, "x" * 9000, "a,b;c " * 2500,
]


def truth(text):
    tokenizer = Tokenizer.from_file(PATH)
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_word_by_word_encoding_is_the_same(text):
    if any(0xD800 <= ord(c) <= 0xDFFF for c in text):
        return
    assert packing.encoder(PATH)([text])[0].tolist() + [1] == truth(text)


def rebuilt(rows):
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append((r.start, r.length, bytes(r.ids), r.doc_tokens))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    return docs, sequences


def test_round_trip(documents):
    rows = packing.pack(documents([(i, t) for i, t in enumerate(TEXTS)])).collect()
    docs, sequences = rebuilt(rows)
    for i, text in enumerate(TEXTS):
        at, ids = 0, b""
        for start, length, part, total in sorted(docs[i]):
            assert start == at and len(part) == 4 * length and length > 0
            at, ids = at + length, ids + part
            assert total == len(truth(text))
        assert np.frombuffer(ids, "<u4").tolist() == truth(text)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= packing.LENGTH


def test_order_is_kept(documents):
    docs = documents([(i, f"Document number {i}. " * (i % 7)) for i in range(300)]).coalesce(1)
    rows = packing.pack(docs).collect()
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)
    assert [r.sequence_id for r in rows] == sorted(r.sequence_id for r in rows)


def test_little_padding(documents):
    rng = np.random.default_rng(3)
    text = lambda: " ".join(
        " ".join(["the"] * int(rng.integers(3, 25))) + "." for _ in range(int(rng.integers(1, 60)))
    )
    rows = packing.pack(documents([(i, text()) for i in range(1500)]).coalesce(1)).collect()
    _, sequences = rebuilt(rows)
    sizes = [sum(n for _, n in parts) for parts in sequences.values()]
    padding = sum(packing.LENGTH - n for n in sizes if n & (n - 1))
    assert padding < 0.01 * sum(sizes)
    inner = sum(1 for r in rows if r.start and not r.offset)
    assert inner <= len(sizes)


def test_digest(documents):
    rows = packing.digest(packing.pack(documents([(5, "Hello there. General")]))).collect()
    ids = np.array(truth("Hello there. General"), "<u4")
    assert [(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, r.offset) for r in rows] == [
        (5, 0, len(ids), zlib.crc32(ids.tobytes()), len(ids), 0)
    ]


def test_blocks_go_on_into_the_next(documents, monkeypatch):
    stream = packing.Stream(np.array([7], np.uint32), 0)
    monkeypatch.setattr(packing, "BLOCK", 5000)
    rng, pieces, docs = np.random.default_rng(5), [], []
    for i in range(40):
        ids = rng.integers(2, 40, int(rng.integers(1, 2500)), dtype=np.uint32)
        docs.append(ids)
        for part in stream.add(i, ids):
            pieces += part
    pieces += stream.cut(last=True)
    for i, ids in enumerate(docs):
        assert b"".join(p[6] for p in pieces if p[0] == i) == ids.tobytes()


def plain(places, costs, length):
    best, back = [0.0], [0]
    for j in range(1, len(places)):
        options = []
        for i in range(j):
            n = places[j] - places[i]
            if n <= length:
                options.append((best[i] + (0 if n & (n - 1) == 0 else length - n), i))
        value, i = min(options)
        best.append(value + costs[j] + packing.WINDOW_COST)
        back.append(i)
    return best[-1]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 16), st.integers(0, 9)), min_size=1, max_size=60))
def test_cuts_are_optimal(steps):
    places = np.concatenate([[0], np.cumsum([s for s, _ in steps])])
    costs = np.array([0.0] + [float(c) for _, c in steps])
    ends = packing.choose_cuts(places, costs, 16)
    total, at = 0.0, 0
    for e in ends:
        n = int(places[e] - places[at])
        assert n <= 16
        total += (0 if n & (n - 1) == 0 else 16 - n) + costs[e] + packing.WINDOW_COST
        at = e
    assert at == len(places) - 1
    assert total == pytest.approx(plain(places.tolist(), costs.tolist(), 16))


def test_odd_tables(documents):
    assert packing.pack(documents([])).collect() == []
    rows = packing.pack(documents([(None, "a"), (1, "b"), (1, "b")]).coalesce(1)).collect()
    assert [r.doc_id for r in rows] == [None, 1, 1]
