import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from flowlake.llm import collocations
from test_exact_dedup import LOWER


def brute(rows, least, longest=5, per_lang=2000):
    """(lang, rank, phrase, a, l, r, n, score) with plain counters and Python's integers."""
    counts, sizes = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[\x20\x09]", piece) if w]
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        n, found = sizes[lang], []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            if any(
                len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in candidates.items()
            ):
                continue
            score, _, l, r = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((score, a, " ".join(p), l, r, n))
        found.sort(key=lambda t: (-t[0], -t[1], t[2].encode()))
        out += [(lang, i + 1, p, a, l, r, n, s) for i, (s, a, p, l, r, n) in enumerate(found[:per_lang])]
    return sorted(out)


def mined(docs, **options):
    return sorted(tuple(r) for r in collocations.collocations(docs, **options).collect())


def corpus(seed, rows=60):
    rng = np.random.default_rng(seed)
    words = ["of", "the", "Cat", "sat", "é", "New", "York", "\x1cx", "a\xa0b", "ÀB"]
    joins = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ; "]
    out = []
    for i in range(rows):
        size = int(rng.integers(0, 60))
        text = "".join(rng.choice(words) + rng.choice(joins) for _ in range(size))
        out.append((i, text, [None, "en", "und", "de"][int(rng.integers(0, 4))]))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(documents, seed):
    rows = corpus(seed) + [(900 + i, "new york city of the cat", "en") for i in range(12)]
    docs = documents(rows).repartition(3)
    for least, block in ((3, 50), (8, 1 << 20)):
        expected = brute(rows, least)
        assert len(expected) > 20
        assert mined(docs, least=least, block_words=block) == expected


def test_best_of_each_language_and_length(documents):
    rows = corpus(7)
    assert mined(documents(rows), least=2, per_lang=5) == brute(rows, 2, per_lang=5)
    assert mined(documents(rows), least=2, longest=3) == brute(rows, 2, longest=3)


def test_many_owners(documents, monkeypatch):
    monkeypatch.setattr(collocations, "OWNER_WORDS", 5)
    monkeypatch.setattr(collocations, "OWNER_PAIRS", 50)
    rows = corpus(11)
    assert mined(documents(rows).repartition(3), least=4, block_words=200) == brute(rows, 4)


def test_hot_word_and_pair(documents):
    rows = [(i, "very very very very very very good " * 20, "en") for i in range(40)] + corpus(3, 20)
    assert mined(documents(rows).repartition(4), least=30, block_words=300) == brute(rows, 30)


def test_odd_rows(documents):
    rows = [(None, "a b c", None), (1, None, "en"), (2, "", None), (3, "a b c", "und"), (3, "a b c", "und"), (4, ".,;", "x"), (5, "x", "")]
    assert mined(documents(rows), least=1) == brute(rows, 1)
    assert mined(documents(rows), least=100) == []
    assert mined(documents([(1, "a", "en")]).limit(0)) == []


def test_exact_products(spark):
    """Counts whose products pass 64 bits would be rounded by doubles."""
    a, n, l, r = 9_007_199_254_740_993, 99_999_999_999_999_997, 9_007_199_254_740_995, 9_007_199_254_740_997
    schema = "lang string, n long, phrase string, a long, heads array<long>, tails array<long>"
    rows = [("x", n, "p q", a, [l], [r]), ("x", n, "p q s", a, [a + 7, a + 2], [a + 1, a + 6])]
    first, second = collocations.at_least_cut(spark.createDataFrame(rows, schema)).orderBy("phrase").collect()
    assert (first.score, first.l, first.r) == (1000 * a * n // (l * r), l, r)
    scores = [1000 * a * n // ((a + 7) * (a + 1)), 1000 * a * n // ((a + 2) * (a + 6))]
    assert second.score == min(scores)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=30), st.integers(0, 1 << 30))
def test_merge_of_adjacent_places(gaps, seed):
    places = np.cumsum(np.array(gaps, int))
    phrases = np.random.default_rng(seed).integers(0, 3, len(places)).astype(np.int32)
    at, pairs = collocations.merge_adjacent(places, phrases)
    by_place = dict(zip(places.tolist(), phrases.tolist()))
    expected = [(p, by_place[p], by_place[p + 1]) for p in by_place if p + 1 in by_place]
    assert [(p, d >> 32, d & 0xFFFFFFFF) for p, d in zip(at.tolist(), pairs.tolist())] == expected
