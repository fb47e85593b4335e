import random
import re

import numpy as np
import pytest

from flowlake.llm import ngram_join
from flowlake.llm.common import word_hashes
from flowlake.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], len(sets[i]), least.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows)]


def near_copies(seed, bases=25, copies=12, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    passage = [rng.choice(vocabulary) for _ in range(25)]
    for _ in range(bases):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(8, words))]
        if rng.random() < 0.5:
            base += passage
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(text))
                text[at : at + rng.choice([0, 1])] = [rng.choice(vocabulary)]
            rows.append((n, rng.choice([" ", "\n", "\t "]).join(text)))
            n += 1
    rng.shuffle(rows)
    return rows


def key(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(documents, seed):
    rows = near_copies(seed)
    got = ngram_join.similarity_components(documents(rows).repartition(4)).collect()
    assert key(tuple(r) for r in got) == key(brute(rows))


def test_odd_rows(documents):
    rows = [
        (5, ""), (6, None), (7, " \t\n"), (8, "one two"), (9, "One\nTWO"), (10, "one two three"), (None, "one two three"),
        (11, "É b c d e"), (12, "é b c d e"), (13, "long text " * 20_000), (14, "long text " * 20_001), (None, "x y"),
        (15, "a b c d e f g"), (15, "a b c d e f g"), (3, "a b c d e f g"), (16, " a b"), (17, "a b"),
    ]
    got = ngram_join.similarity_components(documents(rows)).collect()
    assert key(tuple(r) for r in got) == key(brute(rows))


def test_empty_table(documents):
    assert ngram_join.similarity_components(documents([])).collect() == []
    assert ngram_join.similarity_components(documents([(1, None), (2, "")])).count() == 2


def family(size, edits, seed=4, words=150):
    """Near copies of one text, each with its own changes, near the threshold from each other."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    rows = []
    for i in range(size):
        text = list(base)
        for _ in range(rng.choice(edits)):
            at = rng.randrange(len(text))
            text[at : at + rng.choice([0, 1, 1, 1, 2])] = [f"x{rng.randrange(10**6)}"]
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("edits", [(0, 1, 2, 3), (2, 3, 4), (3, 4, 5, 6)])
def test_large_groups_near_the_threshold(documents, edits):
    rows = family(150, edits)
    got = ngram_join.similarity_components(documents(rows)).collect()
    assert key(tuple(r) for r in got) == key(brute(rows))


def test_one_large_group_needs_few_pairs(spark, documents):
    """Pairs to verify grow with the members of a group of near copies, not with their square."""
    counts = []
    for size in (200, 400):
        sets = ngram_join.shared_sets(documents(family(size, (0, 1, 2, 3, 4, 5))))
        classes = sets.filter("tokens IS NOT NULL").withColumnRenamed("doc_id", "cid")
        lists = classes.selectExpr("cid", "crowd", "explode(prefix) AS token")
        first = ngram_join._compare(ngram_join._hubs(lists), classes, ngram_join.hashes_of)
        rooted = ngram_join._rooted(classes, first.filter(ngram_join.LINKED).select("a", "b"))
        hub = first.selectExpr("b AS cid", "a AS hub")
        rooted = rooted.join(hub, "cid", "left").selectExpr("*", "coalesce(hub, cid) AS h").drop("hub").withColumnRenamed("h", "hub")
        parts = ngram_join._between_hubs(rooted), ngram_join._within_hubs(rooted, first), ngram_join._by_size(rooted, first)
        counts.append(first.count() + sum(p.count() for p in parts))
    assert counts[0] < 200 * 6 and counts[1] < 400 * 6


def test_one_of_each(documents):
    rows = near_copies(7) + [(None, "no id"), (None, None)]
    docs = documents(rows)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    want = sorted(d for d, _, c in brute(rows) if d is not None and d == c)
    got = [r.doc_id for r in kept.collect()]
    assert sorted(d for d in got if d is not None) == want and got.count(None) == 2


def test_one_row_of_each_component(documents):
    a, b, c, d = ("".join(f"{x}{i} " for i in range(40)) for x in "abcd")
    rows = [
        (1, a), (3, a + "end"), (None, a + "tail"), (3, b), (2, b + "end"), (3, c),
        (None, d), (None, d + "end"), (None, d), (None, " \n"), (None, None), (7, ""),
    ]
    kept = sorted(((r.doc_id, r.text) for r in ngram_join.one_of_each(documents(rows)).collect()), key=str)
    of_d = [t for _, t in kept if t and t.startswith("d")]
    assert len(of_d) == 1 and of_d[0] in (d, d + "end")
    want = [(1, a), (2, b + "end"), (3, c), (None, of_d[0]), (None, " \n"), (None, None), (7, "")]
    assert kept == sorted(want, key=str)


def test_more_matches_cost_less_in_crowded_prefixes():
    crowded = np.full(90, 200)
    assert ngram_join.matches_needed(crowded, 100) > 1
    lone = np.array([2] * 80 + [500] * 10)
    assert ngram_join.matches_needed(lone, 100) >= 1


def test_word_hashes_follow_the_word_rule():
    text = "Ab  cd ef\tGH\x0bij\r\n é\x85x"
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    assert len(word_hashes(text)) == len(words)
    assert word_hashes("AB ab").tolist()[0] == word_hashes("ab").tolist()[0]
    long = "word " * 400_000 + "x" * 2_000_000 + " end"
    hashes = word_hashes(long)
    assert len(hashes) == 400_002 and hashes[-1] == word_hashes("end")[0]


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(50), 100 + rng.randrange(50)) for _ in range(40)] + [(200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {n: n for e in edges for n in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    lone = {a for a, b in edges if a == b} - {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: r for n, r in root.items() if n not in lone}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
