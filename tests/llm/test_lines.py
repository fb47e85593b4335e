import random

import numpy as np
import pytest

from flowlake.llm import lines


def shingles(line):
    return {line[i : i + 8] for i in range(max(1, len(line) - 7))}


def brute(rows):
    """Kept lines of every document, by comparing all pairs of lines."""
    found = []
    for doc_id, text in rows:
        for no, line in enumerate((text or "").split("\n")):
            if line.strip(" "):
                found.append(((doc_id is None, doc_id or 0, no), line))
    root = list(range(len(found)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [shingles(line) for _, line in found]
    for i in range(len(found)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (place, _) in enumerate(found):
        least[find(i)] = min(least.get(find(i), place), place)
    dropped = {}
    for i, (place, _) in enumerate(found):
        if least[find(i)] != place:
            dropped.setdefault(place[:2], set()).add(place[2])
    return {
        (d, len((t or "").split("\n")), tuple(sorted(dropped.get((d is None, d or 0), ())))) for d, t in rows
    }


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    pool = [" ".join(word() for _ in range(rng.randint(15, 30))) for _ in range(60)] + ["short", "tiny", "  ", ""]
    rows = []
    for i in range(n):
        body = []
        for _ in range(rng.randint(1, 6)):
            line = rng.choice(pool)
            if line.strip() and rng.random() < 0.3:
                at = rng.randrange(len(line))
                line = line[:at] + rng.choice("xyz") + line[at + 1 :]
            body.append(line)
        rows.append((i, "\n".join(body)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(documents, seed):
    rows = corpus(seed)
    got = lines.dedup_lines(documents(rows)).collect()
    assert {(r.doc_id, r.n_lines, tuple(r.dropped)) for r in got} == brute(rows)
    assert all(r.n_kept == r.n_lines - len(r.dropped) for r in got)


def family(seed, n=40):
    """One line for each document: copies of a line, each edited in its own way, so that some are linked by
    others only."""
    rng = random.Random(seed)
    base = [rng.choice("abcdefghij ") for _ in range(300)]
    rows = []
    for i in range(n):
        line = list(base)
        for _ in range(rng.randint(0, 5)):
            line[rng.randrange(300)] = rng.choice("XYZ")
        rows.append((i, "".join(line)))
    return rows


@pytest.mark.parametrize("part_lines", [4_096, 3])
def test_copies_that_differ_in_their_own_way(documents, monkeypatch, part_lines):
    monkeypatch.setattr(lines, "PART_LINES", part_lines)
    rows = family(4)
    got = lines.dedup_lines(documents(rows)).collect()
    assert {(r.doc_id, r.n_lines, tuple(r.dropped)) for r in got} == brute(rows)


def test_similar_lines_of_one_wide_key_alone_are_linked(spark, monkeypatch):
    """Pairs that have no second key in common, in a key of more lines than a task should hold."""
    monkeypatch.setattr(lines, "PART_LINES", 3)
    rng = random.Random(3)
    texts = []
    for _ in range(10):
        base = "".join(rng.choice("abcdefghij ") for _ in range(120))
        texts += [base, base[:60] + "Z" + base[61:]]
    sizes = [len(shingles(t)) for t in texts]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "cid long, line string")
    keys = spark.createDataFrame([(7, i, n, 20) for i, n in enumerate(sizes)], "key long, cid long, n long, crowd long")
    found = {(min(r), max(r)) for r in lines._links(frame, keys).collect()}
    assert found == {(i, i + 1) for i in range(0, 20, 2)}


@pytest.mark.parametrize("seed", range(5))
def test_links_of_a_group_join_all_similar_lines(seed):
    rng = random.Random(seed)
    sets = [np.array(sorted(rng.sample(range(12), rng.randint(1, 12))), np.uint64) for _ in range(40)]
    given = np.array([rng.randrange(25) for _ in sets])

    def joined(links):
        root = given.copy()
        for x, y in links:
            root[root == root[x]] = root[y]
        return {(i, j) for i in range(40) for j in range(40) if root[i] == root[j]}

    pairs = [
        (i, j) for i in range(40) for j in range(i)
        if 100 * len(set(sets[i]) & set(sets[j])) >= 80 * len(set(sets[i]) | set(sets[j]))
    ]
    links = lines._group_links(given, sets)
    assert set(links) <= set(pairs) | {(j, i) for i, j in pairs}
    assert joined(links) == joined(pairs)
    assert len(links) < len(set(given))


def test_odd_rows(documents):
    rows = [
        (1, None), (2, ""), (3, "\n\n"), (4, "same line of some length"), (5, "same line of some length\nother"),
        (None, "same line of some length"), (6, "é" * 50 + "\n" + "é" * 50), (7, "long " * 50_000), (8, "long " * 50_000),
        (9, "a\na\nb"), (10, "a"),
    ]
    got = lines.dedup_lines(documents(rows)).collect()
    assert {(r.doc_id, r.n_lines, tuple(r.dropped)) for r in got} == brute(rows)


def test_repeated_rows_are_one_document(documents):
    got = lines.dedup_lines(documents([(1, "one line here\ntwo"), (1, "one line here\ntwo"), (2, "two")])).collect()
    assert sorted((r.doc_id, tuple(r.dropped)) for r in got) == [(1, ()), (1, ()), (2, (0,))]


def test_texts_of_one_id_are_judged_apart(documents):
    rows = [
        (0, "shared line of text"), (1, "shared line of text\nfirst tail"), (1, "unique words over here\nsecond tail"),
        (5, "a line of both texts\nnorth"), (5, "a line of both texts\nsouth"),
    ]
    texts = [r.text for r in lines.rewritten(documents(rows)).collect()]
    assert sorted("\n".join(texts).split("\n")) == sorted({line for _, t in rows for line in t.split("\n")})
    got = sorted((r.doc_id, tuple(r.dropped)) for r in lines.dedup_lines(documents(rows)).collect())
    assert got == [(0, ()), (1, ()), (1, (0,)), (5, ()), (5, (0,))]


def test_empty_table(documents):
    assert lines.dedup_lines(documents([])).collect() == []


def test_rewritten(documents):
    docs = documents([(1, "first line of text\nsecond"), (2, "first line of text\n\nthird"), (3, None)])
    out = lines.rewritten(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "first line of text\nsecond", 2: "\nthird", 3: None}


def test_high_recall_at_the_threshold():
    rng = random.Random(8)
    found = tried = 0
    for _ in range(400):
        a = "".join(rng.choice("abcdefghijklmnop ") for _ in range(300))
        b = list(a)
        for _ in range(4):
            b[rng.randrange(300)] = "Z"
        b = "".join(b)
        x, y = shingles(a), shingles(b)
        if len(x & y) >= 0.8 * len(x | y):
            tried += 1
            keys = lines.band_keys([a, b])
            found += bool((keys[0] == keys[1]).any())
    assert tried > 50 and found / tried > 0.98
