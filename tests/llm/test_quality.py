import random

import numpy as np
import pytest

from flowlake.llm import quality


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    words = ["the", "of", "river", "mountain", "quiet", "letter", "and", "was", "house", "window", "garden", "slowly"]
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        if good:
            text = " ".join(" ".join(rng.choice(words) for _ in range(rng.randint(4, 12))) + "." for _ in range(rng.randint(3, 20)))
        else:
            word = rng.choice(words)
            text = rng.choice([" | ".join(rng.choice(words) for _ in range(40)), f"{word} " * 60, "$$$ ".join(rng.choice(words) for _ in range(40))])
        rows.append((i, text))
        if rng.random() < 0.5:
            labels.append((i, int(good), 0))
    return rows, labels


@pytest.fixture(scope="module")
def scored(spark, documents):
    rows, labels = corpus()
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = documents(rows)
    return docs, frame, quality.classify(docs, frame).collect(), dict((i, q) for i, q, _ in labels)


def test_held_out_accuracy(scored):
    _, _, got, truth = scored
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 60
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_fold(scored):
    import zlib

    for r in scored[2]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_held_out_labels_do_not_matter(spark, scored):
    docs, labels, got, _ = scored
    held = quality.held_out(labels["doc_id"])
    turned = labels.filter(~held).unionByName(labels.filter(held).withColumn("quality", 1 - labels["quality"]))
    again = quality.classify(docs, turned).collect()
    before = {r.doc_id: r.score for r in got}
    assert max(abs(r.score - before[r.doc_id]) for r in again) < 1e-6


def test_unlabelled_negatives_do_not_matter(spark, scored):
    """Only positives are trusted; with the prior given, labels of 0 have no effect."""
    docs, labels, _, _ = scored
    a = quality.classify(docs, labels, prior=0.8).collect()
    b = quality.classify(docs, labels.filter("quality = 1"), prior=0.8).collect()
    scores = {r.doc_id: r.score for r in a}
    assert max(abs(r.score - scores[r.doc_id]) for r in b) < 1e-6


def test_accepted(scored):
    docs, labels, got, _ = scored
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.predicted}


def test_odd_rows(spark, documents):
    rows, labels = corpus(120, 2)
    rows += [(1000, ""), (1001, None), (None, "x"), (1002, "y " * 100_000), (1003, "same"), (1003, "same"), (1004, "퟿ 日本")]
    labels += [(1000, None, 0), (1003, 1, 0), (1003, 0, 0), (None, 1, 0)]
    got = quality.classify(documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows) and all(np.isfinite(r.score) for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]


def test_no_labels(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.classify(documents([(1, "a b"), (2, None)]), labels).collect()
    assert [r.score for r in got] == [0.5, 0.5]
    assert quality.classify(documents([]), labels).collect() == []
