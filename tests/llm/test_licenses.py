import re

import pytest

from flowlake.llm import licenses

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software")"""
TEXTS = [
    "Released under the MIT License.", "mit\nLICENSE mit-license MIT, license", "The mit licence", "submit license",
    "Licensed under the Apache License, Version 2.0.", "GNU General Public License, version 3", "general public general public license",
    "", None, "...", "É mit license é", "mit é license", "mitKlicense mıt license", "apache apache license license",
    "mit license " * 20_000, "word " * 50_000 + "apache license", "Licensed under CC BY-NC 4.0.", MIT, "license", "x" * 100_000,
    "no words here of the kind", "mit_license mit`license MIT{license", "123 mit license 456",
]


@pytest.fixture(scope="module")
def found(spark, documents):
    return {r.doc_id: r for r in licenses.scan(documents(list(enumerate(TEXTS)))).collect()}


def test_base_phrases(found):
    for i, text in enumerate(TEXTS):
        r = found[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text), text


def test_labels(found):
    labels = {TEXTS[i]: found[i].labels for i in range(len(TEXTS))}
    assert labels["Licensed under the Apache License, Version 2.0."] == "apache,apache-2.0"
    assert labels["GNU General Public License, version 3"] == "gpl,gpl-3.0"
    assert labels["Licensed under CC BY-NC 4.0."] == "cc-by-nc"
    assert labels[MIT] == "mit" and found[TEXTS.index(MIT)].base_labels == ""
    assert labels["no words here of the kind"] == "" and found[TEXTS.index("")].score == 0
    for r in found.values():
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_score_falls_with_missing_words(spark, documents):
    text = "licensed under the gnu general public license version 3"
    cut = "under some gnu general public license version 3"
    whole, part = (licenses.scan(documents([(1, t)]), licenses.TEMPLATES[6:8]).first() for t in (text, cut))
    assert whole.score == 1.0 and 0 < part.score < 1


def test_odd_rows(documents):
    got = licenses.scan(documents([(1, "mit license"), (1, "mit license"), (None, "mit license")])).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "None"] and {r.n_base for r in got} == {1}
    assert licenses.scan(documents([])).collect() == []


def test_no_python_on_the_main_path(documents):
    plan = licenses.scan(documents([(1, "mit license")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_every_template_has_its_key():
    for t in licenses.TEMPLATES:
        assert t.key in t.words and t.probe in t.key.split()
