import random
import re

import pytest

from flowlake.llm import chat

SCHEMA = "conv_id long, turn int, role string, text string, part string, rows int, whole string"


def table(spark, rows):
    return spark.createDataFrame([tuple(r) + ("x", 1, "y") for r in rows], SCHEMA)


def brute(rows, run=chat.RUN):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((-1 if turn is None else turn, role, text))
    order = lambda t: (t[0], t[1] is not None, t[1] or "", t[2] is not None, t[2] or "")
    convs = {c: sorted(t, key=order) for c, t in convs.items()}
    prefixes = set()
    for turns in convs.values():
        for i in range(1, len(turns)):
            if turns[i][0] != turns[i - 1][0]:
                prefixes.add(tuple(turns[:i]))
    whole = {}
    for c, turns in convs.items():
        whole.setdefault(tuple(turns), []).append(c)
    out = []
    for turns, ids in whole.items():
        if turns in prefixes:
            continue
        named = [i for i in ids if i is not None]
        parts = {}
        for i, (_, role, text) in enumerate(turns):
            line = f"<|im_start|>{'unknown' if role is None else role}\n{text or ''}<|im_end|>\n"
            parts[i // run] = parts.get(i // run, "") + line
        out += [(min(named) if named else None, p, len(turns), len(ids), t) for p, t in parts.items()]
    return sorted(out, key=str)


def snapshots(seed, n=40):
    rng, rows, conv = random.Random(seed), [], 0
    for _ in range(n):
        turns = [(i, "user" if i % 2 == 0 else "assistant", rng.choice(["hi", "yes", "no", "tell me"])) for i in range(rng.randint(1, 9))]
        for end in {rng.randint(1, len(turns)) for _ in range(3)} | {len(turns)}:
            rows += [(conv, *t) for t in turns[:end]]
            conv += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows = snapshots(seed)
    got = sorted((tuple(r) for r in chat.render(table(spark, rows)).collect()), key=str)
    assert got == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", "a"), (1, 1, None, None), (1, 2, "", ""), (2, 0, "user", "a"), (2, 1, None, ""),
        (3, 0, "user", "a"), (3, 0, "user", "a"), (4, None, "user", "a"), (4, 0, "user", "b"), (5, -1, "user", "a"),
        (None, 0, "user", "z"), (6, 0, "user", "z"), (7, 0, "user", "x" * 100_000), (None, 1, "user", "q"),
        (8, 5, "b", "t"), (8, 5, "a", "t"), (9, 5, "a", "t"),
    ]
    got = sorted((tuple(r) for r in chat.render(table(spark, rows)).collect()), key=str)
    assert got == brute(rows)


def test_long_conversations_are_cut_into_parts(spark):
    long = [(1, i, "user", str(i)) for i in range(700)]
    rows = long + [(2, i, "user", str(i)) for i in range(650)] + [(3, i, "user", str(i)) for i in range(701)]
    got = sorted((tuple(r) for r in chat.render(table(spark, rows)).collect()), key=str)
    assert got == brute(rows) and {r[0] for r in got} == {3} and len(got) == 3


@pytest.mark.parametrize("fine", [chat.FINE, 1])
def test_crowded_turn_numbers_are_cut_by_rows(spark, monkeypatch, fine):
    monkeypatch.setattr(chat, "FINE", fine)
    crowd = [(i % 3 or None, "user" if i % 2 else None, str(i) if i % 5 else "same") for i in range(3000)]
    rows = [(None, *t) for t in crowd + [(9000, "user", "late")]] + [(6, 0, "a", "b")] * chat.RUN
    rows += [(i, *t) for i in (4, 5) for t in crowd + [(9000, "user", "end")]] + [(7, *t) for t in crowd]
    random.Random(1).shuffle(rows)
    got = chat.render(table(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    expected = {}
    for conv, _, n, equal, text in sorted(brute(rows), key=lambda r: r[1]):
        expected[conv] = (n, equal, expected.get(conv, (n, equal, ""))[2] + text)
    whole = {}
    for r in sorted(got, key=lambda r: r.part):
        whole[r.conv_id] = (r.n_turns, r.n_equal, whole.get(r.conv_id, (0, 0, ""))[2] + r.rendered)
    assert whole == expected and set(whole) == {4, None, 6}
    assert max(r.rendered.count(chat.BEGIN) for r in got) == chat.RUN
    assert sorted(r.part for r in got if r.conv_id == 4) == list(range(12))
    assert [r.part for r in got if r.conv_id == 6] == [0]


def test_empty_table(spark):
    assert chat.render(table(spark, [])).collect() == []


def test_no_python_on_the_main_path(spark):
    plan = chat.render(table(spark, snapshots(4, 3)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
