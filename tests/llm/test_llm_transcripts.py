import random

import numpy as np
import pytest

from wordloom.llm import transcripts as T


def test_markers():
    for line, want in [("User: hi", 2), ("**AI:** x", 3), ("### System", 1), ("<|assistant|> x", 3), ("A: yes", 3), ("[Human]: q", 2),
                       ("Note: x", 4), ("plain text", 0), ("", 0), ("http://x", 0)]:
        assert T.marker(line)[0] == want, line
    assert "User: hi"[T.marker("User: hi")[1]:] == "hi"


@pytest.fixture(scope="module")
def chats(spark):
    rng = random.Random(1)
    rows = []
    for c in range(60):
        n = 300 if c == 7 else rng.randint(1, 9)
        for t in range(n):
            role = "system" if t == 0 and c % 3 == 0 else ("user", "assistant")[t % 2]
            size = 30 if role == "assistant" else 5
            text = "\n".join("Word " * rng.randint(size, 2 * size) + "." for _ in range(rng.randint(1, 3)))
            rows.append((c, t * (3 if c == 9 else 1), role, text))
    rows += [(100, 0, None, ""), (100, 1, "other", "x"), (None, 0, "user", "x"), (101, None, "user", "x"), (101, 2, "user", None),
             rows[5], rows[5], (102, 5000, "user", "late"), (103, -1, "user", "x")]
    return spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "conv_id bigint, turn int, role string, text string, at string, block int").repartition(3)


def test_split_viterbi_is_viterbi(chats, monkeypatch):
    pieces = T.transcripts(chats)
    model = T.train(pieces)
    rows = pieces.collect()
    assert len({(r.conv, r.at) for r in rows}) == len(rows)
    got = {(r.conv, r.at): r for r in T.decode(pieces, model).collect()}
    assert len(got) == len(rows)
    whole = {}
    for r in sorted(rows, key=lambda r: (r.conv, r.at)):
        whole.setdefault(r.conv, []).append(r)
    for c, parts in whole.items():
        states = T.best_path(model.matrices([x for r in parts for x in r.lines]), T.START)
        split = [s for r in parts for s in got[(c, r.at)].states]
        assert split == states
        before = T.START
        for r in parts:
            assert got[(c, r.at)].enter == before
            before = got[(c, r.at)].states[-1]


def test_roles_are_recovered(chats):
    pieces = T.transcripts(chats)
    model = T.train(pieces.filter("conv % 2 = 0"))
    truth = {(r.conv, r.at): (r.role, len(r.lines)) for r in pieces.collect()}
    right = []
    for r in T.format_chats(pieces, model).collect():
        role, n = truth[(r.conv, r.at)]
        if r.conv % 2 and role in T.ROLES:
            right += [x == role for x in r.roles]
            assert len(r.roles) == len(r.begins) == n
    assert np.mean(right) > 0.95


def test_rendering():
    lines = ["User: hi", "there", "### Assistant", "yes", "A: again"]
    assert T.rendered(lines, T.START, [2, 3, 4, 5, 4]) == (
        "<|user|>\nhi\nthere\n<|end|>\n<|assistant|>\nyes\n<|end|>\n<|assistant|>\nagain\n")
    assert T.rendered(["more", "Q: x"], 3, [3, 2]) == "more\n<|end|>\n<|user|>\nx\n"


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn int, role string, text string")
    pieces = T.transcripts(none)
    assert T.format_chats(pieces, T.train(pieces)).count() == 0
