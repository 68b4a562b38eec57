import collections
import hashlib
import random

import numpy as np
import pandas as pd

from wordloom.llm import substrings as S


def slow(texts):
    words = [(t or "").encode().split() for t in texts]
    seen = collections.Counter(tuple(w[i : i + S.WINDOW]) for w in words for i in range(len(w) - S.WINDOW + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - S.WINDOW + 1):
            if seen[tuple(w[i : i + S.WINDOW])] > 1:
                gone[i : i + S.WINDOW] = [True] * S.WINDOW
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def compare(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)
    got = {r.id: (r.n_words, r.n_removed, r.kept_sha256) for r in S.repeated_ranges(df).collect()}
    assert [got[i] for i in range(len(texts))] == slow(texts)


def test_odd_rows(odd_docs, odd_rows):
    got = S.repeated_ranges(odd_docs).collect()
    want = slow([r[1] for r in odd_rows])
    assert collections.Counter((r.id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == collections.Counter(
        (r[0], *w) for r, w in zip(odd_rows, want, strict=True))


def test_repeats_of_all_kinds(spark, monkeypatch):
    monkeypatch.setattr(S, "PART_BYTES", 2000)
    monkeypatch.setattr(S, "STREAM_BYTES", 3000)
    rng = random.Random(2)

    def some(n, words=3000):
        return " ".join(str(rng.randrange(words)) for _ in range(n))

    passage, other = some(80), some(35)
    texts = [some(50) + " " + passage + "\n" + some(rng.randrange(30)) for _ in range(25)]
    texts += [some(20) + "\t" + " ".join(passage.split()[20:60]) + " " + some(5) for _ in range(5)]
    texts += [other, some(10) + " " + other, " ".join(other.split()[:-1]), "x " * 100, "y " * 35, "y " * 34]
    texts += [some(40) + " " + (part := some(36)) + " z " + part]  # twice in one text
    texts += [t := some(90), t, t, " ".join(t.split()[10:70]), "short copy", "short copy"]
    texts += [some(60, 2) for _ in range(10)]  # few words: many overlapping repeats
    compare(spark, texts)


def test_automaton_against_search():
    rng = random.Random(3)
    for _ in range(60):
        passages = [[rng.choice("abc") for _ in range(rng.randint(1, 9))] for _ in range(3)]
        text = [rng.choice("abcd") for _ in range(12)]
        automaton = S.SuffixAutomaton()
        for p in passages:
            automaton.extend(p)

        def inside(run):
            return any(run == p[i : i + len(run)] for p in passages for i in range(len(p) - len(run) + 1))

        want = [max([k for k in range(1, i + 2) if inside(text[i + 1 - k : i + 1])], default=0) for i in range(12)]
        assert list(automaton.statistics(text)) == want
        covered = {i for i, k in enumerate(want) if k >= 3 for i in range(i + 1 - k, i + 1)}
        assert {i for a, b in S.long_matches(automaton, text, 3) for i in range(a, b)} == covered


def test_word_hashes_and_windows():
    rows = pd.DataFrame({"part": [0, 0], "k1": [1, 2], "k2": [0, 0], "n": [1, 1],
                         "text": [("a bb ccc " * 20).encode(), " ".join(["bb"] * 40).encode()]})
    part = S.Part(rows).hashed()
    assert part.first.tolist() == [0, 60, 100] and len(set(part.h.tolist())) == 3
    at, text = part.windows()
    assert len(at) == 26 + 6 and text.tolist() == [0] * 26 + [1] * 6
    rolled = S._rolled(part.h, S.WINDOW)
    assert rolled[0] == rolled[3] != rolled[1] and len(np.unique(rolled[at])) == 4


def test_empty_table(no_docs):
    assert S.repeated_ranges(no_docs).count() == 0


def test_more_parts_than_buckets(spark, monkeypatch):
    """A table may have fewer buckets than the texts have parts: a bucket then holds several."""
    monkeypatch.setattr(S, "PART_BYTES", 500)
    name = "spark.sql.sources.bucketing.maxBuckets"
    before = spark.conf.get(name)
    spark.conf.set(name, "3")
    try:
        rng = random.Random(6)
        passage = " ".join(str(rng.randrange(900)) for _ in range(50))
        compare(spark, [" ".join(str(rng.randrange(900)) for _ in range(60)) + (" " + passage) * (i % 3 == 0) for i in range(30)])
    finally:
        spark.conf.set(name, before)
