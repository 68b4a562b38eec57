import random

import numpy as np
from pyspark.sql import functions as F

from wordloom.llm import pieces as P

TOY = {P.MARK: (0, -3.0), "a": (1, -1.0), "b": (2, -1.5), "ab": (3, -2.2), "ba": (4, -2.6), P.MARK + "a": (5, -3.1),
       "aa": (6, -2.0), "aba": (7, -3.0)}


def all_segmentations(seg, text):
    line = P.MARK + text.replace(" ", P.MARK)
    out = []

    def go(i, score, ids):
        if i == len(line):
            out.append((score, tuple(ids)))
            return
        single = False
        for j in range(i + 1, len(line) + 1):
            if hit := seg.pieces.get(line[i:j]):
                go(j, score + hit[1], [*ids, hit[0]])
                single |= j == i + 1
        if not single:
            go(i + 1, score + seg.unknown, ids + [seg.byte_ids[b] for b in line[i].encode()])

    go(0, 0.0, [])
    return sorted(out, key=lambda x: -x[0])


def applied(ids, edits):
    ids = [int(i) for i in ids]
    for at, length, new in sorted(edits, reverse=True):
        ids[at : at + length] = list(new)
    return tuple(ids)


def check(seg, text, n):
    every = all_segmentations(seg, text)
    ids, score, rest = seg.nbest(text, n)
    got = [(score, applied(ids, ()))] + [(s, applied(ids, e)) for s, e in rest]
    assert np.allclose([s for s, _ in got], [s for s, _ in every[:n]])
    assert len({i for _, i in got}) == len(got)
    assert all(any(i == j and abs(s - t) < 1e-9 for t, j in every) for s, i in got)
    assert seg.decode(ids) == text and all(seg.decode(i) == text for _, i in got)


def test_nbest_against_all_segmentations():
    rng = random.Random(1)
    for crossing in ({}, {"b" + P.MARK + "a": (8, -2.5)}):  # with a piece over a word's end nothing is cut
        seg = P.Segmenter(TOY | crossing, list(range(100, 356)))
        assert seg.crossing == bool(crossing)
        for _ in range(150):
            check(seg, "".join(rng.choice("aab cé") for _ in range(rng.randint(1, 7))), rng.randint(1, 5))


def test_small_memory_and_long_chunks(monkeypatch):
    monkeypatch.setattr(P, "REMEMBERED", 3)
    monkeypatch.setattr(P, "TOGETHER", 4)
    seg = P.Segmenter(TOY, list(range(100, 356)))
    texts = ["ab ba aba", "a b ab aab ba", "", "abab abba", "ab ba aba"]
    together = seg.nbest_all(texts, 3)
    for t, (ids, score, rest) in zip(texts, together, strict=True):
        if t:
            check(P.Segmenter(TOY, list(range(100, 356))), t, 3)
            assert abs(score - all_segmentations(seg, t)[0][0]) < 1e-9 and len(rest) <= 2
        else:
            assert len(ids) == 0 and score == 0 and rest == []


def test_round_trip_of_the_model(odd_docs, odd_rows):
    out = P.decode(P.encode(odd_docs, n=2))
    rows = out.collect()
    assert len(rows) == len(odd_rows)
    texts = {}
    for i, t, *_ in odd_rows:
        texts.setdefault(i, set()).add(t)
    for r in rows:
        assert r.decoded is None and None in texts[r.id] if r.ids is None else (
            r.lossless == (r.decoded in texts[r.id]) or "▁" in (r.decoded or ""))
        if r.ids == []:
            assert r.score == 0 and r.lossless and r.decoded == ""
    assert sum(r.lossless is False for r in rows) == 1  # the text that holds the word mark


def test_best_score_beats_the_library(odd_rows):
    """The library's greedy merges are one segmentation; Viterbi's is at least as good."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=P.model_path())
    seg = P.segmenter(P.model_path())
    for _, text, *_ in odd_rows[:20]:
        ids, score, _ = seg.nbest(text, 2)
        assert model.decode(ids.tolist()) == text
        merged = sum(model.get_score(i) for i in model.encode(text))
        assert score >= merged - 1e-6


def test_empty_table(no_docs):
    out = P.encode(no_docs)
    assert out.count() == 0 and P.decode(out).filter(F.col("decoded").isNull()).count() == 0


def test_lengths_and_ids_against_the_library(spark):
    """Best segmentations are about as short as the library's and mostly the same words."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=P.model_path())
    texts = ["The quick brown fox jumps over the unbelievable lazy dog while internationalization proceeds.",
             "Device drivers are loaded when the system starts, and the log shows which ones failed.",
             "Der schnelle Fuchs springt  über den faulen Hund\tund 1234 mal ① zurück.", "", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 20)], "doc_id bigint, text string").repartition(3)
    own = [model.encode(t) for t in texts if t]
    want = np.bincount(np.concatenate(own), minlength=model.get_piece_size()) * 20
    assert (P.piece_counts(docs) == want).all()
    got = {r.id: r for r in P.encode(docs, n=2).collect()}
    for k, t in enumerate(texts[:3]):
        ids = got[k].ids
        assert model.decode(ids) == t and got[k].lossless and len(ids) <= 1.05 * len(own[k])
        same = set(map(model.id_to_piece, ids)) & set(map(model.id_to_piece, own[k]))
        assert len(same) >= 0.9 * len(set(own[k]))
    assert [model.id_to_piece(i) for i in got[0].ids[:3]] == ["▁The", "▁quick", "▁brown"]
    scores = P.log_probabilities(want)
    assert abs(got[0].score - sum(scores[i] for i in got[0].ids)) < 1e-6
