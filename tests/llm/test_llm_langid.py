import random
import zlib

from pyspark.sql import functions as F

from wordloom.llm import langid as L

STEMS = {"en": "the of and with ing tion that ther", "de": "der und sch ung ein ich mit zu", "fr": "le des eau que tre oi ent les"}


def text(rng, lang, n):
    parts = STEMS[lang].split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n))


def test_held_out_is_crc32(spark):
    for r in spark.range(200).select("id", L.held_out(F.col("id")).alias("h")).collect():
        assert r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2)


def test_held_out_accuracy(spark):
    rng = random.Random(0)
    rows = [(i, text(rng, lang, rng.randint(5, 60)), lang) for i in range(600) for lang in [rng.choice(list(STEMS))]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    learned = L.learn(docs)
    assert sorted(x for x, _ in learned) == sorted(STEMS)
    got = {r.id: r for r in L.identify(docs, learned).collect()}
    held = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i].lang_pred == lang for i, lang in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.rejected == (r.score < L.MARGIN) for r in got.values())


def test_only_rows_that_are_not_held_out_are_learned(spark):
    rows = [(i, f"held out text {i}" if zlib.crc32(str(i).encode()) % 4 == 2 else f"seen words {i}", "en") for i in range(80)]
    (_, content), = L.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert b"seen" in content and b"held" not in content


def test_odd_rows(spark, odd_docs, odd_rows):
    learned = L.learn(odd_docs)
    assert set(x for x, _ in learned) <= {"en", "de", "fr", "xx"}
    got = L.identify(odd_docs, learned).collect()
    assert len(got) == len(odd_rows)
    blank = {i for i, t, *_ in odd_rows if not t or not any(map(str.isalpha, t))}
    assert all((r.lang_pred == "und") for r in got if r.id in (40, 41, 42)) and {40, 41, 42} <= blank
    assert all(r.lang_pred != "und" for r in got if r.id not in blank)
    digits = spark.createDataFrame([(1, "123 456 ²"), (2, "1 é")], "doc_id bigint, text string")
    assert {r.id: r.lang_pred == "und" for r in L.identify(digits, learned).collect()} == {1: True, 2: False}


def test_empty_table_and_too_many_languages(spark, no_docs, monkeypatch):
    assert L.learn(no_docs) == [] and L.identify(no_docs, []).count() == 0
    monkeypatch.setattr(L, "MOST_LANGUAGES", 2)
    docs = spark.createDataFrame([(i, "abc", f"l{i}") for i in range(12)], "doc_id bigint, text string, lang string")
    try:
        L.learn(docs)
        raise AssertionError
    except ValueError:
        pass
