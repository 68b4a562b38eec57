from pyspark.sql import functions as F

from tests.conftest import docs
from wordloom.functions import text as T
from wordloom.operators import words as W


def test_extract_words_ascii_only(spark):
    df = docs(spark, "für A1b It's", "Kelvin", "123 !?", "")
    got = {r.doc_id: r.w for r in df.select("doc_id", T.words_array("text").alias("w")).collect()}
    assert got[0] == ["f", "r", "a", "b", "it", "s"]
    assert got[1] == ["elvin"]  # the Kelvin sign is not an ASCII letter
    assert got[2] == [] and got[3] == []


def test_word_frequency_tiny(spark):
    wf = {r.word: r.n for r in W.word_frequency(docs(spark, "low lower lowest low lower")).collect()}
    assert wf == {"low": 2, "lower": 2, "lowest": 1}


def test_start_pairs_tiny(spark):
    st = W.start_state(W.word_frequency(docs(spark, "low lower lowest low lower")))
    pairs = {(r.a, r.b): r.n for r in W.pair_frequency(st).collect()}
    assert pairs == {("l", "o"): 5, ("o", "w"): 5, ("w", "e"): 3, ("e", "r"): 2, ("r", "</w>"): 2,
                     ("w", "</w>"): 2, ("e", "s"): 1, ("s", "t"): 1, ("t", "</w>"): 1}
    best = W.best_pair(W.pair_frequency(st)).collect()[0]
    assert (best.a, best.b, best.n) == ("l", "o", 5)  # tie with o+w broken by a, b ascending


def test_merge_is_greedy_left_to_right(spark):
    df = spark.createDataFrame([("aaaa",), ("aaa",)], "w string")
    out = df.select("w", T.token_array(T.merge_pair(T.spaced_word("w"), "a", "a")).alias("k")).collect()
    got = {r.w: r.k for r in out}
    assert got["aaaa"] == ["aa", "aa", "</w>"]
    assert got["aaa"] == ["aa", "a", "</w>"]


def test_parse_rules(spark):
    rules = ["a + b -> ab", "x", "a+b -> ab", " + b -> b", "a -> b + c", "a + -> b", "a + b -> zzz", "lo + w -> low"]
    df = spark.createDataFrame([(r,) for r in rules], "rule string")
    a, b = T.parse_rule("rule")
    got = [(r.a, r.b) for r in df.select(a.alias("a"), b.alias("b")).collect()]
    assert got == [("a", "b"), (None, None), (None, None), (None, None), (None, None), (None, None), ("a", "b"),
                   ("lo", "w")]


def test_adjacent_pairs_one_token(spark):
    df = spark.createDataFrame([(["x"],), (["a", "b", "c"],), ([],)], "k array<string>")
    got = [[(p.a, p.b) for p in r.p] for r in df.select(T.adjacent_pairs("k").alias("p")).collect()]
    assert got == [[], [("a", "b"), ("b", "c")], []]


def test_format_rule(spark):
    df = spark.createDataFrame([("lo", "w")], "a string, b string")
    assert df.select(T.format_rule("a", "b").alias("r")).collect()[0].r == "lo + w -> low"
