"""Word-level operators: extraction, counts, pair counts, vocabulary, best pair (F1, A1-A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions import text as T


def extract_words(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``words(doc_id, wpos, word)`` -- one row per word occurrence, in text order."""
    return docs.select(F.col(key).alias("doc_id"), F.posexplode(T.words_array(text)).alias("wpos", "word"))


def word_frequency(docs: DataFrame, text: str = "text") -> DataFrame:
    """A1: ``word_freq(word, n)``.  Partial (map-side) counts first, so a very
    frequent word never travels as many rows."""
    return (
        docs.select(F.explode(T.words_array(text)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def start_state(word_freq: DataFrame) -> DataFrame:
    """F2 on distinct words: ``(word, n, t)`` with t the spaced start tokens."""
    return word_freq.select("word", "n", T.spaced_word("word").alias("t"))


def pair_frequency(state: DataFrame) -> DataFrame:
    """A2: adjacent pair counts weighted by word frequency: ``pairs(a, b, n)``."""
    return (
        state.select("n", F.explode(T.adjacent_pairs(T.token_array("t"))).alias("p"))
        .groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b"))
        .agg(F.sum("n").alias("n"))
    )


def state_tokens(state: DataFrame) -> DataFrame:
    """Distinct tokens in use in a training state."""
    return state.select(F.explode(T.token_array("t")).alias("token")).distinct()


def number_vocabulary(tokens: DataFrame) -> DataFrame:
    """A3 numbering: <PAD>=0, <END>=1, the rest from 2 by token (binary order).

    The input is a vocabulary, whose size the caller bounds (target size m),
    so one ordered window over it is small.
    """
    spark = tokens.sparkSession
    rest = tokens.where(~F.col("token").isin(T.PAD, T.END)).select(
        (F.row_number().over(Window.orderBy("token")) + 1).cast("bigint").alias("token_id"), "token"
    )
    specials = spark.createDataFrame([(0, T.PAD), (1, T.END)], "token_id bigint, token string")
    return specials.unionByName(rest)


def vocabulary(state: DataFrame) -> DataFrame:
    """A3: ``vocab(token_id, token)`` of a training state."""
    return number_vocabulary(state_tokens(state))


def best_pair(pairs: DataFrame) -> DataFrame:
    """A5: the pair with the highest count (ties: a, then b ascending); none when below 2."""
    return pairs.where(F.col("n") >= 2).orderBy(F.desc("n"), "a", "b").limit(1)
