"""The tokenizer's three commands as Spark jobs over files.

``bpe_command``    corpus files -> ``<out>.voc`` and ``<out>.merges``
``encode_command`` rules + text files -> ``<out>.tok`` (and ``<ids>.ids`` with a vocabulary)
``train_command``  vocabulary + (text + rules, or an ids file) -> ``<out>.emb`` and ``<out>.meta``

Inputs are text files (one document per file) or a parquet ``documents``
table; outputs are written in the text formats, or as parquet with
``fmt='parquet'``.  Argument checks follow the commands' rules (positive
integers, lr > 0, exactly one training source).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators import bpe as B
from wordloom.operators import encode as E
from wordloom.operators import sgns as G
from wordloom.session import spread, stored
from wordloom.sources import files as IO
from wordloom.sources.options import TrainOptions, validate_sources, validate_target_size


def _docs(spark: SparkSession, src) -> DataFrame:
    if isinstance(src, DataFrame):
        return src.select("doc_id", "text")
    if str(src).endswith(".parquet"):
        return spread(spark.read.parquet(src).select("doc_id", "text"))
    return IO.read_corpus(spark, src).select("doc_id", "text")


def bpe_command(spark: SparkSession, src, out: str, m: int, fmt: str = "text") -> dict:
    """Train merge rules until the vocabulary reaches m; write vocabulary and rules."""
    validate_target_size(m)
    t0 = time.time()
    model = B.train_bpe(_docs(spark, src), m)
    ms = int((time.time() - t0) * 1000)
    IO.write_vocab(model.vocab, f"{out}.voc", fmt)
    IO.write_merges(model.merges, f"{out}.merges", fmt)
    return {"vocabulary_size": model.vocab.count(), "merges": len(model.rules), "elapsed_ms": ms}


def _rules(spark: SparkSession, mergefile: str):
    return IO.rules_list(IO.read_rule_lines(spark, f"{mergefile}.merges"))


def encode_command(spark: SparkSession, mergefile: str, src, out: str, ids: str | None = None) -> dict:
    """Encode text with the rules of ``mergefile``; ids need ``<mergefile>.voc``."""
    t0 = time.time()
    # encoded once; both outputs and the counts are read from the stored result
    enc = E.encode_documents(_docs(spark, src), _rules(spark, mergefile))
    if ids is not None:
        known = E.with_ids(enc.withColumn("all", F.col("tokens")), IO.read_vocab(spark, f"{mergefile}.voc"))
        enc = known.select("doc_id", F.col("all").alias("tokens"), "ids")
    enc = stored(enc, "encoded")
    IO.write_tokens(enc, f"{out}.tok")
    res = {"tokens": enc.select(F.sum(F.size("tokens"))).first()[0] or 0}
    if ids is not None:
        IO.write_ids(enc.select("doc_id", "ids"), f"{ids}.ids", fmt="text")
        res["ids"] = enc.select(F.sum(F.size("ids"))).first()[0] or 0
    res["elapsed_ms"] = int((time.time() - t0) * 1000)
    return res


def _id_table(spark: SparkSession, path: str, size: int) -> DataFrame:
    """A parquet id table ``(doc_id, pos, token_id)`` as ``(doc_id, ids)``.

    Ids at or above the vocabulary size are dropped before the arrays are built,
    so neighbours close up; each group is one document.
    """
    ids = spark.read.parquet(path).where((F.col("token_id") >= 0) & (F.col("token_id") < size))
    return ids.groupBy("doc_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "token_id"))), lambda e: e.token_id).alias("ids"))


def train_command(spark: SparkSession, mergefile: str, out: str, input_text=None, tokens: str | None = None,
                  options: TrainOptions = TrainOptions(), fmt: str = "text") -> dict:
    """Train token vectors from text (encoded with the rules) or from an ids file."""
    options.validate()
    source = validate_sources(input_text, tokens)
    vocab = IO.read_vocab(spark, f"{mergefile}.voc")
    if source == "input":
        doc_tokens = E.encode_documents(_docs(spark, input_text), _rules(spark, mergefile))
        corpus = str(input_text)
    elif str(tokens).endswith(".parquet"):
        doc_tokens = _id_table(spark, tokens, vocab.count())
        corpus = str(tokens)
    else:
        doc_tokens = IO.read_id_lines(spark, f"{tokens}.ids", vocab_size=vocab.count())
        corpus = f"{tokens}.ids"
    res = G.sgns_fit(doc_tokens, vocab, options)
    IO.write_embeddings(res.vectors, f"{out}.emb", res.vocabulary_size, fmt)
    IO.write_run_metadata(IO.run_row(spark, mergefile, corpus, options, res), f"{out}.meta", fmt)
    return {"token_count": res.token_count, "vocabulary_size": res.vocabulary_size, "elapsed_ms": res.elapsed_ms}
