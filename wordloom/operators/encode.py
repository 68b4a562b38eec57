"""Encoding text with merge rules, and token -> id lookup.

Rules and vocabulary are a model: their size is the tokenizer's, whatever the
corpus. They are sent to the tasks once, after a check of their bytes
(``MODEL_BYTES``). Documents are encoded row by row in Arrow batches; a task
remembers the words it has seen (up to a fixed number), so the rules are
replayed on distinct words. What it remembers and the texts that it holds as
Python objects at once are bounded by letters, so its memory grows neither with
the corpus nor with the rows of an Arrow batch. A document is never split,
nothing is shuffled, and the token order is the array order.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush
from string import ascii_lowercase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions.text import WORD_END
from wordloom.session import stored

#: Bytes of a model (rules or vocabulary) that may be sent to every task.
MODEL_BYTES = 1 << 30
#: Letters of the words that a task remembers, and bytes of text (of whole rows) that it holds as Python objects.
REMEMBERED, TEXT_BYTES = 1 << 20, 1 << 20

_WORDS = re.compile("[A-Za-z]+")


class Memory:
    """What is known of words, of ``REMEMBERED`` letters in all: when these are full it begins again."""

    def __init__(self):
        self.known: dict = {}
        self.letters = 0

    def keep(self, word: str, found):
        self.letters += len(word)
        if self.letters > REMEMBERED:
            self.known.clear()
            self.letters = len(word)
        if len(word) <= REMEMBERED:
            self.known[word] = found
        return found


class Encoder:
    """Replays merge rules on words: each rule once, in order, on all its places from left to right.

    The places where a rule could be applied wait in a heap by (rank, place), and
    the tokens are a linked list, so the work grows with the letters of a word
    and not with the rules.
    """

    def __init__(self, rules: Sequence[tuple[str, str]]):
        self.rules = list(rules)
        self.ranks: dict[tuple[str, str], list[int]] = {}
        for rank, pair in enumerate(self.rules):
            self.ranks.setdefault(pair, []).append(rank)
        self.merged = [a + b for a, b in self.rules]  # the tokens of all words share these strings
        self.memory = Memory()

    def replay(self, word: str) -> list[str]:
        tokens: list = [*word, WORD_END]
        end = len(tokens)
        after, before = [*range(1, end + 1)], [*range(-1, end - 1)]
        ranks = self.ranks
        heap = [(r[0], i) for i, pair in enumerate(zip(tokens, tokens[1:])) if (r := ranks.get(pair))]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if j >= end or (tokens[i], tokens[j]) != self.rules[rank]:
                continue  # one of the two has been merged meanwhile
            tokens[i] = self.merged[rank]
            tokens[j] = None
            after[i] = k = after[j]
            h = before[i]
            if k < end:
                before[k] = i
            for x, y in ((h, i), (i, k)):
                if 0 <= x and y < end and (r := ranks.get((tokens[x], tokens[y]))) and r[-1] > rank:
                    heappush(heap, (r[bisect_right(r, rank)], x))  # rules before this one have had their turn
        return [t for t in tokens if t is not None]

    def word(self, word: str) -> list[str]:
        found = self.memory.known.get(word)
        return self.memory.keep(word, self.replay(word)) if found is None else found

    def text(self, text: str | None) -> list[str]:
        """The tokens of a text's words (ASCII letter runs, lower-cased)."""
        return [t for w in _WORDS.findall(text or "") for t in self.word(w.lower())]


def checked_size(size: int, what: str) -> None:
    if size > MODEL_BYTES:
        raise OverflowError(f"{what} of {size} bytes is above MODEL_BYTES={MODEL_BYTES}")


def _rule_pairs(rules) -> list[tuple[str, str]]:
    out = [(r[0], r[1]) for r in rules if r[0] and r[1] and not any(c.isspace() for c in r[0] + r[1])]
    checked_size(sum(len(a) + len(b) for a, b in out), "a rule list")
    return out


def _few(rows: pa.Array) -> Iterator[pa.Array]:
    """Rows of strings in stretches of about ``TEXT_BYTES`` bytes; a longer row is one by itself."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(rows), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first, before = 0, 0
    while first < len(rows):
        last = max(first + 1, int(np.searchsorted(ends, before + TEXT_BYTES, side="right")))
        yield rows.slice(first, last - first)
        first, before = last, int(ends[last - 1])


def _looked_up(encoder: Encoder, names: Sequence[str]):
    """A function of rows of texts: the places in ``names`` of their tokens (others are dropped), and where each text ends.

    A word is remembered as the bytes of its places, and a text's words are put together as bytes.
    """
    place = {t: i for i, t in enumerate(names)}
    memory = Memory()
    known = memory.known.get

    def new(word: str) -> bytes:
        return memory.keep(word, np.array([place[t] for t in encoder.replay(word.lower()) if t in place], np.int32).tobytes())

    def run(rows: pa.Array) -> tuple[np.ndarray, pa.Array]:
        texts = [b"".join([f if (f := known(w)) is not None else new(w) for w in _WORDS.findall(text or "")])
                 for text in rows.to_pylist()]
        ends = np.cumsum([0, *map(len, texts)], dtype=np.int64) // 4
        return np.frombuffer(b"".join(texts), np.int32), pa.array(ends, pa.int32())

    return run


def _encoding(rules, whole_text: bool):
    pairs = _rule_pairs(rules)

    @F.arrow_udf("array<string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(pairs)
        names = list(dict.fromkeys([*ascii_lowercase, WORD_END, *encoder.merged]))  # all tokens there can be
        look_up, tokens = _looked_up(encoder, names), pa.array(names, pa.string())
        for rows in (part for batch in batches for part in _few(batch)):
            if whole_text:
                at, ends = look_up(rows)
                yield pa.ListArray.from_arrays(ends, tokens.take(pa.array(at)))
            else:
                yield pa.array([None if w is None else encoder.word(w) for w in rows.to_pylist()], pa.list_(pa.string()))

    return run


def encode_words(words: DataFrame, rules: Sequence, word: str = "word", keep: Sequence[str | Column] = ()) -> DataFrame:
    """E1 on a table of words: ``(word, *keep, tokens ARRAY<STRING>)``; each rule is replayed once, in order."""
    return words.select(F.col(word).alias("word"), *keep, _encoding(rules, False)(F.col(word)).alias("tokens"))


def encode_documents(docs: DataFrame, rules: Sequence, text: str = "text", key: str = "doc_id",
                     keep: Sequence[str | Column] = ()) -> DataFrame:
    """``(doc_id, *keep, tokens ARRAY<STRING>)`` in text order, per document (null text: no tokens)."""
    return docs.select(F.col(key).alias("doc_id"), *keep, _encoding(rules, True)(F.col(text)).alias("tokens"))


def encode_to_ids(docs: DataFrame, rules: Sequence, vocab: DataFrame, text: str = "text", key: str = "doc_id",
                  keep: Sequence[str | Column] = (), tokens: bool = False) -> DataFrame:
    """E3 in one pass: ``(doc_id, *keep, ids)``, with ``tokens`` also the tokens; those without an id are dropped.

    A task remembers a word's places in the vocabulary, so the tokens of a text are not looked up one by one.
    """
    pairs = _rule_pairs(rules)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary_map(vocab))

    @F.arrow_udf("struct<tokens:array<string>,ids:array<bigint>>" if tokens else "struct<ids:array<bigint>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = list(shared.value)
        look_up, strings = _looked_up(Encoder(pairs), names), pa.array(names, pa.string())
        numbers = np.fromiter(shared.value.values(), np.int64, len(names))
        for rows in (part for batch in batches for part in _few(batch)):
            at, ends = look_up(rows)
            ids = pa.ListArray.from_arrays(ends, pa.array(numbers[at]))
            if tokens:
                yield pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, strings.take(pa.array(at))), ids], ["tokens", "ids"])
            else:
                yield pa.StructArray.from_arrays([ids], ["ids"])

    done = docs.select(F.col(key).alias("doc_id"), *keep, run(F.col(text)).alias("known"))
    return done.select(*[c for c in done.columns if c != "known"], "known.*")


def first_ids(vocab: DataFrame) -> DataFrame:
    """A vocabulary with one id per token: the first (lowest) id wins."""
    return vocab.groupBy("token").agg(F.min("token_id").alias("token_id"))


def vocabulary_map(vocab: DataFrame) -> dict[str, int]:
    """The vocabulary as token -> first id, after a check of its bytes."""
    size = vocab.agg(F.sum(F.octet_length("token") + 64)).first()[0] or 0
    checked_size(size, "a vocabulary")
    return {r.token: r.token_id for r in first_ids(vocab).toLocalIterator()}


def with_ids(doc_tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """F6 + J1: ``doc_tokens`` with tokens without an id dropped (later ones close up), and their ``ids``."""
    shared = doc_tokens.sparkSession.sparkContext.broadcast(vocabulary_map(vocab))

    @F.arrow_udf("struct<tokens:array<string>,ids:array<bigint>>")
    def look_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = pa.array(list(shared.value), pa.string())
        ids = pa.array(list(shared.value.values()), pa.int64())
        for rows in batches:
            flat = rows.flatten().cast(pa.string())
            at = pc.index_in(flat, names)
            known = at.is_valid()
            ends = np.cumsum(pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            before = np.concatenate(([0], np.cumsum(known.to_numpy(zero_copy_only=False), dtype=np.int64)))
            cuts = pa.array(before[np.concatenate(([0], ends))], pa.int32())
            yield pa.StructArray.from_arrays([pa.ListArray.from_arrays(cuts, flat.filter(known)),
                                              pa.ListArray.from_arrays(cuts, ids.take(at.filter(known)))], ["tokens", "ids"])

    rest = [c for c in doc_tokens.columns if c != "tokens"]
    return doc_tokens.select(*rest, look_up("tokens").alias("known")).select(*rest, "known.*")


def ids_stream(doc_tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """E3 + J1 + J2: ``(doc_id, pos, token, token_id)`` with unknown tokens skipped.

    Positions are counted after the skip, so neighbours close up.
    """
    return with_ids(doc_tokens, vocab).select(
        "doc_id", F.posexplode(F.arrays_zip("tokens", "ids")).alias("pos", "t")).select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), F.col("t.tokens").alias("token"),
        F.col("t.ids").alias("token_id"))


def oov_tokens(doc_tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """Tokens that have no id, with counts (the tokenizer skips them silently).

    Counted first, so the join meets one row per distinct token.
    """
    counts = doc_tokens.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(vocab.select("token").distinct(), "token", "left_anti")


#: Documents in a bucket of the running sum over documents.
BUCKET_DOCS = 1 << 16


def doc_offsets(doc_tokens: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``(doc_id, offset)``: where each document starts in the one-stream view, documents in doc_id order.

    With ``keep`` also these columns, and ``bucket``, by which the rows are dealt.

    A running sum in two levels: documents are range partitioned by id, in
    buckets of about ``BUCKET_DOCS``; the bucket totals are summed over one row
    per bucket, and each bucket sums its own documents.
    """
    items = "ids" if "ids" in doc_tokens.columns else "tokens"
    lens = stored(doc_tokens.select("doc_id", F.size(items).cast("bigint").alias("len"), *keep), "doc-sizes")  # the tokens are read once
    n = lens.count()
    lens = lens.repartitionByRange(max(1, -(-n // BUCKET_DOCS)), "doc_id").withColumn("bucket", F.spark_partition_id())
    lens = stored(lens, "doc-lengths")  # the buckets are fixed here, for both uses below
    tot = lens.groupBy("bucket").agg(F.sum("len").alias("btot"))
    before = F.sum("btot").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("btot")
    inb = Window.partitionBy("bucket").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, 0)
    return lens.join(tot.select("bucket", before.alias("bstart")), "bucket").select(
        "doc_id", (F.col("bstart") + F.sum("len").over(inb) - F.col("len")).alias("offset"), *(["bucket", *keep] if keep else [])
    )


def global_positions(doc_tokens: DataFrame) -> DataFrame:
    """One stream over the whole corpus, documents in doc_id order.

    The offsets are joined document to document (one row each side) before
    the tokens are exploded.  Output ``(doc_id, pos, token, gpos)``.
    """
    return (
        doc_tokens.join(doc_offsets(doc_tokens), "doc_id")
        .select("doc_id", "offset", F.posexplode("tokens").alias("pos", "token"))
        .select("doc_id", F.col("pos").cast("bigint").alias("pos"), "token",
                (F.col("offset") + F.col("pos")).cast("bigint").alias("gpos"))
    )
