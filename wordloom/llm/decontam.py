"""Benchmark decontamination through a distributed positional inverted index.

The documents are cut into blocks. A block stores, for every token it holds, a
posting list: the ascending positions of the token in the block's text (its
documents laid end to end, with a gap between two). The index is two tables in
the shared folder, postings and documents, so a lost executor costs a search no
indexing work.

A search takes phrases. It fetches the posting lists of the phrases' tokens
only; within a block, a phrase starts from the token whose list is shortest, and
each further list, adjusted by its token's offset, is intersected with what is
left (for proximity: must have a position within the slop). Blocks are searched
independently, so a token that is everywhere has many lists of bounded length
instead of one long one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import bounded_batches, materialize, read_table, release, slices

#: Tokens after which a block is closed (a document is never split).
BLOCK_TOKENS = 1 << 21
#: Bytes of phrase text that are searched at once; more phrases go in further rounds.
ROUND_BYTES = 8 << 20

# tokens are runs of these bytes, A-Z as a-z: digits, letters, all that is not ASCII
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def tokens(text: str | None) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text after A-Z is lower-cased; None has none."""
    return text.encode().translate(_FOLD).split() if text else []


@dataclass
class Index:
    """The stored index: postings(block, token, positions) and docs(block, ord, id, start, n_words)."""

    postings: DataFrame
    docs: DataFrame


def build_index(docs: DataFrame, gap: int, id_col: str = "doc_id", text_col: str = "text",
                block_tokens: int = BLOCK_TOKENS) -> Index:
    """Index whole texts. ``gap`` unused positions follow each document, so that no phrase or slop spans two.

    Null and blank texts have no tokens but a row in ``docs``; repeated rows and
    repeated or null ids are separate entries.
    """
    bounded_batches(docs)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"block bigint, ord int, id {id_type}, start int, n_words int, token binary, positions array<int>"

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        number = 0
        vocabulary: dict[bytes, int] = {}
        ids: list[int] = []
        spots: list[np.ndarray] = []
        rows: list[tuple] = []
        at = 0

        def close(id_arrow):
            nonlocal number, vocabulary, ids, spots, rows, at
            block = (part << 32) + number
            n_docs = len(rows)
            codes = np.array(ids, np.int32)
            order = np.argsort(codes, kind="stable")
            where = (np.concatenate(spots) if spots else np.empty(0, np.int32))[order]
            ends = np.cumsum(np.bincount(codes, minlength=len(vocabulary))).astype(np.int32) if ids else []
            lists = pa.ListArray.from_arrays(np.concatenate(([0], ends)).astype(np.int32), pa.array(where, pa.int32()))
            n_terms = len(vocabulary)
            yield pa.RecordBatch.from_arrays([
                pa.array([block] * n_docs, pa.int64()), pa.array(range(n_docs), pa.int32()),
                pa.array([r[0] for r in rows], id_arrow), pa.array([r[1] for r in rows], pa.int32()),
                pa.array([r[2] for r in rows], pa.int32()), pa.nulls(n_docs, pa.binary()),
                pa.nulls(n_docs, pa.list_(pa.int32()))], names)
            for first in range(0, n_terms, 1 << 16):
                piece = lists.slice(first, 1 << 16)
                n = len(piece)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, block)), pa.nulls(n, pa.int32()), pa.nulls(n, id_arrow),
                    pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()),
                    pa.array(list(vocabulary)[first : first + n], pa.binary()), piece], names)
            number += 1
            vocabulary, ids, spots, rows, at = {}, [], [], [], 0

        names = ["block", "ord", "id", "start", "n_words", "token", "positions"]
        id_arrow = pa.int64()
        for batch in batches:
            id_arrow = batch.column(0).type
            for key, text in (x for _, part in slices(batch) for x in zip(*part, strict=True)):
                words = tokens(text)
                n = len(words)
                rows.append((key, at, n))
                ids += [vocabulary.setdefault(w, len(vocabulary)) for w in words]
                spots.append(np.arange(at, at + n, dtype=np.int32))
                at += n + gap
                if len(ids) >= block_tokens or at >= 1 << 30:
                    yield from close(id_arrow)
        if rows:
            yield from close(id_arrow)
        release()

    stored = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(index, schema)
    stored = materialize(stored, "positional-index")
    return Index(stored.filter("token IS NOT NULL").select("block", "token", "positions"),
                 stored.filter("token IS NULL").select("block", "ord", "id", "start", "n_words"))


def phrases(items: DataFrame, length: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, words): all windows of ``length`` words; an item of fewer words, but not none, is one phrase."""
    id_type = items.schema[id_col].dataType.simpleString()

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = tokens(text)
                found += [(key, words[i : i + length]) for i in range(max(1, len(words) - length + 1)) if words]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], batch.column(0).type),
                                              pa.array([f[1] for f in found], pa.list_(pa.binary()))],
                                             ["item", "words"])

    return items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        windows, f"item {id_type}, words array<binary>")


def _meet(left: np.ndarray, right: np.ndarray, slop: int) -> np.ndarray:
    """The entries of ``left`` that have an entry of ``right`` within ``slop`` (both ascending)."""
    if not len(left) or not len(right):
        return left[:0]
    at = np.searchsorted(right, left - slop)
    return left[(at < len(right)) & (right[np.minimum(at, len(right) - 1)] <= left + slop)]


def phrase_starts(lists: dict[bytes, np.ndarray], words: list[bytes], slop: int = 0) -> np.ndarray:
    """Starts of a phrase in a block, from its rarest token's list on.

    With ``slop`` every other token may lie up to that many positions beside its
    place; a start is then where the rarest token says the phrase begins.
    """
    rare = sorted(range(len(words)), key=lambda k: len(lists[words[k]]))
    left = lists[words[rare[0]]] - rare[0]
    for k in rare[1:]:
        left = _meet(left, lists[words[k]] - k, slop)
        if not len(left):
            break
    return left


def _matcher(shared, slop: int):
    """The search of one block: its posting lists and its documents, for the broadcast phrases."""
    def match(postings: pd.DataFrame, docs: pd.DataFrame) -> pd.DataFrame:
        lists = {bytes(t): np.asarray(p, np.int64) for t, p in zip(postings["token"], postings["positions"],
                                                                 strict=True)}
        docs = docs.sort_values("start", kind="stable").reset_index(drop=True)
        starts, counts = docs["start"].to_numpy(), docs["n_words"].to_numpy()
        found = {"row": [], "item": [], "first": [], "last": []}
        known: dict[tuple, np.ndarray] = {}
        for item, words in shared.value:
            key = tuple(words)
            if key not in known:
                known[key] = (phrase_starts(lists, words, slop) if all(w in lists for w in words)
                              else np.empty(0, np.int64))
            if len(hits := known[key]):
                row = np.searchsorted(starts, np.maximum(hits, 0), side="right") - 1
                found["row"].append(row)
                found["item"] += [item] * len(hits)
                found["first"].append(np.maximum(hits - starts[row] - slop, 0))
                found["last"].append(np.minimum(hits - starts[row] + len(words) + slop, counts[row]))
        if not found["row"]:
            return pd.DataFrame({c: [] for c in ("block", "ord", "item", "first", "last")})
        row = np.concatenate(found["row"])
        return pd.DataFrame({
            "block": docs["of"].iloc[0], "ord": docs["ord"].to_numpy()[row],
            "item": pd.Series(found["item"], dtype=object), "first": np.concatenate(found["first"]).astype(np.int32),
            "last": np.concatenate(found["last"]).astype(np.int32)})

    return match


def search(index: Index, wanted: DataFrame, slop: int = 0, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """Occurrences of the phrases ``wanted(item, words)``: (block, ord, item, first, last), word positions in the
    document ``(block, ord)`` of ``index.docs``, ``last`` exclusive, the range widened by ``slop`` on both sides.

    The phrases are dealt into rounds of at most about ``round_bytes`` of text,
    so what a round sends to the tasks is bounded however long the list is.
    """
    spark = wanted.sparkSession
    wanted = materialize(wanted, "phrases")
    size = wanted.select(F.sum(F.length(F.array_join(F.col("words").cast("array<string>"), " ")))).first()[0] or 0
    rounds = max(1, -(-size // round_bytes))
    item_type = wanted.schema["item"].dataType.simpleString()
    schema = "block bigint, ord int, item binary, first int, last int"
    out = None
    for part in range(rounds):
        held = wanted.filter(F.pmod(F.xxhash64("words"), F.lit(rounds)) == part)
        rows = [(None if r["item"] is None else str(r["item"]).encode(), [bytes(w) for w in r["words"]]) for r in held.toLocalIterator()]
        shared = spark.sparkContext.broadcast(rows)
        terms = held.select(F.explode("words").alias("token")).distinct()

        # the tokens of a round are bounded by round_bytes, so they may be sent to all tasks
        lists = index.postings.join(F.broadcast(terms), "token")
        hits = lists.groupBy("block").cogroup(
            index.docs.select(F.col("block").alias("of"), "ord", "start", "n_words").groupBy("of")).applyInPandas(
            _matcher(shared, slop), schema)
        out = hits if out is None else out.union(hits)
    return out.withColumn("item", F.col("item").cast("string").cast(item_type))


def contamination(docs: DataFrame, items: DataFrame, length: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(block, ord, id, n_words, spans, items): one row per row of ``docs``; both arrays empty where nothing occurs.

    ``spans`` are the merged word ranges (first, last exclusive) of all
    occurrences of a window of ``length`` item words, ``items`` the distinct
    item ids as strings, sorted. Null and blank texts and items have no words
    and match nothing; empty tables give no rows or no hits.
    """
    index = build_index(docs, gap=1, id_col=id_col, text_col=text_col)
    hits = search(index, phrases(items, length, item_col, item_text)).select(
        "block", "ord", F.col("item").cast("string").alias("item"), F.struct("first", "last").alias("span"))
    # per document: at most as many distinct spans as words, and as many items as the benchmark has
    per_doc = hits.groupBy("block", "ord").agg(
        F.array_sort(F.collect_set("span")).alias("all_spans"), F.array_sort(F.collect_set("item")).alias("items"))
    empty = F.array().cast("array<struct<first:int,last:int>>")
    merged = F.aggregate("all_spans", empty, lambda out, s: F.when(
        (F.size(out) > 0) & (F.element_at(out, -1)["last"] >= s["first"]),
        F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(F.struct(
            F.element_at(out, -1)["first"].alias("first"),
            F.greatest(F.element_at(out, -1)["last"], s["last"]).alias("last")))))
        .otherwise(F.concat(out, F.array(s))))
    return index.docs.join(per_doc, ["block", "ord"], "left").select(
        "block", "ord", "id", F.col("n_words").cast("bigint").alias("n_words"),
        F.when(F.col("all_spans").isNull(), empty).otherwise(merged).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"])
    return found.select(
        F.col("id").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))
