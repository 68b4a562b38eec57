"""Substring dedup: suffix automata of reference shards, documents streamed for matching statistics.

A window of ``WINDOW`` words goes if its words also start anywhere else. Sending
every document through the automaton of every shard grows with the square of
the corpus, so a document's text goes only to the shards that hold it:

1. The texts are stored once, one copy of equal ones per task, in parts of
   bounded size (a table bucketed by part: later steps read it without a shuffle).
2. Every window has an anchor: of its ``GRAM``-word runs the one with the least
   hash. Equal windows have equal anchors, so only windows whose anchor occurs
   twice are candidates; of those the hashes of whole windows are counted.
3. A window that occurs twice belongs to the least part that has it. That
   part's first occurrences, joined to passages, are the reference shard; every
   other occurrence is a stretch of text to be streamed through it.
4. A task builds the suffix automaton of a shard and streams stretches through
   it; where the matching statistic is ``WINDOW`` or more, the words are removed.
   A shard with much to stream goes to several tasks with its reference.

A part sends each hash once, however often it has it, so a passage that is in
very many documents makes at most one entry per part.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import bounded_batches, materialize, read_table
from wordloom.session import ensure_checkpoint_dir

WINDOW, GRAM = 35, 8
#: Bytes of text in a part, and bytes that are hashed at once.
PART_BYTES, HASH_BYTES = 4 << 20, 1 << 18
#: Bytes that one task streams through a shard.
STREAM_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, for polynomial hashes of bytes and of words
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of a base modulo 2^64, and their inverses."""
    if base not in _POWERS or len(_POWERS[base][0]) <= n:
        size = 1 << n.bit_length()

        def powers(b):
            out = np.full(size + 1, b, np.uint64)
            out[0] = 1
            return np.cumprod(out)

        _POWERS[base] = powers(base), powers(pow(base, -1, 1 << 64))
    up, down = _POWERS[base]
    return up[: n + 1], down[: n + 1]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads differences over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rolled(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive entries."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = _powers(_BASES[1], len(h))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * up[:-1])))
    return _mixed((sums[size:] - sums[:-size]) * down[:n])


class Part:
    """The distinct texts of a part in the order of their keys, and their words."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values(["k1", "k2"], kind="stable")
        keys = rows[["k1", "k2"]].to_numpy()
        new = np.ones(len(rows), bool)
        new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        self.keys = keys[new]
        group = np.cumsum(new) - 1
        self.copies = np.bincount(group, weights=rows["n"].to_numpy(), minlength=len(self.keys)).astype(np.int64)
        self.texts: list[bytes] = [b""] * len(self.keys)
        for g, text in zip(group.tolist(), rows["text"].tolist(), strict=True):
            if text is not None:
                self.texts[g] = bytes(text)
        self.number = int(rows["part"].iloc[0])

    def hashed(self) -> Part:
        """Adds word hashes, the first word of every text, and the byte ranges of the words."""
        hashes, firsts, begins, ends = [], [0], [], []
        held: list[bytes] = []

        def close():
            raw = np.frombuffer(b" ".join([*held, b""]), np.uint8)
            gap = np.concatenate(([True], _SPACE[raw], [True])).view(np.int8)
            step = np.diff(gap)
            a, b = np.flatnonzero(step == -1), np.flatnonzero(step == 1)
            up, down = _powers(_BASES[0], len(raw))
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + 1) * up[:-1])))
            hashes.append(_mixed((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)))
            offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in held])))
            words = np.searchsorted(a, offsets)
            firsts.extend((words[1:] + firsts[-1]).tolist())
            text = np.repeat(offsets[:-1], np.diff(words))
            begins.append((a - text).astype(np.int32))
            ends.append((b - text).astype(np.int32))
            held.clear()

        size = 0
        for text in self.texts:
            held.append(text)
            size += len(text)
            if size >= HASH_BYTES:
                close()
                size = 0
        if held:
            close()
        self.h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.first = np.array(firsts)
        self.begin = np.concatenate(begins) if begins else np.empty(0, np.int32)
        self.end = np.concatenate(ends) if ends else np.empty(0, np.int32)
        return self

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Start (word of the part) of every window that lies in one text, and the text's number."""
        sizes = np.diff(self.first)
        counts = np.maximum(sizes - WINDOW + 1, 0)
        text = np.repeat(np.arange(len(sizes)), counts)
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return self.first[text] + within, text

    def anchors(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The anchor's hash of the windows that start at ``at``, and its position."""
        grams = _rolled(self.h, GRAM)
        if not len(at):
            return np.empty(0, np.uint64), at
        view = np.lib.stride_tricks.sliding_window_view(grams, WINDOW - GRAM + 1)
        where = np.concatenate([at[i : i + 65536] + view[at[i : i + 65536]].argmin(axis=1)
                                for i in range(0, len(at), 65536)])
        return grams[where], where


def _send(part: int, hashes: np.ndarray, targets: int) -> pd.DataFrame:
    """One row per target that gets hashes: each distinct hash once, and whether it is there twice."""
    distinct, counts = np.unique(hashes, return_counts=True)
    target = (distinct % np.uint64(targets)).astype(np.int64)
    order = np.argsort(target, kind="stable")
    distinct, twice, target = distinct[order], (counts > 1)[order], target[order]
    to, first = np.unique(target, return_index=True)
    cuts = [*first.tolist(), len(target)]
    spans = list(zip(cuts[:-1], cuts[1:], strict=True))
    return pd.DataFrame({
        "target": to.astype(np.int32), "part": np.full(len(to), part, np.int32),
        "hashes": [distinct[a:b].tobytes() for a, b in spans], "twice": [twice[a:b].tobytes() for a, b in spans]})


SENT = "target int, part int, hashes binary, twice binary"
REPLY = "part int, hashes binary, owners binary"


def _resolve(rows: pd.DataFrame) -> pd.DataFrame:
    """For every part the hashes of its own that occur twice in all, and the least part that has each."""
    each = [np.frombuffer(x, np.uint64) for x in rows["hashes"]]
    hashes = np.concatenate(each)
    parts = np.repeat(rows["part"].to_numpy(), [len(x) for x in each])
    twice = np.concatenate([np.frombuffer(x, bool) for x in rows["twice"]])
    distinct, back, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    repeated = counts > 1
    repeated[back[twice]] = True
    owner = np.full(len(distinct), np.iinfo(np.int32).max, np.int32)
    np.minimum.at(owner, back, parts.astype(np.int32))
    out = {"part": [], "hashes": [], "owners": []}
    at = 0
    for part, own in zip(rows["part"].tolist(), each, strict=True):
        k = back[at : at + len(own)]
        at += len(own)
        k = k[repeated[k]]
        if len(k):
            out["part"].append(part)
            out["hashes"].append(distinct[k].tobytes())
            out["owners"].append(owner[k].tobytes())
    return pd.DataFrame(out)


def _reply(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """A part's repeated hashes, ascending, and their owners."""
    if not len(rows):
        return np.empty(0, np.uint64), np.empty(0, np.int32)
    hashes = np.concatenate([np.frombuffer(x, np.uint64) for x in rows["hashes"]])
    owners = np.concatenate([np.frombuffer(x, np.int32) for x in rows["owners"]])
    order = np.argsort(hashes)
    return hashes[order], owners[order]


def _found(sorted_hashes: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries of ``x`` are among the sorted hashes, and where."""
    if not len(sorted_hashes):
        return np.zeros(len(x), bool), np.zeros(len(x), np.int64)
    at = np.minimum(np.searchsorted(sorted_hashes, x), len(sorted_hashes) - 1)
    return sorted_hashes[at] == x, at


STRETCH = "shard int, reference boolean, part int, k1 bigint, k2 bigint, first int, words int, text binary"


def _stretches(part: Part, reply: tuple[np.ndarray, np.ndarray]) -> pd.DataFrame:
    """The part's repeated windows joined to stretches: those that are a shard's reference, and those to stream."""
    part.hashed()
    at, text = part.windows()
    all_windows = _rolled(part.h, WINDOW)
    hashes = all_windows[at] if len(at) else np.empty(0, np.uint64)
    hit, where = _found(reply[0], hashes)
    at, text, hashes, owner = at[hit], text[hit], hashes[hit], reply[1][where[hit]]
    lead = np.zeros(len(at), bool)
    lead[np.unique(hashes, return_index=True)[1]] = True
    reference = lead & (owner == part.number)
    out = {k: [] for k in ("shard", "reference", "part", "k1", "k2", "first", "words", "text")}
    if len(at):
        cut = np.ones(len(at), bool)
        cut[1:] = ((np.diff(at) != 1) | (text[1:] != text[:-1]) | (owner[1:] != owner[:-1])
                   | (reference[1:] != reference[:-1]))
        heads = np.flatnonzero(cut)
        tails = np.append(heads[1:], len(at)) - 1
        for a, b in zip(heads.tolist(), tails.tolist(), strict=True):
            t, w0, w1 = int(text[a]), int(at[a]), int(at[b]) + WINDOW - 1
            for key, value in (("shard", owner[a]), ("reference", reference[a]), ("part", part.number),
                               ("k1", part.keys[t][0]), ("k2", part.keys[t][1]), ("first", w0 - part.first[t]),
                               ("words", w1 - w0 + 1), ("text", part.texts[t][part.begin[w0] : part.end[w1]])):
                out[key].append(value)
    return pd.DataFrame(out)


class SuffixAutomaton:
    """Suffix automaton over words; ``extend`` adds a passage, no match runs from one passage into another."""

    def __init__(self):
        self.step: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.last = 0
        self.passages = 0

    def extend(self, words) -> None:
        self.passages += 1
        self._add(self.passages)  # a number is no word: it parts the passages
        for word in words:
            self._add(word)

    def _add(self, word) -> None:
        step, link, length = self.step, self.link, self.length
        cur, p = len(step), self.last
        step.append({})
        length.append(length[p] + 1)
        link.append(0)
        while p >= 0 and word not in step[p]:
            step[p][word] = cur
            p = link[p]
        if p >= 0:
            q = step[p][word]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(step)
                step.append(step[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(word) == q:
                    step[p][word] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        self.last = cur

    def statistics(self, words) -> Iterator[int]:
        """For every word the length of the longest run ending there that is in a passage."""
        step, link, length = self.step, self.link, self.length
        state = size = 0
        for word in words:
            while state and word not in step[state]:
                state = link[state]
                size = length[state]
            state = step[state].get(word, 0)
            size = size + 1 if state else 0
            yield size


def long_matches(automaton: SuffixAutomaton, words: list, least: int) -> list[tuple[int, int]]:
    """Maximal ranges (first, last exclusive) covered by matches of at least ``least`` words."""
    out: list[tuple[int, int]] = []
    for i, size in enumerate(automaton.statistics(words)):
        if size >= least:
            if out and out[-1][1] >= i + 1 - size:
                out[-1] = (min(out[-1][0], i + 1 - size), i + 1)
            else:
                out.append((i + 1 - size, i + 1))
    return out


SPANS = "part int, k1 bigint, k2 bigint, first int, last int"


def _stream(rows: pd.DataFrame) -> pd.DataFrame:
    """Streams the stretches of one task through the automaton of its shard."""
    automaton = SuffixAutomaton()
    out = []
    seen: dict[bytes, list[tuple[int, int]]] = {}
    for r in rows[rows["reference"]].itertuples():
        automaton.extend(bytes(r.text).split())
        if r.salt == 0:  # a reference window is the first of at least two
            out.append((r.part, r.k1, r.k2, r.first, r.first + r.words))
    for r in rows[~rows["reference"]].itertuples():
        text = bytes(r.text)
        if text not in seen:
            seen[text] = long_matches(automaton, text.split(), WINDOW)
        out += [(r.part, r.k1, r.k2, r.first + a, r.first + b) for a, b in seen[text]]
    return pd.DataFrame(out, columns=["part", "k1", "k2", "first", "last"])


def _kept(part: Part, spans: pd.DataFrame) -> pd.DataFrame:
    """Per text of a part: its words, those removed, and the digest of the rest."""
    removed: dict[tuple, list] = {}
    for k1, k2, a, b in zip(spans["k1"].tolist(), spans["k2"].tolist(), spans["first"].tolist(),
                            spans["last"].tolist(), strict=True):
        removed.setdefault((k1, k2), []).append((a, b))
    rows = []
    for key, copies, text in zip(map(tuple, part.keys.tolist()), part.copies.tolist(), part.texts, strict=True):
        words = text.split()
        n = len(words)
        ranges = [(0, n)] if copies > 1 and n >= WINDOW else sorted(removed.get(key, ()))
        kept, at = [], 0
        for a, b in ranges:
            kept += words[at:a] if a > at else []
            at = max(at, b)
        kept += words[at:]
        rows.append((*key, n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), [list(x) for x in ranges]))
    return pd.DataFrame(rows, columns=["k1", "k2", "n_words", "n_removed", "kept_sha256", "ranges"]).astype(
        {"kept_sha256": object})


def _stored(docs: DataFrame) -> tuple[DataFrame, int]:
    """The texts as a table bucketed by part: (part, k1, k2, n, text); a task stores equal texts once. And the number of parts."""
    spark = docs.sparkSession
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, int] = {}
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            new = []
            for i, key in enumerate(keys):
                seen[key] = seen.get(key, 0) + 1
                if seen[key] == 1:
                    new.append(i)
            some = batch.take(pa.array(new, pa.int64()))
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array([1] * len(new), pa.int64()),
                                              some.column(2).cast(pa.binary())], ["k1", "k2", "n", "text"])
        more = [(k, n - 1) for k, n in seen.items() if n > 1]
        yield pa.RecordBatch.from_arrays([
            pa.array([k[0] for k, _ in more], pa.int64()), pa.array([k[1] for k, _ in more], pa.int64()),
            pa.array([n for _, n in more], pa.int64()), pa.nulls(len(more), pa.binary())], ["k1", "k2", "n", "text"])

    rows = docs.select("k1", "k2", F.col("text").cast("binary").alias("text")).mapInArrow(
        once, "k1 bigint, k2 bigint, n bigint, text binary")
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    buckets = min(parts, most)  # beyond that, a bucket holds several parts, which its task takes one after the other
    rows = rows.select(F.pmod("k1", F.lit(parts)).cast("int").alias("part"), "*").repartition(buckets, "part")
    name = f"substring_texts_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    rows.write.bucketBy(buckets, "part").sortBy("part").option("path", path).saveAsTable(name)
    return spark.table(name), parts


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, ranges): one row per row of ``docs``.

    ``ranges`` are word ranges (first, last exclusive) to remove; they may
    touch or overlap. Null and empty texts have no words. Equal texts of at
    least ``WINDOW`` words are removed altogether, all of them. Null ids,
    repeated rows and shorter texts are kept; other columns are not read; an
    empty table gives an empty result. Windows are compared by 64-bit hashes
    first and then word by word in the automaton.
    """
    keyed = bounded_batches(docs).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = keyed.withColumn("k1", F.xxhash64("text")).withColumn("k2", F.xxhash64(F.lit(1), "text"))
    texts, parts = _stored(keyed)

    def anchors(rows: pd.DataFrame) -> pd.DataFrame:
        part = Part(rows).hashed()
        hashes, where = part.anchors(part.windows()[0])
        return _send(part.number, hashes[np.unique(where, return_index=True)[1]], parts)

    def windows(rows: pd.DataFrame, reply: pd.DataFrame) -> pd.DataFrame:
        if not len(reply):
            return pd.DataFrame({"target": [], "part": [], "hashes": [], "twice": []})
        part = Part(rows).hashed()
        at, _ = part.windows()
        hit, _ = _found(_reply(reply)[0], part.anchors(at)[0])
        return _send(part.number, _rolled(part.h, WINDOW)[at[hit]], parts)

    def stretches(rows: pd.DataFrame, reply: pd.DataFrame) -> pd.DataFrame:
        if not len(reply):
            return pd.DataFrame({k: [] for k in ("shard", "reference", "part", "k1", "k2", "first", "words", "text")})
        return _stretches(Part(rows), _reply(reply))

    def kept(rows: pd.DataFrame, spans: pd.DataFrame) -> pd.DataFrame:
        return _kept(Part(rows), spans)

    by_part = texts.groupBy("part")
    sent = by_part.applyInPandas(anchors, SENT)
    reply = sent.groupBy("target").applyInPandas(_resolve, REPLY)
    sent = by_part.cogroup(reply.groupBy("part")).applyInPandas(windows, SENT)
    reply = sent.groupBy("target").applyInPandas(_resolve, REPLY)
    found = materialize(by_part.cogroup(reply.groupBy("part")).applyInPandas(stretches, STRETCH), "stretches")
    # the tasks of a shard: one row per part at most
    loads = found.filter("NOT reference").groupBy("shard").agg(F.sum(F.octet_length("text")).alias("load"))
    loads = materialize(loads.select("shard", F.ceil(F.col("load") / STREAM_BYTES).cast("int").alias("tasks")), "loads")
    dealt = found.join(loads, "shard", "left").withColumn("tasks", F.coalesce("tasks", F.lit(1)))
    dealt = dealt.withColumn("salt", F.explode(F.when(
        F.col("reference"), F.sequence(F.lit(0), F.col("tasks") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("k1", "first"), F.col("tasks")).cast("int")))))
    dealt = dealt.repartition("shard", "salt")  # else a join by shard leaves a shard in one task
    spans = dealt.groupBy("shard", "salt").applyInPandas(_stream, SPANS)
    result = by_part.cogroup(spans.groupBy("part")).applyInPandas(
        kept, "k1 bigint, k2 bigint, n_words bigint, n_removed bigint, kept_sha256 string, ranges array<array<int>>")
    result = materialize(result, "kept-words")
    return keyed.select("id", "k1", "k2").join(result, ["k1", "k2"]).drop("k1", "k2")


def op10_substrings(spark, sf_dir: str) -> DataFrame:
    out = repeated_ranges(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")
