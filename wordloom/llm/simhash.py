"""SimHash near-duplicates through a hierarchical index over Gray-ordered fingerprints.

A fingerprint seen as a Gray code word has a rank; in rank order neighbours
share many bits. The index sorts by that rank and factors the bits that a run of
neighbours shares into a node (mask and pattern); a node's mask contains its
parent's, so the differences between two nodes accumulate on the way down, and
a pair of nodes above the limit is dropped with everything below it.

For a cluster the index is cut up: two fingerprints with at most ``max_bits``
differences agree in one of ``max_bits + 1`` segments, so each is stored once
per segment, rotated so that this segment leads the Gray order, and the
segment's value is the uppermost node. A task takes whole upper nodes; one with
more than ``block_rows`` fingerprints is dealt out as pairs of blocks. Copies
(equal fingerprints) are one entry. A task joins what it finds at once and
returns one link per fingerprint, never the pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import bounded_batches, materialize, smallest_reachable

FANOUT = 16
#: Node pairs that are opened at once (each gives FANOUT x FANOUT child pairs).
OPEN_PAIRS = 1024


def fingerprint_batch(texts, shingle: int = 3, chunk: int = 1 << 16) -> np.ndarray:
    """Signed 64-bit SimHash fingerprints of the texts (None: no words)."""
    out = np.zeros(len(texts), np.uint64)
    hashes: list[int] = []
    owners: list[int] = []
    sizes: list[int] = []

    def flush():
        if not owners:
            return
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        votes = (2 * ones > np.array(sizes)[:, None]).astype(np.uint8)
        out[owners] = np.packbits(votes, axis=1).view(">u8").ravel()
        hashes.clear(), owners.clear(), sizes.clear()

    digest = xxhash.xxh64_intdigest
    for row, text in enumerate(texts):
        words = text.encode().lower().split() if text is not None else []
        n = len(words)
        if not n:
            continue
        if n <= shingle:
            hashes.append(digest(b" ".join(words), 42))
            sizes.append(1)
        else:
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
            starts = [0, *ends[: n - shingle].tolist()]
            stops = (ends[shingle - 1 :] - 1).tolist()
            hashes += [digest(line[a:b], 42) for a, b in zip(starts, stops, strict=True)]
            sizes.append(n - shingle + 1)
        owners.append(row)
        if len(hashes) >= chunk:
            flush()
    flush()
    return out.view(np.int64)


def simhash(text: Column, shingle: int = 3) -> Column:
    """The fingerprint of a text column as a signed long."""
    @F.pandas_udf("bigint")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(fingerprint_batch(texts, shingle))

    return run(text)


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint of every row's whole text, as a signed long.

    A-Z are lower-cased; words are ``[^\\x20\\x09-\\x0D]+``; a text of fewer words
    than ``shingle`` is one shingle; null, empty and blank texts have
    fingerprint zero. Repeated rows and null ids are kept.
    """
    return bounded_batches(docs).select(F.col(id_col).alias("id"), simhash(F.col(text_col), shingle).alias("fp"))


def _compress(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``parent`` (roots only) after joining a[i] and b[i]; the smaller index is the root."""
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return parent
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        parent = _compress(parent)


def hierarchical_links(x: np.ndarray, max_bits: int, segment: np.uint64) -> np.ndarray:
    """For each entry of the Gray-ordered ``x`` the index of its group's first entry.

    Joins all entries that agree on the bits of ``segment`` and differ in at
    most ``max_bits`` bits.
    """
    n = len(x)
    parent = np.arange(n)
    if n < 2:
        return parent
    levels = []
    low, high = x, x
    while len(low) > 1:
        pad = -len(low) % FANOUT
        low = np.bitwise_and.reduce(np.append(low, np.repeat(low[-1:], pad)).reshape(-1, FANOUT), axis=1)
        high = np.bitwise_or.reduce(np.append(high, np.repeat(high[-1:], pad)).reshape(-1, FANOUT), axis=1)
        levels.append((low, ~(low ^ high)))
    ci, cj = (g.ravel() for g in np.meshgrid(np.arange(FANOUT), np.arange(FANOUT), indexing="ij"))
    firsts = np.arange(0, n, FANOUT)
    stack = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, i, j = stack.pop()
        if len(i) > OPEN_PAIRS:
            stack.append((level, i[OPEN_PAIRS:], j[OPEN_PAIRS:]))
            i, j = i[:OPEN_PAIRS], j[:OPEN_PAIRS]
        if level == 0:  # skip leaves that are one group already
            least, most = np.minimum.reduceat(parent, firsts), np.maximum.reduceat(parent, firsts)
            todo = ~((least[i] == most[i]) & (least[j] == most[j]) & (least[i] == least[j]))
            i, j = i[todo], j[todo]
        a = (i[:, None] * FANOUT + ci).ravel()
        b = (j[:, None] * FANOUT + cj).ravel()
        size = len(levels[level - 1][0]) if level else n
        ok = (a <= b) & (b < size) if level else (a < b) & (b < size)
        a, b = a[ok], b[ok]
        if level:
            pattern, mask = levels[level - 1]
            diff = (pattern[a] ^ pattern[b]) & mask[a] & mask[b]
        else:
            diff = x[a] ^ x[b]
        near = (np.bitwise_count(diff) <= max_bits) & ((diff & segment) == 0)
        a, b = a[near], b[near]
        if not len(a):
            continue
        if level:
            stack.append((level - 1, a, b))
        else:
            parent = _unite(parent, a, b)
    return parent


def links(fps: DataFrame, max_bits: int = 3, block_rows: int = 1 << 16, flush_rows: int = 1 << 15) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints ``fps(fp)`` within ``max_bits`` bits.

    The links have the same connected components as the graph of all near
    pairs; a fingerprint without a near one is not returned. ``block_rows``
    bounds what one search holds, ``flush_rows`` is the least a search takes.
    """
    n_segments = max_bits + 1
    width = 64 // n_segments

    def rotated(r):
        return F.col("fp") if r == 0 else F.shiftleft("fp", r * width).bitwiseOR(
            F.shiftrightunsigned("fp", 64 - r * width))

    turned = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(r).alias("r"), rotated(r).alias("x")) for r in range(n_segments)])).alias("t")).select(
        "fp", "t.r", F.col("t.x").alias("rank"), F.shiftrightunsigned("t.x", 64 - width).alias("seg"))
    for shift in (1, 2, 4, 8, 16, 32):  # the inverse of the Gray code
        turned = turned.withColumn("rank", F.col("rank").bitwiseXOR(F.shiftrightunsigned("rank", shift)))
    turned = materialize(turned, "gray")
    # at most max_bits + 1 times 2^width nodes, and those above block_rows only
    large = turned.groupBy("r", "seg").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block_rows).select(
        "r", "seg", F.ceil(F.col("n") / block_rows).cast("int").alias("k"))
    own = F.pmod(F.xxhash64("fp"), F.col("k"))
    dealt = turned.join(large, ["r", "seg"], "left").withColumn(
        "block", F.explode(F.when(F.col("k").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"))))
                           .otherwise(F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda o: F.struct(
                               F.least(o, own).cast("int").alias("i"), F.greatest(o, own).cast("int").alias("j"))))))
    dealt = dealt.select("r", "seg", F.col("block.i").alias("i"), F.col("block.j").alias("j"), "rank", "fp")
    full = (1 << 64) - 1
    segments = [np.uint64((((1 << width) - 1) << (64 - width) >> (r * width)) & full) for r in range(n_segments)]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
            for r, rows in part.groupby("r", sort=False):
                x = rows["fp"].to_numpy().view(np.uint64)
                root = hierarchical_links(x, max_bits, segments[r])
                far = x != x[root]
                if far.any():
                    yield pd.DataFrame({"a": x[far].view(np.int64), "b": x[root][far].view(np.int64)})

        held: list[pd.DataFrame] = []
        rows = 0
        for pdf in batches:
            held.append(pdf)
            rows += len(pdf)
            if rows >= flush_rows:  # keep the last group, which may go on
                part = pd.concat(held, ignore_index=True)
                key = part[["r", "seg", "i", "j"]].to_numpy()
                cut = int(np.flatnonzero((key != key[-1]).any(axis=1))[-1] + 1) if (key != key[-1]).any() else 0
                if cut:
                    yield from done(part[:cut])
                held, rows = [part[cut:]], len(part) - cut
        if rows:
            yield from done(pd.concat(held, ignore_index=True))

    keys = ["r", "seg", "i", "j"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "rank").mapInPandas(search, "a bigint, b bigint")


def labels(found: DataFrame, max_bits: int = 3, block_rows: int = 1 << 16) -> DataFrame:
    """(fp, root, component_id) of the distinct fingerprints of ``found(id, fp)``.

    ``root`` is the smallest fingerprint reachable, ``component_id`` the smallest id; null if no row of the component has one.
    """
    fps = materialize(found.groupBy("fp").agg(F.min("id").alias("low")), "distinct_fps")
    comps = materialize(smallest_reachable(links(fps.select("fp"), max_bits, block_rows)), "components")
    member = fps.join(comps, fps["fp"] == comps["node"]).select("fp", "root", "low")
    low = member.groupBy("root").agg(F.min("low").alias("component_id"))
    linked = materialize(member.select("fp", "root").join(low, "root").select("fp", "root", "component_id"), "linked")
    alone = fps.join(linked.select("fp"), "fp", "left_anti").select("fp", F.col("fp").alias("root"), "low")
    return materialize(linked.union(alone), "labels")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, block_rows: int = 1 << 16,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id): one row per row of ``docs``; component_id is the smallest id reachable.

    Rows with equal fingerprints are linked, those without words included. Null
    ids are kept; a component of null ids alone has component_id null. Other
    columns of ``docs`` are not read. An empty table gives an empty result.
    """
    found = materialize(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    return found.join(labels(found, max_bits, block_rows).drop("root"), "fp").select("id", "fp", "component_id")


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    """Components of ``documents``: fingerprints of 3-word shingles, linked at 3 or fewer bits."""
    from wordloom.llm.common import read_table

    out = near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      "component_id")
