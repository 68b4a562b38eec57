"""Source divergence: how far the term shares of a language's sources lie apart, by a quadtree over their counts.

Rows of the count matrix are the (lang, source) groups, columns the language's
kept terms. Most counts are zero, and zero counts of two groups all add the same
amount, which depends on the two groups' totals alone. So the matrix is held as
a K^2 tree (K = 2): a node says whether its quadrant has a count. For all pairs
of groups together the tree is walked from the root with a row node for each
side; where both quadrants are empty, their columns are counted once for all
pairs below (and priced at the end), and only columns in which one of the two
groups has a count are opened down to a leaf.

For a cluster the columns are dealt in blocks of about ``TERM_BLOCK`` terms and
the rows in blocks of about ``GROUP_BLOCK`` groups; a task holds the trees of one
column block and two row blocks. Sums of the column blocks are added. All
arithmetic is on whole numbers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import bounded_batches, materialize, release, slices

TERM_BLOCK = 1024
GROUP_BLOCK = 128
#: Counts that a task holds before it sends them on.
HELD = 300_000
#: Node pairs that are opened at once (each gives 8 child pairs).
OPEN_PAIRS = 1 << 15

_TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def group_terms(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of terms in groups, and documents with them; a null term for each group."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def sent():
            for (lang, source), (n, d) in held.items():
                terms = [None, *n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                     pa.array(terms, pa.string()), pa.array([0, *n.values()], pa.int64()),
                     pa.array([0, *(d[t] for t in n)], pa.int64())], ["lang", "source", "term", "n", "docs"])
            held.clear()

        for batch in batches:
            for _, columns in slices(batch):
                for lang, source, text in zip(*columns, strict=True):
                    n, d = held.setdefault((lang, source), (Counter(), Counter()))
                    words = _TERMS.findall(text.encode().lower().decode())  # bytes: A-Z only
                    n.update(words)
                    d.update(set(words))
                if sum(len(n) for n, _ in held.values()) >= HELD:
                    yield from sent()
        yield from sent()
        release()

    read = bounded_batches(docs).select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in (
        (lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    counted = read.mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column) -> Column:
    """1 + floor(10^9 count / total), exact for any long."""
    scaled = count.cast("decimal(20,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    return F.call_function("div", scaled, total.cast("decimal(20,0)")) + F.lit(1).cast("bigint")


def distance(p, q):
    """floor((p - q)^2 / (p + q)) of whole numbers."""
    return (p - q) * (p - q) // (p + q)


def count_tree(occupied: np.ndarray) -> list[np.ndarray]:
    """Levels of the K^2 tree of a matrix, leaves first: whether a quadrant of side 2^level has a count."""
    levels = [occupied]
    while max(occupied.shape) > 1:
        rows, cols = (s + s % 2 for s in occupied.shape)
        even = np.zeros((rows, cols), bool)
        even[: occupied.shape[0], : occupied.shape[1]] = occupied
        occupied = even.reshape(rows // 2, 2, cols // 2, 2).any(axis=(1, 3))
        levels.append(occupied)
    return levels


def pair_sums(left: np.ndarray, right: np.ndarray, left_zero: np.ndarray, right_zero: np.ndarray, same: bool) -> np.ndarray:
    """The summed distances of all rows of ``left`` and ``right`` (shares; a count of zero has ``*_zero`` of its row).

    ``same``: both are the same rows, and only pairs with the first before the second are summed.
    """
    a_tree, b_tree = count_tree(left > left_zero[:, None]), count_tree(right > right_zero[:, None])
    while len(a_tree) < len(b_tree):
        a_tree.append(a_tree[-1])
    while len(b_tree) < len(a_tree):
        b_tree.append(b_tree[-1])
    terms = left.shape[1]
    sums = np.zeros((len(left), len(right)), np.int64)
    empty = [np.zeros((len(a), len(b)), np.int64) for a, b in zip(a_tree, b_tree, strict=True)]
    half = np.array([(i, j, c) for i in (0, 1) for j in (0, 1) for c in (0, 1)])
    stack = [(len(a_tree) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, i, j, c = stack.pop()
        if len(i) > OPEN_PAIRS:
            stack.append((level, i[OPEN_PAIRS:], j[OPEN_PAIRS:], c[OPEN_PAIRS:]))
            i, j, c = i[:OPEN_PAIRS], j[:OPEN_PAIRS], c[:OPEN_PAIRS]
        open_ = a_tree[level][i, c] | b_tree[level][j, c]
        width = np.minimum((c + 1) << level, terms) - (c << level)
        np.add.at(empty[level], (i[~open_], j[~open_]), width[~open_])  # priced below, for all pairs of rows
        i, j, c = i[open_], j[open_], c[open_]
        if not level:
            np.add.at(sums, (i, j), distance(left[i, c], right[j, c]))
        elif len(i):
            i, j, c = ((2 * x[:, None] + half[:, k]).ravel() for k, x in enumerate((i, j, c)))
            (rows, cols), others = a_tree[level - 1].shape, len(b_tree[level - 1])
            ok = (i < rows) & (j < others) & (c < cols)
            if same:
                ok &= (i < j) if level == 1 else (i <= j)
            stack.append((level - 1, i[ok], j[ok], c[ok]))
    i, j = np.arange(len(left))[:, None], np.arange(len(right))[None]
    zeros = sum(e[i >> level, j >> level] for level, e in enumerate(empty))
    return sums + zeros * distance(left_zero[:, None], right_zero[None])


def _block_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """(a, b, value, terms) of one column block and two row blocks from rows (one, two, part, gid, tid, p).

    ``p`` is the share of a count of zero where ``tid`` is -1. ``terms`` are those that a group of the two row blocks has.
    """
    one, two = int(rows["one"].iloc[0]), int(rows["two"].iloc[0])
    zero = rows[rows["tid"] < 0].sort_values("gid")
    cells = rows[rows["tid"] >= 0]
    terms = np.unique(cells["tid"].to_numpy())
    sides = []
    for part in (one, two):
        z = zero[zero["part"] == part]
        ids, base = z["gid"].to_numpy(), z["p"].to_numpy()
        own = cells[cells["part"] == part]
        matrix = np.repeat(base[:, None], len(terms), axis=1)
        matrix[np.searchsorted(ids, own["gid"].to_numpy()), np.searchsorted(terms, own["tid"].to_numpy())] = own["p"].to_numpy()
        sides.append((ids, matrix, base))
    (a, left, a_zero), (b, right, b_zero) = sides
    sums = pair_sums(left, right, a_zero, b_zero, one == two) if left.size and right.size else np.zeros(
        (len(a), len(b)), np.int64)
    i, j = np.triu_indices(len(a), 1) if one == two else (x.ravel() for x in np.indices(sums.shape))
    return pd.DataFrame({"a": a[i], "b": b[j], "value": sums[i, j], "terms": len(terms)})


def divergence(docs: DataFrame, least_docs: int = 10, top_terms: int = 10, term_block: int = TERM_BLOCK,
               group_block: int = GROUP_BLOCK, lang_col: str = "lang", source_col: str = "source",
               text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): distances of the sources of a language, and their telling terms.

    A language keeps the terms in at least ``least_docs`` of its documents. Part
    ``pair``: every other source of the language, the distances of the shares
    of all kept terms summed. Part ``term``: the ``top_terms`` kept terms that
    the group has and whose share is above the language's, by distance to it.
    Null texts, languages and sources are empty ones; a group without terms has
    pairs only, and a language of one source no pairs. Repeated rows count
    each; ids and other columns are not read. An empty table gives an empty
    result.
    """
    counts = materialize(group_terms(docs, lang_col, source_col, text_col), "group-terms")
    kept = counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("d"), F.sum("n").alias("all_n"))
    kept = materialize(kept.filter(F.col("d") >= least_docs).select(
        "lang", "term", "all_n", F.monotonically_increasing_id().alias("tid")), "kept-terms")
    cells = materialize(counts.filter("term IS NOT NULL").select("lang", "source", "term", "n").join(
        kept, ["lang", "term"]), "counts")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("all_n").alias("lang_n"))
    own = cells.groupBy("lang", "source").agg(F.sum("n").alias("own_n"))
    groups = counts.filter("term IS NULL").select("lang", "source").join(langs, "lang", "left").join(
        own, ["lang", "source"], "left").fillna(0, ["v", "lang_n", "own_n"])
    sizes = counts.filter("term IS NULL").groupBy("lang").agg(F.count(F.lit(1)).alias("number"))
    groups = groups.join(sizes, "lang")
    parts = F.greatest(F.ceil(F.col("number") / F.lit(group_block)), F.lit(1))
    groups = materialize(groups.select(
        "lang", "source", "v", (F.col("own_n") + 2 * F.col("v")).alias("own_d"),
        (F.col("lang_n") + 2 * F.col("v")).alias("lang_d"), F.monotonically_increasing_id().alias("gid"),
        parts.cast("int").alias("parts"), F.pmod(F.xxhash64("source"), parts).cast("int").alias("part"),
        F.ceil(F.col("v") / F.lit(term_block)).cast("int").alias("blocks")), "groups")
    priced = materialize(cells.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "tid", "gid", "part", "parts", share(F.col("n") + 2, F.col("own_d")).alias("p"),
        share(F.col("all_n") + 2, F.col("lang_d")).alias("q"),
        F.pmod(F.xxhash64("tid"), "blocks").cast("int").alias("block")), "shares")

    p, q = F.col("p"), F.col("q")
    far = F.call_function("div", (p - q) * (p - q), p + q)
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = priced.filter(p > q).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                        far.alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top_terms)

    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    zero = share(F.lit(2).cast("bigint"), F.col("own_d"))
    busy = groups.filter("v > 0")
    bases = busy.select(
        "lang", "gid", "part", "parts", F.lit(-1).cast("bigint").alias("tid"), zero.alias("p"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    dealt = bases.unionByName(priced.select("lang", "gid", "part", "parts", "tid", "p", "block")).select(
        "lang", "block", "gid", "part", "tid", "p", other)
    dealt = dealt.select("lang", "block", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"),
                         "gid", "part", "tid", "p")
    sums = dealt.groupBy("lang", "block", "one", "two").applyInPandas(
        _block_sums, "a bigint, b bigint, value bigint, terms bigint")
    sums = sums.groupBy("a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))
    sums = materialize(sums.union(sums.select("b", "a", "value", "terms")), "pair-sums")
    a = busy.select("lang", "source", "v", F.col("gid").alias("a"), zero.alias("p"))
    b = busy.select(F.col("source").alias("item"), F.col("gid").alias("b"), zero.alias("q"))
    neither = (F.col("v") - F.col("terms")) * far  # the kept terms that no group of their row blocks has
    pairs = sums.join(a, "a").join(b, "b").select(
        "lang", "source", "item", (F.col("value") + neither).alias("value"))
    bare = groups.filter("v = 0").select("lang", "source")  # languages without kept terms
    pairs = pairs.unionByName(bare.join(bare.withColumnRenamed("source", "item"), "lang").filter("source <> item").select(
        "lang", "source", "item", F.lit(0).cast("bigint").alias("value")))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn(
        "rank", F.row_number().over(best))
    return pairs.unionByName(terms)


def op12_divergence(spark, sf_dir: str) -> DataFrame:
    """Sources of ``documents`` against each other and against their language."""
    from wordloom.llm.common import read_table

    return divergence(read_table(spark, sf_dir, "documents"))
