"""Connected components: over a table of edges, and over the pairs that one task has found."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.session import stored


def local_components(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``parent`` (roots only) after joining a[i] and b[i]; the smallest index of a group is its root."""
    while len(a):
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        if not len(a):
            break
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent


def smallest_reachable(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: (node, root), root the smallest node reachable.

    Alternates the large-star and small-star steps; every step is one minimum
    per node (combined before the shuffle) and one join, whose two sides are
    tables, so that a hub's rows can be split. Nodes are longs. Self loops and
    repeated edges are ignored; a node without an edge is not returned.
    """
    def fingerprint(df):
        row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return row["n"], row["h"]

    def ordered(df):
        big, small = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        return df.filter("a <> b").select(big, small).distinct()

    cur = stored(ordered(edges), "edges")
    seen = fingerprint(cur)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = stored(cur.union(cur.select(F.col("b").alias("a"), F.col("a").alias("b"))), "both")
        low = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "low")
        large = ordered(both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = stored(large, "large")
        low = stored(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select("a", F.col("m").alias("b")))
        cur = stored(ordered(small), "edges")
        now = fingerprint(cur)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    roots = cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
