"""V3: similarity join of a vector table: for each vector its linked component and its number of links. V2: an index by pivots.

Equal vectors are one entry with a count, so copies are never paired.

``pivots`` is exact. A few far-apart vectors are the pivots. Entries are ordered
by their nearest pivot and the distance to it and cut into blocks, of a bounded
number of bytes. A block knows the least and greatest distance of its entries to
every pivot: by the triangle inequality two blocks cannot be linked, nor an entry
to a block, when these are farther apart than the radius. All other pairs of
blocks are compared, each once, by products of matrices. Where the pivots tell
nothing, as among random directions, that is every pair: time grows with the
square of the entries, memory does not grow, and a block travels once to each
block it is compared with.

``buckets`` hashes by the signs of random projections, in several tables, and
also visits the buckets reached by flipping the signs that were closest to zero.
It is for angles and misses some links (the tests state the recall). An entry is
at *home* under one key per table and *visits* the keys where a near one can be
at home; a key with many entries is cut into pairs of blocks.

All that meets is checked by its exact distance. A task returns one row per entry it has linked (how many, and one neighbour that
stands for its group), never the pairs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.operators.encode import checked_size
from wordloom.operators.graph import local_components, smallest_reachable
from wordloom.session import ensure_checkpoint_dir, stored

#: Entries that a block holds, and those of them that are compared at once.
BLOCK_ROWS, AT_ONCE = 2048, 256
#: Bytes of the vectors of a block that is compared with other blocks, its least entries, and blocks that there are at least.
BLOCK_BYTES, LEAST_ROWS, LEAST_BLOCKS = 8 << 20, 1024, 16
#: Pivots, and the entries (a bounded sample) that they are chosen from.
PIVOTS, PIVOT_SAMPLE = 24, 512

_KEYS = "struct<home:array<struct<t:int,k:bigint>>,visits:array<struct<t:int,k:bigint>>>"


def _matrix(column) -> np.ndarray:
    return np.array([np.asarray(x, np.float64) for x in column]) if len(column) else np.empty((0, 0))


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(rows of x, rows of y), row by row to bound the memory."""
    return np.sqrt(np.array([((y - r) ** 2).sum(axis=1) for r in x]).reshape(len(x), len(y)))


def choose_pivots(entries: DataFrame, count: int = PIVOTS) -> np.ndarray:
    """Far-apart vectors of a bounded sample: each is the one farthest from those before it."""
    rows = entries.orderBy(F.xxhash64("node"), "node").limit(PIVOT_SAMPLE).select("x").collect()
    x = _matrix([r.x for r in rows])
    if not len(x):
        return x
    chosen, far = [0], _distances(x[:1], x)[0]
    while len(chosen) < min(count, len(x)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _distances(x[chosen[-1:]], x)[0])
    return x[chosen]


def _packed(entries: DataFrame, pivots: np.ndarray, block_rows: int, count: int) -> DataFrame:
    """Entries in blocks near each other: (block, node, copies, x, far, low, high), numbers as bytes; ``far`` to every pivot."""
    @F.pandas_udf("struct<cell:int,near:double>")
    def home(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for x in batches:
            d = _distances(_matrix(x), pivots) if len(x) else np.zeros((0, 1))
            yield pd.DataFrame({"cell": d.argmin(axis=1), "near": d.min(axis=1)})

    placed = stored(entries.select("node", "copies", "x", home("x").alias("h")), "join-homes")
    cut = stored(placed.repartitionByRange(max(1, -(-count // block_rows)), "h.cell", "h.near", "node").select(
        F.spark_partition_id().alias("block"), "node", "copies", "x"), "join-blocks")

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(rows["x"])
        far = _distances(x, pivots)
        return pd.DataFrame({
            "block": rows["block"].iloc[:1], "node": [rows["node"].to_numpy(np.int64).tobytes()],
            "copies": [rows["copies"].to_numpy(np.int64).tobytes()], "x": [x.tobytes()], "far": [far.tobytes()],
            "low": [far.min(axis=0)], "high": [far.max(axis=0)]})

    return stored(cut.groupBy("block").applyInPandas(
        pack, "block int, node binary, copies binary, x binary, far binary, low array<double>, high array<double>"), "packed-blocks")


def _pair_links(radius: float):
    """Links between the entries of two blocks, or of one block: (node, links, root)."""
    slack = 1e-9 * (1 + radius)  # distances are rounded: a bound that is only just met counts as met

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sides = []
        for r in rows.itertuples():
            node = np.frombuffer(r.node, np.int64)
            sides.append((node, np.frombuffer(r.copies, np.int64), np.frombuffer(r.x).reshape(len(node), -1),
                          np.frombuffer(r.far).reshape(len(node), -1), np.asarray(r.low), np.asarray(r.high)))
        one = len(sides) == 1
        (a_node, a_copies, a, a_far, a_low, a_high), (b_node, b_copies, b, b_far, b_low, b_high) = sides[0], sides[-1]
        # entries that no pivot keeps away from the other block
        some_a = np.flatnonzero(~((a_far > b_high + radius + slack) | (a_far < b_low - radius - slack)).any(axis=1))
        some_b = np.flatnonzero(~((b_far > a_high + radius + slack) | (b_far < a_low - radius - slack)).any(axis=1))
        nodes = a_node if one else np.concatenate((a_node, b_node))
        shift = 0 if one else len(a_node)
        parent, links = np.arange(len(nodes)), np.zeros(len(nodes), np.int64)
        a2, b2 = (a**2).sum(axis=1) * (1 - 1e-9), (b**2).sum(axis=1) * (1 - 1e-9)
        wide = np.column_stack((-2 * b, np.ones(len(b)), b2))[some_b].T
        for first in range(0, len(some_a), AT_ONCE):
            at = some_a[first : first + AT_ONCE]
            tall = np.column_stack((a[at], a2[at], np.ones(len(at))))
            for start in range(0, len(some_b), BLOCK_ROWS):
                rough = tall @ wide[:, start : start + BLOCK_ROWS]  # within the rounding, before the exact distance
                i, j = np.divmod(np.flatnonzero(rough <= radius * radius + 1e-9), rough.shape[1])
                for cut in range(0, len(i), 1 << 14):
                    p, q = at[i[cut : cut + (1 << 14)]], some_b[start + j[cut : cut + (1 << 14)]]
                    near = ((a[p] - b[q]) ** 2).sum(axis=1) <= radius * radius
                    near &= a_node[p] != b_node[q]
                    p, q = p[near], q[near]
                    np.add.at(links, p, b_copies[q])
                    if not one:
                        np.add.at(links, shift + q, a_copies[p])
                    parent = local_components(parent, p, shift + q)
        told = np.flatnonzero((links > 0) | (parent != np.arange(len(nodes))))
        return pd.DataFrame({"node": nodes[told], "links": links[told], "root": nodes[parent[told]]})

    return run


def _linked_blocks(entries: DataFrame, radius: float, block_rows: int | None) -> DataFrame:
    """Links of the entries by pairs of blocks: (node, links, root), a row for each pair of blocks that an entry has links in."""
    sizes = entries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("dim")).first()
    if block_rows is None:
        block_rows = max(1, min(BLOCK_BYTES // (8 * (sizes["dim"] or 1)), max(LEAST_ROWS, sizes["n"] // LEAST_BLOCKS)))
    packed = _packed(entries, choose_pivots(entries), block_rows, sizes["n"])
    a, b = (packed.select(F.col("block").alias(c), F.col("low").alias(f"{c}_low"), F.col("high").alias(f"{c}_high")) for c in "ij")
    reach = F.lit(radius + 1e-9 * (1 + radius))
    apart = F.exists(F.zip_with("i_low", "j_high", lambda x, y: x > y + reach), lambda x: x) | F.exists(
        F.zip_with("j_low", "i_high", lambda x, y: x > y + reach), lambda x: x)
    pairs = stored(a.crossJoin(b).where(F.col("i") <= F.col("j")).where(~apart).select("i", "j"), "block-pairs")
    sides = pairs.withColumn("block", F.explode(F.array_distinct(F.array("i", "j"))))
    parts = max(1, min(pairs.count(), 8 * entries.sparkSession.sparkContext.defaultParallelism))
    return sides.join(packed, "block").repartition(parts, "i", "j").groupBy("i", "j").applyInPandas(
        _pair_links(radius), "node bigint, links bigint, root bigint")


def sign_planes(dim: int, tables: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(tables, bits, dim))


def sign_keys(x: np.ndarray, planes: np.ndarray, probes: int) -> list[tuple[list, list]]:
    """For each row its bucket in every table, and the buckets it visits: its own and ``probes`` more by least margin."""
    tables, bits, _ = planes.shape
    out: list[tuple[list, list]] = [([], []) for _ in x]
    weight = 1 << np.arange(bits, dtype=np.int64)
    for t in range(tables):
        side = x @ planes[t].T
        key = ((side > 0) * weight).sum(axis=1)
        flips = np.argsort(np.abs(side), axis=1)[:, : min(probes, bits)]
        for r in range(len(x)):
            out[r][0].append((t, int(key[r])))
            out[r][1].append((t, int(key[r])))
            out[r][1].extend((t, int(key[r] ^ weight[b])) for b in flips[r])
    return out


def _keyed(entries: DataFrame, keys) -> DataFrame:
    @F.pandas_udf(_KEYS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = keys(_matrix(rows)) if len(rows) else []
            yield pd.DataFrame({"home": [[{"t": t, "k": k} for t, k in h] for h, _ in found],
                                "visits": [[{"t": t, "k": k} for t, k in v] for _, v in found]})

    return entries.withColumn("keys", run("x"))


def _dealt(keyed: DataFrame, block_rows: int) -> DataFrame:
    """One row per entry, key and pair of blocks it is needed in: (t, k, i, j, visit, node, copies, x, home, visits)."""
    rest = [F.col("node"), F.col("copies"), F.col("x"), F.col("keys.home").alias("home"), F.col("keys.visits").alias("visits")]
    own = keyed.select(F.explode("keys.home").alias("key"), *rest).select("key.*", *[c for c in ("node", "copies", "x", "home", "visits")])
    guests = keyed.select(F.explode("keys.visits").alias("key"), *rest).select("key.*", *[c for c in ("node", "copies", "x", "home", "visits")])
    sizes = own.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).join(
        guests.groupBy("t", "k").agg(F.count(F.lit(1)).alias("m")), ["t", "k"])
    sizes = stored(sizes.select("t", "k", F.ceil(F.col("n") / block_rows).cast("int").alias("n"),
                                F.ceil(F.col("m") / block_rows).cast("int").alias("m")), "key-blocks")

    def blocks(rows, mine, other, visit):
        block = F.pmod(F.xxhash64("node"), F.col(mine)).cast("int").alias("b")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("o")
        cut = rows.join(sizes, ["t", "k"]).select("t", "k", "node", "copies", "x", "home", "visits", block, every)
        i, j = ("o", "b") if visit else ("b", "o")
        return cut.select("t", "k", F.col(i).alias("i"), F.col(j).alias("j"), F.lit(visit).alias("visit"), "node",
                          "copies", "x", "home", "visits")

    return blocks(own, "n", "m", False).unionByName(blocks(guests, "m", "n", True))


def _earlier(visits, home, t: int) -> bool:
    """Whether a visitor meets the other entry under a table before ``t``."""
    seen = {(v["t"], v["k"]) for v in visits}
    return any(h["t"] < t and (h["t"], h["k"]) in seen for h in home)


def _block_links(radius: float):
    """Links of the visitors to those at home in one pair of blocks: (node, links, root)."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        visit = rows["visit"].to_numpy()
        home, guests = rows[~visit], rows[visit]
        none = pd.DataFrame({"node": [], "links": [], "root": []}).astype("int64")
        if not len(home) or not len(guests):
            return none
        t = int(rows["t"].iloc[0])
        h, g = _matrix(home["x"]), _matrix(guests["x"])
        copies, h_node, g_node = home["copies"].to_numpy(), home["node"].to_numpy(), guests["node"].to_numpy()
        nodes, place = np.unique(np.concatenate((h_node, g_node)), return_inverse=True)
        h_at, g_at = place[: len(h)], place[len(h) :]
        parent, links = np.arange(len(nodes)), np.zeros(len(nodes), np.int64)
        h2 = (h**2).sum(axis=1)
        for first in range(0, len(g), AT_ONCE):
            part = g[first : first + AT_ONCE]
            p2 = (part**2).sum(axis=1)
            rough = p2[:, None] + h2[None] - 2 * part @ h.T  # within the rounding, before the exact distance
            a, b = np.nonzero(rough <= radius * radius + 1e-9 * (1 + p2[:, None] + h2[None]))
            apart = g_node[first + a] != h_node[b]
            a, b = a[apart], b[apart]
            for cut in range(0, len(a), 1 << 16):
                i, j = a[cut : cut + (1 << 16)], b[cut : cut + (1 << 16)]
                near = ((part[i] - h[j]) ** 2).sum(axis=1) <= radius * radius
                i, j = first + i[near], j[near]
                if t:
                    new = np.array([not _earlier(guests["visits"].iloc[x], home["home"].iloc[y], t)
                                    for x, y in zip(i, j, strict=True)], bool)
                    i, j = i[new], j[new]
                np.add.at(links, g_at[i], copies[j])
                parent = local_components(parent, g_at[i], h_at[j])
        told = np.flatnonzero((links > 0) | (parent != np.arange(len(nodes))))
        return pd.DataFrame({"node": nodes[told], "links": links[told], "root": nodes[parent[told]]})

    return run


def similarity_join(vectors: DataFrame, radius: float, metric: str = "distance", method: str = "pivots", tables: int = 16,
                    bits: int = 10, probes: int = 3, seed: int = 1, block_rows: int | None = None) -> DataFrame:
    """V3: ``(vec_id, component_id, n_links)`` of ``vectors(vec_id, embedding)``, one row per row.

    Two rows are linked if their distance (``metric='angle'``: their angle) is at
    most ``radius``; ``component_id`` is the least vec_id reachable over links,
    ``n_links`` the number of rows linked to this one (with ``buckets`` those
    that its own visits meet). Vectors have one length. Null vectors and, for
    angles, zero vectors have no links. Ids are unique.
    """
    if metric not in ("distance", "angle") or method not in ("pivots", "buckets") or radius < 0:
        raise ValueError("metric: distance or angle; method: pivots or buckets; radius: at least 0")
    if method == "buckets" and metric != "angle":
        raise ValueError("buckets are for angles")
    x = F.transform("embedding", lambda v: v.cast("double"))
    if metric == "angle":
        size = F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v))
        x = F.when(size > 0, F.transform(x, lambda v: v / size))
        radius = 2 * np.sin(min(radius, np.pi) / 2)  # the chord of unit vectors
    rows = stored(vectors.select("vec_id", x.alias("x")), "join-vectors")
    entries = stored(rows.where("x IS NOT NULL").groupBy("x").agg(F.count(F.lit(1)).alias("copies")).withColumn(
        "node", F.monotonically_increasing_id()), "join-entries")
    if method == "pivots":
        found = _linked_blocks(entries, float(radius), block_rows)
    else:
        dim = entries.select(F.max(F.size("x"))).first()[0] or 1
        planes = sign_planes(dim, tables, bits, seed)
        keyed = stored(_keyed(entries, lambda m: sign_keys(m, planes, probes)), "join-keys")
        found = _dealt(keyed, block_rows or BLOCK_ROWS).groupBy("t", "k", "i", "j").applyInPandas(
            _block_links(float(radius)), "node bigint, links bigint, root bigint")
    found = stored(found, "links")
    ends = smallest_reachable(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    ends = stored(ends.withColumnRenamed("root", "component"), "components")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    state = entries.join(counts, "node", "left").join(ends, "node", "left").select(
        "x", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component"))
    state = stored(state, "join-state")
    placed = stored(rows.join(state, "x", "left").select("vec_id", "component", "n_links"), "placed")
    least = stored(placed.where("component IS NOT NULL").groupBy("component").agg(
        F.min("vec_id").alias("component_id")), "least-ids")
    return placed.join(least, "component", "left").select(
        "vec_id", F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


class PivotIndex:
    """V2: vectors stored by their nearest pivot's cell, with the cells' least and greatest distance to it.

    The triangle inequality bounds the distance of a query to a whole cell from
    below, and to each row of it by the row's stored distance to its pivot, so
    ``nearest`` reads the cells that can hold an answer and no others.
    """

    def __init__(self, vectors: DataFrame, pivots: int = PIVOTS):
        spark = vectors.sparkSession
        rows = stored(vectors.where("embedding IS NOT NULL").select(
            F.col("vec_id").alias("node"), F.transform("embedding", lambda v: v.cast("double")).alias("x")), "index-vectors")
        self.pivots = choose_pivots(rows, pivots)
        centers = self.pivots

        @F.pandas_udf("struct<cell:int,far:double>")
        def home(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for x in batches:
                d = _distances(_matrix(x), centers) if len(x) else np.zeros((0, 1))
                yield pd.DataFrame({"cell": d.argmin(axis=1), "far": d.min(axis=1)})

        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pivot-index-{uuid.uuid4().hex}"
        placed = rows.select("node", "x", home("x").alias("h")).select("node", "x", "h.*")
        placed.write.partitionBy("cell").parquet(path)
        self.rows = spark.read.schema("node bigint, x array<double>, far double, cell int").parquet(path)
        stats = self.rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("far").alias("low"), F.max("far").alias("high"))
        self.cells = {r.cell: (r.n, r.low, r.high) for r in stats.collect()}  # one row per pivot
        self.read: list[int] = []  # cells that the last search has read

    def _scan(self, wanted: dict[int, dict[int, float]], queries: np.ndarray, k: int) -> list:
        """(query, distance, node): the ``k`` nearest of each query in the cells ``wanted`` = {cell: {query: bound}}."""
        if not wanted:
            return []
        pivots = self.pivots

        def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for rows in batches:
                for cell, part in rows.groupby("cell"):
                    x, far, node = _matrix(part["x"]), part["far"].to_numpy(), part["node"].to_numpy()
                    for q, bound in wanted[cell].items():
                        off = np.sqrt(((queries[q] - pivots[cell]) ** 2).sum())
                        some = np.flatnonzero(np.abs(far - off) <= bound + 1e-9 * (1 + off))
                        d = ((x[some] - queries[q]) ** 2).sum(axis=1)
                        old = best.get(q, (np.empty(0), np.empty(0, np.int64)))
                        d, i = np.concatenate((old[0], d)), np.concatenate((old[1], node[some]))
                        order = np.lexsort((i, d))[:k]
                        best[q] = d[order], i[order]
            yield pd.DataFrame([(q, float(d), int(i)) for q, b in best.items() for d, i in zip(*b, strict=True)],
                               columns=["q", "d2", "node"])

        found = self.rows.where(F.col("cell").isin(list(wanted))).mapInPandas(nearest, "q int, d2 double, node bigint")
        w = Window.partitionBy("q").orderBy("d2", "node")
        rows = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        return [(r.q, r.d2, r.node) for r in rows.collect()]  # k rows per query of a stated set

    def nearest(self, queries: DataFrame, k: int) -> DataFrame:
        """``(q_id, rank, vec_id, sim)``: the k nearest rows of every query of a stated set ``(q_id, q_vec)``, exact.

        ``sim`` is the negative squared distance; ties go to the lower vec_id.
        """
        spark = queries.sparkSession
        names = [(r.q_id, r.q_vec) for r in queries.select("q_id", "q_vec").collect()]
        checked_size(sum(8 * len(v) + 64 * (k + 1) for _, v in names), "queries and their answers")
        kind = f"q_id {queries.schema['q_id'].dataType.simpleString()}, rank int, vec_id bigint, sim double"
        self.read = []
        if not names or not self.cells:
            return spark.createDataFrame([], kind)
        x = _matrix([v for _, v in names])
        off = _distances(x, self.pivots)
        low = {q: {c: max(0.0, off[q, c] - high, least - off[q, c]) for c, (_, least, high) in self.cells.items()}
               for q in range(len(x))}
        first: dict[int, dict[int, float]] = {}
        for q, bounds in low.items():
            seen = 0
            for c in sorted(bounds, key=lambda c: (bounds[c], off[q, c])):
                first.setdefault(c, {})[q] = np.inf
                seen += self.cells[c][0]
                if seen >= k:
                    break
        found = self._scan(first, x, k)
        limit = {q: np.inf for q in low}
        for q in low:
            d = sorted(d for p, d, _ in found if p == q)
            if len(d) >= k:
                limit[q] = float(np.sqrt(d[k - 1]))
        more: dict[int, dict[int, float]] = {}
        for q, bounds in low.items():
            for c, least in bounds.items():
                if q not in first.get(c, {}) and least <= limit[q] + 1e-9 * (1 + limit[q]):
                    more.setdefault(c, {})[q] = limit[q]
        found += self._scan(more, x, k)
        self.read = sorted({*first, *more})
        out = []
        for q in low:
            best = sorted((d, i) for p, d, i in found if p == q)[:k]
            out += [(names[q][0], rank + 1, i, -d) for rank, (d, i) in enumerate(best)]
        return spark.createDataFrame(out, kind)
