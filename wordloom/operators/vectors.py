"""Table jobs over a vector table ``(vec_id, embedding ARRAY<FLOAT>, label)``.

Small per-vector maths (norms, clamps, sub-vectors) runs inside the row with
higher-order functions; anything across rows is a grouped aggregation on
``(group, component)`` cells, or per-partition sums in numpy where the cells
would be many times the input. Tables of one row per component are as long as a
vector is wide, and only those are collected; centroids and queries are sent to
the tasks after a check of their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions import vecmath as V
from wordloom.operators.encode import MODEL_BYTES
from wordloom.session import numbered, stored


#: Bins of a histogram of values.
BINS = 1024


def _histograms(counts: DataFrame, ranges: DataFrame, spread: bool) -> DataFrame:
    """(g, lo, hi, low, high, least, c): the bins of every range of ``ranges(g, lo, hi)`` that hold values.

    ``low`` and ``high`` are the least and greatest value of a bin, ``c`` its
    occurrences. ``spread``: bins of equal ratio above ``lo`` instead of equal width.
    """
    share = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
    share = F.log1p(share * F.lit(2.0**40)) / F.log1p(F.lit(2.0**40)) if spread else share
    inside = counts.join(ranges, counts["g"].eqNullSafe(ranges["of"])).where("lo <= v AND v <= hi")
    bins = inside.withColumn("bin", F.least(F.floor(share * BINS).cast("int"), F.lit(BINS - 1)))
    return bins.groupBy("g", "lo", "hi", "bin").agg(
        F.min("v").alias("low"), F.max("v").alias("high"), F.sum("n").alias("c"))


def group_quantiles(values: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles of ``values(g, v)``: ``(g, n, *names)``, whatever the size of a group.

    Occurrences are counted per (g, v), so equal values are one row. Every rank
    that is wanted lies in a range of values, at first the group's; a histogram
    of the range tells the bin it lies in, which is the next range, until it is
    one value. Histograms are sums that combine inside the tasks; nothing is
    sorted but the bins of a range. Null values are left out; the others are finite.
    """
    counts = stored(values.where("v IS NOT NULL").groupBy("g", "v").agg(F.count(F.lit(1)).alias("n")), "value-counts")
    groups = stored(counts.groupBy("g").agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")), "groups")
    place = {name: F.lit(float(q)) * (F.col("n") - 1) for name, q in shares.items()}
    ranks = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), e(p).cast("bigint").alias("k"), w(p).alias("w"))
                                for name, p in place.items() for e, w in (
        (F.floor, lambda p: 1 - (p - F.floor(p))), (lambda p: F.floor(p) + 1, lambda p: p - F.floor(p)))]))
    wanted = groups.select("g", "n", "lo", "hi", ranks.alias("s")).select("g", "n", "lo", "hi", "s.*").where("w > 0")
    wanted = stored(wanted.withColumn("before", F.lit(0).cast("bigint")), "ranks")
    done = wanted.where("lo = hi")
    turn = 0
    while not (rest := wanted.where("lo < hi")).isEmpty():
        ranges = rest.select(F.col("g").alias("of"), "lo", "hi").distinct()
        bins = _histograms(counts, ranges, turn % 3 == 2)  # values of many magnitudes would fall into one bin again and again
        run = Window.partitionBy("g", "lo", "hi").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        bins = bins.select(F.col("g").alias("of"), F.col("lo").alias("from"), F.col("hi").alias("to"), "low", "high", "c",
                           (F.sum("c").over(run) - F.col("c")).alias("under"))
        same = rest["g"].eqNullSafe(bins["of"]) & (rest["lo"] == bins["from"]) & (rest["hi"] == bins["to"])
        rank = F.col("k") - F.col("before")
        rest = rest.join(bins, same).where((F.col("under") <= rank) & (rank < F.col("under") + F.col("c"))).select(
            "g", "n", F.col("low").alias("lo"), F.col("high").alias("hi"), "name", "k", "w",
            (F.col("before") + F.col("under")).alias("before"))
        wanted = stored(rest, "ranks")
        done = done.unionByName(wanted.where("lo = hi"))
        turn += 1
    return done.groupBy("g", "n").agg(*[
        F.sum(F.when(F.col("name") == name, F.col("w") * F.col("lo"))).alias(name) for name in shares])


def _sent(rows: list) -> np.ndarray:
    """The vectors of collected rows as a matrix."""
    return np.array([list(r) for r in rows], np.float64).reshape(len(rows), -1)


#: Bytes of the differences of rows and queries that are held at once.
BLOCK_BYTES = 1 << 26


def _blocks(embeddings: pd.Series, queries: int) -> Iterator[np.ndarray]:
    """Vectors as matrices of so many rows that their differences to all queries stay below ``BLOCK_BYTES``."""
    first = 0
    while first < len(embeddings):
        dim = max(len(embeddings.iloc[first]), 1)
        rows = max(1, BLOCK_BYTES // (8 * dim * max(queries, 1)))
        yield np.array([np.asarray(x, np.float64) for x in embeddings.iloc[first : first + rows]])
        first += rows


def _checked_rows(df: DataFrame, vector: str, what: str) -> list:
    """The rows of a small table of vectors, after a check of its bytes."""
    size = df.agg(F.sum(8 * F.size(vector) + 64)).first()[0] or 0
    if size > MODEL_BYTES:
        raise OverflowError(f"{what}: {size} bytes are above MODEL_BYTES={MODEL_BYTES}")
    return df.collect()


def cells(vectors: DataFrame, key: str = "vec_id", col: str = "embedding", extra=("label",)) -> DataFrame:
    """Vectors as coordinate cells ``(key, extra..., i, v)``; i is 0-based."""
    return vectors.select(key, *extra, F.posexplode(col).alias("i", "v")).withColumn("v", F.col("v").cast("double"))


def assemble(cells_df: DataFrame, keys, value: str, name: str) -> DataFrame:
    """Cells back to one array per key (components in order; the group is one vector)."""
    return cells_df.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", value))), lambda e: e[value]).alias(name)
    )


def vector_norms(vectors: DataFrame) -> DataFrame:
    """V1: norm and zero-safe unit vector per row."""
    return vectors.select("vec_id", "label", V.norm("embedding").alias("norm"), V.unit("embedding").alias("unit"))


def norm_quantiles(vectors: DataFrame) -> DataFrame:
    """V1: norm quartiles per label, exact and interpolated."""
    norms = vectors.select(F.col("label").alias("g"), V.norm("embedding").alias("v"))
    return group_quantiles(norms, {"q1": 0.25, "median": 0.5, "q3": 0.75}).withColumnRenamed("g", "label")


def centroids(vectors: DataFrame) -> DataFrame:
    """V4: mean vector per label as cells ``(label, i, c)``."""
    return cells(vectors).groupBy("label", "i").agg(F.avg("v").alias("c"))


def centroid_vectors(vectors: DataFrame) -> DataFrame:
    return assemble(centroids(vectors), ["label"], "c", "centroid")


def assign_nearest(vectors: DataFrame) -> DataFrame:
    """V5: nearest centroid per vector (least label wins a tie), scored in Arrow batches."""
    rows = sorted(_checked_rows(centroid_vectors(vectors), "centroid", "centroids"), key=lambda r: r.label)
    sent = vectors.sparkSession.sparkContext.broadcast((_sent([r.centroid for r in rows]),
                                                        [r.label for r in rows]))
    label_type = vectors.schema["label"].dataType.simpleString()

    @F.pandas_udf(f"struct<nearest:{label_type},dist:double>")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        centers, labels = sent.value
        for embeddings in batches:
            best, dist = [], []
            for x in _blocks(embeddings, len(centers)):
                d2 = ((x[:, None, :] - centers[None]) ** 2).sum(axis=2)
                best.append(d2.argmin(axis=1))
                dist.append(np.sqrt(d2.min(axis=1)))
            best = np.concatenate(best) if best else []
            yield pd.DataFrame({"nearest": [labels[k] for k in best], "dist": np.concatenate(dist) if dist else []})

    return vectors.select("vec_id", "label", nearest("embedding").alias("a")).select("vec_id", "label", "a.*")


def cluster_summary(assigned: DataFrame) -> DataFrame:
    """V5: count and mean distance per assigned centroid."""
    return assigned.groupBy("nearest").agg(
        F.count(F.lit(1)).alias("n"), F.avg("dist").alias("mean_dist"),
        F.sum(F.when(F.col("nearest") == F.col("label"), 1).otherwise(0)).alias("same_label"),
    )


def vector_profile(vectors: DataFrame) -> DataFrame:
    """V6: per-vector summary: min, max, first argmin/argmax (0-based), sum, product, any/all."""
    e = F.transform("embedding", lambda x: x.cast("double"))
    mn, mx = F.array_min(e), F.array_max(e)
    return vectors.select(
        "vec_id", "label",
        mn.alias("vmin"), mx.alias("vmax"),
        (F.array_position(e, mn) - 1).alias("argmin"), (F.array_position(e, mx) - 1).alias("argmax"),
        F.aggregate(e, F.lit(0.0), lambda s, x: s + x).alias("vsum"),
        F.aggregate(e, F.lit(1.0), lambda s, x: s * x).alias("vprod"),
        F.exists(e, lambda x: x > 0).alias("any_pos"),
        F.forall(e, lambda x: x > 0).alias("all_pos"),
    )


def component_stats(vectors: DataFrame) -> DataFrame:
    """Column mean and population deviation per component ``(i, mean, sd)``."""
    rows = vectors.select(F.posexplode("embedding").alias("i", "v")).select("i", F.col("v").cast("double").alias("v"))
    return rows.groupBy("i").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("sd"))


def _component_arrays(stats: DataFrame, cols):
    rows = sorted(stats.collect(), key=lambda r: r.i)  # one row per component of a vector
    return [F.array(*[F.lit(float(getattr(r, c)) if getattr(r, c) is not None else 0.0) for r in rows]) for c in cols]


def standardize(vectors: DataFrame) -> DataFrame:
    """V7: (x - column mean) / column deviation; a zero deviation gives 0."""
    mean, sd = _component_arrays(component_stats(vectors), ["mean", "sd"])
    z = F.transform(
        "embedding",
        lambda x, i: F.when(sd[i] > 0, (x.cast("double") - mean[i]) / sd[i]).otherwise(F.lit(0.0)),
    )
    return vectors.select("vec_id", "label", z.alias("z"))


def group_pool(vectors: DataFrame) -> DataFrame:
    """V8: element-wise max and min pooling per label as cells ``(label, i, vmax, vmin)``."""
    return cells(vectors).groupBy("label", "i").agg(F.max("v").alias("vmax"), F.min("v").alias("vmin"))


def winsorize(vectors: DataFrame, lower: float = 0.05, upper: float = 0.95):
    """V9: clamp each component to its column quantiles.

    Returns (clipped vectors, per-component report ``(i, lo, hi, n_low, n_high)``).
    """
    c = cells(vectors)
    q = group_quantiles(c.select(F.col("i").alias("g"), "v"), {"lo": lower, "hi": upper}).select(
        F.col("g").alias("i"), "lo", "hi")
    q = stored(q, "column-quantiles")
    lo, hi = _component_arrays(q, ["lo", "hi"])
    clipped = vectors.select(
        "vec_id", "label",
        F.transform("embedding", lambda x, i: F.least(F.greatest(x.cast("double"), lo[i]), hi[i])).alias("clipped"),
    )
    report = c.join(q, "i").groupBy("i", "lo", "hi").agg(
        F.sum(F.when(F.col("v") < F.col("lo"), 1).otherwise(0)).cast("bigint").alias("n_low"),
        F.sum(F.when(F.col("v") > F.col("hi"), 1).otherwise(0)).cast("bigint").alias("n_high"),
    )
    return clipped, report


def blend_to_centroid(vectors: DataFrame, t: float = 0.5) -> DataFrame:
    """Move each vector a fraction t toward its label's centroid (lerp)."""
    j = vectors.join(stored(centroid_vectors(vectors), "centroids"), "label")
    return j.select(
        "vec_id", "label",
        F.zip_with("embedding", "centroid", lambda x, c: x.cast("double") + F.lit(t) * (c - x.cast("double"))).alias(
            "blended"
        ),
    )


def vector_dedup(vectors: DataFrame) -> DataFrame:
    """Exact duplicate vectors: ``(first_id, copies)`` for groups of 2 or more.

    Grouping on the array shuffles by its hash; partial counts merge copies map-side.
    """
    return (
        vectors.groupBy("embedding")
        .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
        .select("first_id", "copies")
    )


def lexicographic_order(vectors: DataFrame) -> DataFrame:
    """``(vec_id, place)``: the vectors numbered in lexicographic order, ties by id."""
    rows = vectors.select(F.struct("embedding", "vec_id").alias("o"))
    return numbered(rows, "o", "place").select(F.col("o.vec_id").alias("vec_id"), F.col("place").cast("bigint").alias("place"))


def label_profile(vectors: DataFrame) -> DataFrame:
    """V6 per label: ``(label, n, vmin, vmax, mean_sum, any_pos, all_pos)`` over its vectors."""
    return vector_profile(vectors).groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.min("vmin").alias("vmin"), F.max("vmax").alias("vmax"),
        F.avg("vsum").alias("mean_sum"), F.bool_or("any_pos").alias("any_pos"), F.bool_and("all_pos").alias("all_pos"))


def truncate_vectors(vectors: DataFrame, d: int) -> DataFrame:
    """The first d components, re-normalized (zero-safe)."""
    sub = F.slice("embedding", 1, d)
    return vectors.select("vec_id", "label", V.unit(sub).alias("truncated"), V.norm(sub).alias("kept_norm"))


def projection_matrix(dim: int, k: int, seed: int) -> list[list[float]]:
    """A k x dim random matrix, entries u - 0.5 (from the same md5 rule, computed here once)."""
    import hashlib

    def u(*parts):
        h = hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()[:13]
        return int(h, 16) / 4503599627370496.0

    return [[u(seed, j, i) - 0.5 for i in range(dim)] for j in range(k)]


def project_vectors(vectors: DataFrame, matrix: list[list[float]]) -> DataFrame:
    """y = M x for every row; M (k x dim) goes to the tasks, rows are multiplied in Arrow batches."""
    sent = vectors.sparkSession.sparkContext.broadcast(np.array(matrix, np.float64))

    @F.pandas_udf("array<double>")
    def product(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = sent.value
        for embeddings in batches:
            y = [row for x in _blocks(embeddings, 1) for row in x @ m.T]
            yield pd.Series(y, dtype=object)

    return vectors.select("vec_id", "label", product("embedding").alias("y"))


@dataclass
class Components:
    mean: list[float]
    matrix: list[list[float]]  # one row per component, for ``project_vectors``
    variance: list[float]
    rounds: int


#: Triangular factors that one task joins.
FACTORS = 64


def _factor(stack: list[np.ndarray]) -> np.ndarray:
    """The triangular factor of matrices on top of each other."""
    return np.linalg.qr(np.concatenate(stack), mode="r")


def _packed(width: int):
    """Vectors as blocks of bytes, which every round reads without taking rows apart again."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for x in _blocks(rows["embedding"], width):
                if len(x):
                    yield pd.DataFrame({"block": [np.ascontiguousarray(x, np.float64).tobytes()]})

    return run


def _iterate(mean: np.ndarray, base: np.ndarray):
    """One pass of a partition: its share of X^T X Q, and the triangular factor of its rows of X Q."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        product, factor = np.zeros(base.shape), np.zeros((0, base.shape[1]))
        for rows in batches:
            for block in rows["block"]:
                x = np.frombuffer(block).reshape(-1, len(mean)) - mean
                y = x @ base
                product += x.T @ y
                factor = _factor([factor, y])
        i, j = (k.ravel() for k in np.indices(product.shape))
        yield pd.DataFrame({"kind": 0, "i": i, "j": j, "v": product.ravel()})
        i, j = (k.ravel() for k in np.indices(factor.shape))
        yield pd.DataFrame({"kind": 1, "i": i, "j": j, "v": factor.ravel()})

    return run


def _joined_factors(rows: pd.DataFrame) -> pd.DataFrame:
    parts = [p.pivot(index="i", columns="j", values="v").to_numpy() for _, p in rows.groupby("part")]
    factor = _factor(parts)
    i, j = (k.ravel() for k in np.indices(factor.shape))
    return pd.DataFrame({"part": int(rows["to"].iloc[0]), "i": i, "j": j, "v": factor.ravel()})


def principal_components(vectors: DataFrame, k: int, seed: int = 1, tolerance: float = 1e-10, max_rounds: int = 200) -> Components:
    """The ``k`` directions of greatest variance, by block power iteration.

    A round multiplies all rows with a block of a few directions Q and the
    result with the rows again (X^T X Q, summed over the partitions), and makes
    it orthonormal. The singular values of X Q come from its triangular factor,
    which is taken per partition and joined in a tree; the rounds end when they
    settle, and the factor's own singular vectors turn Q into the components.
    Signs are such that a component's largest entry is positive.
    """
    vectors = vectors.where("embedding IS NOT NULL").select("embedding")
    mean = np.array([r.mean for r in sorted(component_stats(vectors).collect(), key=lambda r: r.i)])
    dim, n = len(mean), vectors.count()
    if not 0 < k <= dim:
        raise ValueError("k must be between 1 and the length of the vectors")
    if 16 * dim * k > MODEL_BYTES:
        raise OverflowError(f"{k} directions of {dim} are above MODEL_BYTES={MODEL_BYTES}")
    width = min(dim, k + 8)  # a few more directions settle the last ones sooner
    base = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, width)))[0]
    before = np.zeros(k)
    blocks = stored(vectors.mapInPandas(_packed(width), "block binary"), "vector-blocks")
    for turn in range(1, max_rounds + 1):
        passed = blocks.mapInPandas(_iterate(mean, base), "kind int, i int, j int, v double")
        passed = stored(passed.withColumn("part", F.spark_partition_id()), "power-iteration")
        product = np.zeros((dim, width))
        for r in passed.where("kind = 0").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
            product[r.i, r.j] = r.v
        factors = passed.where("kind = 1").select("part", "i", "j", "v")
        while (parts := factors.select("part").distinct().count()) > 1:
            to = F.pmod(F.col("part"), F.lit(-(-parts // FACTORS)))
            factors = stored(factors.withColumn("to", to).groupBy("to").applyInPandas(
                _joined_factors, "part int, i int, j int, v double"), "factors")
        rows = factors.collect()
        factor = np.zeros((max((r.i for r in rows), default=-1) + 1, width))
        for r in rows:
            factor[r.i, r.j] = r.v
        _, values, turned = np.linalg.svd(factor, full_matrices=False)
        values = np.concatenate((values, np.zeros(k)))[:k]
        settled = np.abs(values - before).max() <= tolerance * max(values.max(), 1e-300)
        if settled:
            break
        before, base = values, np.linalg.qr(product)[0]
    turned = np.concatenate((turned, np.eye(width)))[:k]
    matrix = turned @ base.T
    matrix *= np.sign(matrix[np.arange(k), np.abs(matrix).argmax(axis=1)])[:, None]
    return Components(mean.tolist(), matrix.tolist(), (values**2 / max(n, 1)).tolist(), turn)


#: Side of a block of a matrix product, as a power of two: a task holds one block of each factor.
BLOCK_BITS = 10


def _block_product(rows: pd.DataFrame) -> pd.DataFrame:
    """The product of two blocks from rows (second, r, c, v): (i, j, v) of the cells that have a term."""
    second = rows["second"].to_numpy()
    x, y = rows[~second], rows[second]
    outer, i = np.unique(x["r"].to_numpy(), return_inverse=True)
    last, j = np.unique(y["c"].to_numpy(), return_inverse=True)
    inner = np.intersect1d(x["c"].to_numpy(), y["r"].to_numpy())
    left, right = np.zeros((len(outer), len(inner))), np.zeros((len(inner), len(last)))
    has_left, has_right = (np.zeros(m.shape, np.float32) for m in (left, right))
    for m, has, at, k, v in ((left, has_left, i, x["c"], x["v"]), (right.T, has_right.T, j, y["r"], y["v"])):
        place = np.minimum(np.searchsorted(inner, k), max(len(inner) - 1, 0))
        met = inner[place] == k.to_numpy() if len(inner) else np.zeros(len(k), bool)
        np.add.at(m, (at[met], place[met]), v.to_numpy()[met])
        has[at[met], place[met]] = 1
    a, b = np.nonzero(has_left @ has_right)
    return pd.DataFrame({"i": outer[a], "j": last[b], "v": (left @ right)[a, b]})


def matrix_multiply(a: DataFrame, b: DataFrame) -> DataFrame:
    """Coordinate matrices A(i, j, v) x B(i, j, v) -> C(i, j, v), with integer indices; repeated cells add up.

    Both are cut into square blocks. The lists of blocks that have cells are
    joined on the inner block, which gives the grid of block products (row
    block, inner block, column block) and how often each block is sent; a task
    multiplies one block by one block. C has the cells for which some inner
    index has both factors, as a join of the cells has; their sums over the
    inner blocks are added. A and B may come from the same table.
    """
    def cut(df, second):
        cell = df.select(F.col("i").cast("bigint").alias("r"), F.col("j").cast("bigint").alias("c"),
                         F.col("v").cast("double").alias("v"))
        rb, cb = F.shiftright("r", BLOCK_BITS), F.shiftright("c", BLOCK_BITS)
        return stored(cell.select("r", "c", "v", (cb if second else rb).alias("side"), (rb if second else cb).alias("inner")),
                      "matrix-cells")

    x, y = cut(a, False), cut(b, True)
    grid = stored(x.select(F.col("side").alias("ib"), "inner").distinct().join(
        y.select(F.col("side").alias("jb"), "inner").distinct(), "inner"), "block-grid")
    first = x.withColumnRenamed("side", "ib").join(grid, ["ib", "inner"]).withColumn("second", F.lit(False))
    other = y.withColumnRenamed("side", "jb").join(grid, ["jb", "inner"]).withColumn("second", F.lit(True))
    parts = first.unionByName(other).groupBy("ib", "inner", "jb").applyInPandas(_block_product, "i bigint, j bigint, v double")
    return parts.groupBy("i", "j").agg(F.sum("v").alias("v"))


def transpose(m: DataFrame) -> DataFrame:
    return m.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def gram_matrix(vectors: DataFrame, centered: bool = True) -> DataFrame:
    """Second-moment (or covariance) matrix ``(i, j, v)``.

    Every partition sums its rows' outer products in numpy and returns the upper
    triangle once; the partitions' sums are added, then mirrored.
    """
    mean = np.array([r.mean for r in sorted(component_stats(vectors).collect(), key=lambda r: r.i)]) if centered else 0.0

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for rows in batches:
            if len(rows):
                x = np.stack([np.asarray(v, np.float64) for v in rows["embedding"]]) - mean
                total = x.T @ x + (0 if total is None else total)
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pd.DataFrame({"i": i, "j": j, "s": total[i, j]})

    n = F.lit(float(max(vectors.count(), 1)))
    sums = vectors.select("embedding").mapInPandas(moments, "i int, j int, s double").groupBy("i", "j").agg(
        (F.sum("s") / n).alias("v"))
    sides = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
    return sums.select(F.explode(sides).alias("c"), "v").select("c.i", "c.j", "v")


def diagonal_trace(gram: DataFrame) -> DataFrame:
    """Diagonal of a square coordinate matrix and its trace."""
    return gram.where(F.col("i") == F.col("j")).agg(F.sum("v").alias("trace"), F.count(F.lit(1)).alias("dim"))


METRICS = ("cosine", "dot", "distance2", "angle")


def _similarities(x: np.ndarray, q: np.ndarray, metric: str) -> np.ndarray:
    """(rows, queries); larger is nearer. Zero vectors have cosine 0; the angle's cosine is clamped."""
    if metric == "distance2":
        return -((x[:, None, :] - q[None]) ** 2).sum(axis=2)
    dots = x @ q.T
    if metric == "dot":
        return dots
    norms = np.sqrt((x**2).sum(axis=1))[:, None] * np.sqrt((q**2).sum(axis=1))[None]
    cosine = np.divide(dots, norms, out=np.zeros_like(dots), where=norms > 0)
    return cosine if metric == "cosine" else -np.arccos(np.clip(cosine, -1.0, 1.0))


def knn_exact(vectors: DataFrame, queries: DataFrame, k: int, metric: str = "cosine") -> DataFrame:
    """V2: ``(q_id, rank, vec_id, sim)``: the k nearest rows of each query; ties go to the lower vec_id.

    ``queries`` = ``(q_id, q_vec)`` is a stated set whose bytes are checked; it
    goes to the tasks, every row is scored against it in Arrow batches, and a
    task keeps k rows per query, so only those are shuffled. ``sim`` is the
    similarity, or the negative squared distance or angle.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    rows = _checked_rows(queries.select("q_id", "q_vec"), "q_vec", "queries")
    sent = vectors.sparkSession.sparkContext.broadcast((_sent([r.q_vec for r in rows]), [r.q_id for r in rows]))
    types = f"q_id {queries.schema['q_id'].dataType.simpleString()}, vec_id bigint, sim double"

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q, names = sent.value
        best = [(np.empty(0), np.empty(0, np.int64)) for _ in names]  # similarities and ids, nearest first
        for pdf in batches:
            if not len(pdf) or not names:
                continue
            first = 0
            for x in _blocks(pdf["embedding"], len(names)):
                sims = _similarities(x, q, metric)
                ids = pdf["vec_id"].to_numpy()[first : first + len(x)]
                first += len(x)
                for j in range(len(names)):
                    s, i = best[j]
                    new = np.flatnonzero(sims[:, j] >= s[-1]) if len(s) == k else np.arange(len(x))
                    if len(new):
                        s, i = np.concatenate((s, sims[new, j])), np.concatenate((i, ids[new]))
                        order = np.lexsort((i, -s))[:k]
                        best[j] = s[order], i[order]
        yield pd.DataFrame([(name, int(i), float(s)) for name, b in zip(names, best, strict=True)
                            for s, i in zip(*b, strict=True)], columns=["q_id", "vec_id", "sim"])

    found = vectors.select("vec_id", "embedding").mapInPandas(nearest, types)
    w = Window.partitionBy("q_id").orderBy(F.desc("sim"), "vec_id")  # k rows per partition of the input
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("q_id", "rank", "vec_id", "sim")


def neighbour_change(vectors: DataFrame, queries: DataFrame, k: int, d: int) -> DataFrame:
    """``(q_id, rank, vec_id, truncated_id)``: the k nearest rows of each query by all components, and by the first d."""
    whole = knn_exact(vectors, queries, k).select("q_id", "rank", "vec_id")
    cut = knn_exact(vectors.withColumn("embedding", F.slice("embedding", 1, d)),
                    queries.withColumn("q_vec", F.slice("q_vec", 1, d)), k)
    return whole.join(cut.select("q_id", "rank", F.col("vec_id").alias("truncated_id")), ["q_id", "rank"])
