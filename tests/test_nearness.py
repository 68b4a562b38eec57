import numpy as np
import pytest

from wordloom.operators import nearness as N
from wordloom.operators.graph import local_components


def frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    rows = [(int(i), None if v is None else [float(c) for c in v], 0) for i, v in zip(ids, x, strict=True)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(3)


def slow(x, radius, metric="distance", ids=None):
    ids = list(range(len(x))) if ids is None else list(ids)
    links = {i: set() for i in range(len(x))}
    for i in range(len(x)):
        for j in range(len(x)):
            if i == j or x[i] is None or x[j] is None:
                continue
            a, b = (np.array(v, np.float64) for v in (x[i], x[j]))
            if metric == "angle":
                if not a.any() or not b.any():
                    continue
                a, b = a / np.sqrt((a * a).sum()), b / np.sqrt((b * b).sum())
            far = np.sqrt(((a - b) ** 2).sum())
            if far <= (radius if metric == "distance" else 2 * np.sin(radius / 2)):
                links[i].add(j)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[ids[i]] = (min(ids[j] for j in seen), len(links[i]))
    return out


def got(df):
    rows = df.collect()
    out = {r.vec_id: (r.component_id, r.n_links) for r in rows}
    assert len(out) == len(rows)
    return out


def clustered(rng, n=260, dim=5):
    x = rng.normal(size=(12, dim))[rng.integers(0, 12, n)] + rng.normal(size=(n, dim)) * 0.15
    x[40:70] = x[3]  # copies
    return list(x) + [np.zeros(dim), np.zeros(dim), None, None]


@pytest.mark.parametrize("block", [N.BLOCK_ROWS, 7])
@pytest.mark.parametrize("metric, radius", [("distance", 0.4), ("distance", 0.0), ("distance", 9.0), ("angle", 0.3)])
def test_exact_join(spark, metric, radius, block):
    x = clustered(np.random.default_rng(5))
    ids = np.random.default_rng(6).permutation(len(x)) * 3 + 1
    out = got(N.similarity_join(frame(spark, x, ids), radius, metric, block_rows=block))
    assert out == slow(x, radius, metric, ids)


def test_grid_on_the_radius(spark):
    """Distances that are exactly the radius, on cell and ring borders."""
    x = [(a, b) for a in range(9) for b in range(9)]
    assert got(N.similarity_join(frame(spark, x), 1.0, block_rows=10)) == slow(x, 1.0)


def test_buckets_find_most_links(spark):
    """Recall of the bucketed join at an angle of 0.25: at least 0.9 of the links, and no false one."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 24))[rng.integers(0, 60, 700)] + rng.normal(size=(700, 24)) * 0.12
    x[650:] = x[10]
    want = slow(x, 0.25, "angle")
    out = got(N.similarity_join(frame(spark, x), 0.25, "angle", "buckets"))
    found, all_links = sum(n for _, n in out.values()), sum(n for _, n in want.values())
    assert 0.9 * all_links <= found <= all_links
    assert all(out[i][1] <= want[i][1] for i in out)
    assert sum(out[i][0] == want[i][0] for i in out) >= 0.95 * len(out)


def test_no_rows(spark):
    assert N.similarity_join(frame(spark, []), 1.0).count() == 0
    assert got(N.similarity_join(frame(spark, [None, (1.0, 2.0)]), 1.0)) == {0: (0, 0), 1: (1, 0)}
    with pytest.raises(ValueError):
        N.similarity_join(frame(spark, []), 1.0, "distance", "buckets")


def test_local_components():
    parent = local_components(np.arange(8), np.array([7, 1, 2, 2]), np.array([2, 4, 5, 5]))
    assert parent.tolist() == [0, 1, 2, 3, 1, 2, 6, 2]


@pytest.mark.parametrize("k", [1, 4, 500])
def test_pivot_index_is_exact(spark, k):
    x = clustered(np.random.default_rng(7))
    ids = np.random.default_rng(6).permutation(len(x)) * 3 + 1
    index = N.PivotIndex(frame(spark, x, ids), pivots=9)
    queries = [x[0], x[50], np.full(5, 9.0), np.zeros(5)]
    qs = spark.createDataFrame([(q, [float(c) for c in v]) for q, v in enumerate(queries)], "q_id int, q_vec array<double>")
    out = index.nearest(qs, k).orderBy("q_id", "rank").collect()
    for q, v in enumerate(queries):
        want = sorted((float(((np.array(y) - v) ** 2).sum()), int(i)) for y, i in zip(x, ids) if y is not None)[:k]
        mine = [r for r in out if r.q_id == q]
        assert [r.vec_id for r in mine] == [i for _, i in want] and [r["rank"] for r in mine] == list(range(1, len(want) + 1))
        assert np.allclose([-r.sim for r in mine], [d for d, _ in want])


def test_pivot_index_skips_cells(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(12, 8))[rng.integers(0, 12, 600)] * 10 + rng.normal(size=(600, 8)) * 0.1
    index = N.PivotIndex(frame(spark, x), pivots=12)
    qs = spark.createDataFrame([(0, [float(c) for c in x[5]])], "q_id int, q_vec array<double>")
    assert index.nearest(qs, 5).first().vec_id == 5 and len(index.read) < len(index.cells) == 12
    none = N.PivotIndex(frame(spark, []))
    assert none.nearest(qs, 3).count() == 0 and index.nearest(qs.limit(0), 3).count() == 0


def test_far_blocks_are_not_compared(spark, monkeypatch):
    """A pair of blocks is compared once, and only if the pivots do not keep it apart; entries travel in whole blocks."""
    rng = np.random.default_rng(4)
    x = np.repeat(np.arange(10.0), 60)[:, None] * 100 + rng.normal(size=(600, 3))
    compared = []
    keep = N.stored
    monkeypatch.setattr(N, "stored", lambda df, name="table": (
        compared.extend((r.i, r.j) for r in df.collect()) if name == "block-pairs" else None) or keep(df, name))
    assert got(N.similarity_join(frame(spark, x), 0.5, block_rows=20)) == slow(x, 0.5)
    blocks = 1 + max(j for _, j in compared)
    assert len(set(compared)) == len(compared) < blocks * (blocks + 1) / 4 and all(i <= j for i, j in compared)
