import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.operators import vectors as VX


@pytest.fixture(scope="module")
def emb(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6).astype(np.float32)], int(i % 3)) for i in range(30)]
    rows.append((30, [0.0] * 6, 0))
    rows.append((31, rows[5][1], 2))  # an exact duplicate
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int"), rows


def test_norms_zero_safe(emb):
    df, rows = emb
    got = {r.vec_id: r for r in VX.vector_norms(df).collect()}
    assert got[30].norm == 0 and all(x == 0 for x in got[30].unit)
    assert np.isclose(got[1].norm, np.linalg.norm(rows[1][1]))


def test_centroids_pool_standardize(emb):
    df, rows = emb
    x = np.array([r[1] for r in rows], dtype=np.float64)
    lab = np.array([r[2] for r in rows])
    cents = {(r.label, r.i): r.c for r in VX.centroids(df).collect()}
    for l in range(3):
        assert np.allclose([cents[(l, i)] for i in range(6)], x[lab == l].mean(axis=0))
    pool = {(r.label, r.i): (r.vmax, r.vmin) for r in VX.group_pool(df).collect()}
    assert np.isclose(pool[(1, 2)][0], x[lab == 1][:, 2].max())
    z = {r.vec_id: r.z for r in VX.standardize(df).collect()}
    want = (x - x.mean(axis=0)) / x.std(axis=0)
    assert np.allclose(z[4], want[4])


def test_assign_and_gram(emb):
    df, rows = emb
    x = np.array([r[1] for r in rows], dtype=np.float64)
    lab = np.array([r[2] for r in rows])
    cents = np.array([x[lab == l].mean(axis=0) for l in range(3)])
    got = {r.vec_id: r.nearest for r in VX.assign_nearest(df).collect()}
    want = ((x[:, None, :] - cents[None, :, :]) ** 2).sum(-1).argmin(1)
    assert [got[i] for i in range(len(rows))] == list(want)
    g = {(r.i, r.j): r.v for r in VX.gram_matrix(df).collect()}
    cov = np.cov(x.T, bias=True)
    assert np.allclose([[g[(i, j)] for j in range(6)] for i in range(6)], cov)
    assert np.isclose(VX.diagonal_trace(VX.gram_matrix(df)).collect()[0].trace, np.trace(cov))


def test_matrix_multiply_and_projection(emb, spark):
    df, rows = emb
    x = np.array([r[1] for r in rows], dtype=np.float64)
    c = VX.cells(df, extra=()).select(F.col("vec_id").alias("i"), F.col("i").alias("j"), "v")
    p = {(r.i, r.j): r.v for r in VX.matrix_multiply(VX.transpose(c), c).collect()}
    assert np.allclose([[p[(i, j)] for j in range(6)] for i in range(6)], x.T @ x)
    m = VX.projection_matrix(6, 3, 1)
    y = {r.vec_id: r.y for r in VX.project_vectors(df, m).collect()}
    assert np.allclose(y[7], np.array(m) @ x[7])


def test_profile_dedup_winsorize_truncate(emb):
    df, rows = emb
    prof = {r.vec_id: r for r in VX.vector_profile(df).collect()}
    v = np.array(rows[3][1], dtype=np.float64)
    assert prof[3].argmax == int(v.argmax()) and prof[3].argmin == int(v.argmin())
    d = VX.vector_dedup(df).collect()
    assert [(r.first_id, r.copies) for r in d] == [(5, 2)]
    clipped, rep = VX.winsorize(df)
    lo = {r.i: r.lo for r in rep.collect()}
    assert all(min(r.clipped) >= min(lo.values()) - 1e-12 for r in clipped.collect())
    t = {r.vec_id: r for r in VX.truncate_vectors(df, 3).collect()}
    assert np.isclose(np.linalg.norm(t[2].truncated), 1.0)
    b = {r.vec_id: r.blended for r in VX.blend_to_centroid(df, 1.0).collect()}
    x = np.array([r[1] for r in rows], dtype=np.float64)
    lab = np.array([r[2] for r in rows])
    assert np.allclose(b[4], x[lab == lab[4]].mean(axis=0))


def test_knn_exact_matches_brute_force(emb, spark):
    df, rows = emb
    x = np.array([r[1] for r in rows], dtype=np.float64)
    q = [(0, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]), (1, [float(v) for v in x[3]])]
    qs = spark.createDataFrame(q, "q_id bigint, q_vec array<double>")
    got = {}
    for r in VX.knn_exact(df.repartition(3), qs, 4).collect():
        got.setdefault(r.q_id, []).append((r.rank, r.vec_id))
    norms = np.linalg.norm(x, axis=1)
    for qid, qv in q:
        qv = np.array(qv)
        sims = np.where(norms > 0, x @ qv / np.where(norms > 0, norms, 1) / np.linalg.norm(qv), 0.0)
        order = sorted(range(len(rows)), key=lambda i: (-round(sims[i], 12), rows[i][0]))[:4]
        assert [v for _, v in sorted(got[qid])] == [rows[i][0] for i in order]


def test_knn_metrics(emb, spark):
    df, rows = emb
    x = np.array([r[1] for r in rows], dtype=np.float64)
    q = x[3]
    qs = spark.createDataFrame([(9, [float(v) for v in q])], "q_id bigint, q_vec array<double>")
    cosine = np.divide(x @ q, np.linalg.norm(x, axis=1) * np.linalg.norm(q), out=np.zeros(len(x)), where=np.linalg.norm(x, axis=1) > 0)
    near = {"dot": x @ q, "distance2": -((x - q) ** 2).sum(axis=1), "angle": -np.arccos(np.clip(cosine, -1, 1))}
    for metric, sims in near.items():
        got = VX.knn_exact(df, qs, 5, metric).orderBy("rank").collect()
        want = sorted(range(len(rows)), key=lambda i: (-round(sims[i], 9), rows[i][0]))[:5]
        assert [r.vec_id for r in got] == [rows[i][0] for i in want]
        assert np.allclose([r.sim for r in got], sims[want])
    with pytest.raises(ValueError):
        VX.knn_exact(df, qs, 5, "other")


def test_quantiles_of_uneven_groups(spark):
    rng = np.random.default_rng(1)
    groups = {0: rng.normal(size=1000), 1: rng.normal(size=7), 2: np.array([3.0]), None: np.array([1.0, 1.0, 2.0])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [(1, None)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(5)
    got = {r.g: r for r in VX.group_quantiles(df, {"a": 0.05, "b": 0.5, "c": 1.0}).collect()}
    for g, vs in groups.items():
        assert got[g].n == len(vs)
        assert np.allclose([got[g].a, got[g].b, got[g].c], np.quantile(vs, [0.05, 0.5, 1.0]))


def test_lexicographic_order_and_label_profile(emb):
    df, rows = emb
    got = {r.vec_id: r.place for r in VX.lexicographic_order(df).collect()}
    want = sorted(rows, key=lambda r: (r[1], r[0]))
    assert [got[r[0]] for r in want] == list(range(len(rows)))
    p = {r.label: r for r in VX.label_profile(df).collect()}
    x = np.array([r[1] for r in rows if r[2] == 1])
    assert p[1].n == len(x) and np.isclose(p[1].vmax, x.max()) and np.isclose(p[1].mean_sum, x.sum(axis=1).mean())


def _coordinates(spark, m, path=None):
    df = spark.createDataFrame([(int(i), int(j), float(m[i, j])) for i, j in zip(*np.nonzero(m))], "i bigint, j bigint, v double")
    if path:
        df.write.parquet(path)
        return spark.read.parquet(path)
    return df


def _dense(df, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        assert np.isnan(out[r.i, r.j])
        out[r.i, r.j] = r.v
    return out


@pytest.mark.parametrize("bits", [10, 2])
def test_products_of_one_stored_table(spark, scratch, monkeypatch, bits):
    monkeypatch.setattr(VX, "BLOCK_BITS", bits)
    rng = np.random.default_rng(0)
    m = rng.normal(size=(13, 13)) * (rng.random((13, 13)) < 0.4)
    a = _coordinates(spark, m, f"{scratch}/a")
    for left, right, want in ((a, a, (m, m)), (VX.transpose(a), a, (m.T, m)), (a, VX.transpose(a), (m, m.T))):
        got = _dense(VX.matrix_multiply(left, right), (13, 13))
        terms = (want[0] != 0).astype(int) @ (want[1] != 0)
        assert (np.isnan(got) == (terms == 0)).all() and np.allclose(np.nan_to_num(got), want[0] @ want[1])


def test_sparse_products_stay_sparse(spark, monkeypatch):
    one = spark.range(300).selectExpr("id AS i", "id AS j", "1.0D AS v")
    rows = VX.matrix_multiply(one, one).collect()
    assert len(rows) == 300 and all(r.i == r.j and r.v == 1 for r in rows)
    cancel = spark.createDataFrame([(0, 0, 1.0), (0, 1, -1.0), (0, 1, 0.0), (-5000, 0, 2.0)], "i bigint, j bigint, v double")
    ones = spark.createDataFrame([(0, 7, 1.0), (1, 7, 1.0)], "i bigint, j bigint, v double")
    got = {(r.i, r.j): r.v for r in VX.matrix_multiply(cancel, ones).collect()}
    assert got == {(0, 7): 0.0, (-5000, 7): 2.0}  # a sum of zero is a cell, as in a join
    assert VX.matrix_multiply(one, one.limit(0)).count() == 0


def test_quantiles_of_ties_and_magnitudes(spark, monkeypatch):
    """Null groups, a value held by most rows, values of all magnitudes and signs, groups of one row; few bins."""
    monkeypatch.setattr(VX, "BINS", 8)
    rng = np.random.default_rng(1)
    groups = {None: rng.normal(size=50), 1: np.concatenate((np.full(300, 0.5), rng.random(120))),
              2: np.sign(rng.normal(size=90)) * 10.0 ** rng.integers(-300, 300, 90), 3: np.array([7.0]),
              4: np.array([-1.5e308, 1.5e308, 0.0]), 5: 2.0 ** np.arange(-200, 0)}
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [(1, None), (9, None)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(3)
    shares = {"low": 0.0, "a": 0.05, "b": 0.5, "c": 0.77, "high": 1.0}
    got = {r.g: r for r in VX.group_quantiles(df, shares).collect()}
    assert set(got) == set(groups)
    for g, v in groups.items():
        assert got[g].n == len(v)
        for name, q in shares.items():
            v = np.sort(v)
            at = q * (len(v) - 1)
            k = int(at)
            want = v[k] if at == k else v[k] * (1 - (at - k)) + v[k + 1] * (at - k)
            assert np.isclose(got[g][name], want, rtol=1e-12), (g, name)


def test_blocks_by_bytes(emb, spark, monkeypatch):
    df, rows = emb
    queries = spark.createDataFrame([(q, rows[q][1]) for q in (0, 5, 30)], "q_id int, q_vec array<float>")
    for metric in VX.METRICS:
        want = [tuple(r) for r in VX.knn_exact(df, queries, 7, metric).orderBy("q_id", "rank").collect()]
        monkeypatch.setattr(VX, "BLOCK_BYTES", 500)
        assert [tuple(r) for r in VX.knn_exact(df, queries, 7, metric).orderBy("q_id", "rank").collect()] == want
        monkeypatch.setattr(VX, "BLOCK_BYTES", 1 << 26)


@pytest.mark.parametrize("factors", [64, 2])
def test_principal_components_against_numpy(spark, monkeypatch, factors):
    monkeypatch.setattr(VX, "FACTORS", factors)
    rng = np.random.default_rng(11)
    x = rng.normal(size=(300, 12)) * np.linspace(6, 0.5, 12) @ np.linalg.qr(rng.normal(size=(12, 12)))[0] + 3.0
    df = spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>, label int")
    pca = VX.principal_components(df.repartition(7), 3)
    values, basis = np.linalg.eigh(np.cov(x.T, bias=True))
    values, basis = values[::-1][:3], basis[:, ::-1][:, :3]
    assert np.allclose(pca.variance, values, rtol=1e-6) and np.allclose(pca.mean, x.mean(axis=0))
    m = np.array(pca.matrix)
    assert np.allclose(m @ m.T, np.eye(3), atol=1e-9)
    assert np.allclose(np.abs(np.diag(m @ basis)), 1, atol=1e-5)  # the same directions, up to the sign
    y = np.array([r.y for r in VX.project_vectors(df, pca.matrix).orderBy("vec_id").collect()])
    assert np.allclose(np.cov(y.T, bias=True), np.diag(values), atol=1e-3)


def test_principal_components_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0, 3.0], 0), (1, [3.0, 2.0, 1.0], 0), (2, None, 0)],
                               "vec_id bigint, embedding array<double>, label int").repartition(3)
    pca = VX.principal_components(df, 2)
    assert np.allclose(pca.variance, [2.0, 0.0], atol=1e-9) and np.allclose(np.abs(pca.matrix[0]), [0.5**0.5, 0, 0.5**0.5])
    with pytest.raises(ValueError):
        VX.principal_components(df, 4)
