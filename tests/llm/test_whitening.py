from fractions import Fraction

import numpy as np
from lakeledger.llm import whitening
from lakeledger.llm.queries import op12_whitening

SF = "/root/testdata/sf0.01"


def brute(vectors):
    """Exact covariance by fractions, eigenvectors in float64 from it."""
    x = sorted({tuple(int(np.floor(256.0 * c)) for c in v) for v in vectors})
    n, sums = len(x), [sum(c) for c in zip(*x)]
    m = np.array(x, dtype=object) * n - np.array(sums, dtype=object)
    v = np.array([[float(Fraction(int(p), n ** 3)) for p in line] for line in m.T @ m])
    e, q = np.linalg.eigh(v)
    return n, sums, v, e[::-1], q[:, ::-1]


def test_query_against_brute_force(spark):
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    n, sums, v, e, q = brute(rows.values())
    got = op12_whitening(spark, SF).collect()
    assert len(got) == 4 * len(rows) and {r.component for r in got} == {1, 2, 3, 4}
    for r in got:
        centred = [n * int(np.floor(256.0 * c)) - s for c, s in zip(rows[r.vec_id], sums)]
        assert r.n == n and r.deviation == sum(c * c for c in centred)
        k = r.component - 1
        assert abs(r.explained - e[k] / np.trace(v)) <= 1e-12 and 0 <= r.identity_error < 1e-10
        assert abs(abs(r.whitened) - abs(np.dot(centred, q[:, k])) / n / np.sqrt(e[k])) < 1e-9
    for k in range(4):  # one sign for all rows
        signs = {r.whitened * np.dot([n * int(np.floor(256.0 * c)) - s for c, s in zip(rows[r.vec_id], sums)], q[:, k]) > 0
                 for r in got if r.component == k + 1 and abs(r.whitened) > 1e-6}
        assert len(signs) == 1


def exact_residual(a, values, x):
    """max |A x - e x| and max |X'X - I| in extended precision."""
    a = a.astype(np.longdouble)
    return float(np.abs(a @ x - x * values).max()), float(np.abs(x.T @ x - np.eye(len(a))).max())


def test_eigen_beyond_double():
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    for e in (np.linspace(1, 2, 40), 10.0 ** -np.arange(40.0) / 3, np.r_[[1.0, 1 + 1e-9, 1 + 2e-9, 1 - 1e-11], np.linspace(0.1, 0.5, 36)],
              np.r_[np.ones(20), np.full(20, 0.5)], np.r_[np.full(39, 1e-12), 1.0]):
        a = (q * e) @ q.T
        a = (a + a.T) / 2
        values, x = whitening.eigen(a)
        residual, off = exact_residual(a, values, x)
        assert residual < 1e-17 * 40 and off < 1e-17 * 40 and (np.diff(values) <= 0).all()


def test_clusters_are_told_apart():
    # Two directions whose variances differ by 1e-10: float32 can't see which is which.
    rng = np.random.default_rng(6)
    q = np.linalg.qr(rng.normal(size=(6, 6)))[0].astype(np.longdouble)
    for _ in range(4):
        q = q @ (1.5 * np.eye(6, dtype=np.longdouble) - q.T @ q / 2)
    e = np.array([1.0, 1 - 1e-10, 0.3, 0.3 - 1e-8, 0.2, 0.1], np.longdouble)
    values, x = whitening.eigen((q * e) @ q.T)
    assert np.abs(np.abs(np.diag(q.T @ x)) - 1).max() < 1e-15 and np.abs(values - e).max() < 1e-17
    assert np.abs(q.T @ x - np.diag(np.diag(q.T @ x))).max() < 1e-8 * 1e-0
    assert [sorted(c) for c in whitening.clusters(np.array([3.0, 1.0, 1.1, 2.95]), 0.2)] == [[1, 2], [0, 3]]


SCHEMA = "vec_id long, embedding array<double>, component string, `a.b` int"


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, []), (6, [0.0, 0.0]), (7, [1.0, 0.5]), (8, [1.0, 0.5]),
            (8, [-0.25, 2.0]), (None, [3.0, 1.0]), (9, [1.0, 2.0, 3.0]), (10, [-0.001, -0.0])]
    df = spark.createDataFrame([(i, v, "x", 7) for i, v in rows], SCHEMA)
    got = whitening.whiten(df).collect()
    two = [v for _, v in rows if v and len(v) == 2 and None not in v and not {nan, inf} & set(v) and v[0] == v[0] and abs(v[0]) < inf]
    n, sums, v, e, q = brute(two)
    assert sorted((r.vec_id or -1, r.component) for r in got) == sorted(
        [(i, c) for i in (6, 7, 8, 8, -1, 10) for c in (1, 2)] + [(9, c) for c in (1, 2, 3)])
    assert got[0].asDict()["a.b"] == 7
    for r in got:
        if r.vec_id == 9:  # alone with its length: no variance
            assert (r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, None, None, None)
        else:
            assert r.n == n and abs(r.explained - e[r.component - 1] / np.trace(v)) < 1e-12 and r.identity_error < 1e-12
    same = {r.component: r.whitened for r in got if r.vec_id == 7}
    assert all(any(r.whitened == same[r.component] for r in got if r.vec_id == 8 and r.component == c) for c in (1, 2))
    assert whitening.whiten(df.where("false")).collect() == [] and whitening.whiten(df.where("vec_id = 5")).collect() == []


def test_line_and_huge_entries(spark):
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(9)], "vec_id long, embedding array<double>")
    got = whitening.whiten(line).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in got) and all(r.identity_error < 1e-12 for r in got)
    assert {r.explained for r in got if r.component > 1} == {0.0}
    huge = spark.createDataFrame([(0, [1e30, 1.0]), (1, [-1e30, 2.0]), (2, [3e12, 2.0])], "vec_id long, embedding array<double>")
    got = whitening.whiten(huge).collect()
    assert len(got) == 6 and {r.deviation for r in got} == {None} and all(r.identity_error < 1e-9 for r in got)
