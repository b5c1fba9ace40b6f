import numpy as np
import pytest
from lakeledger.llm import ann
from lakeledger.llm.queries import op5_ann
from pyspark.sql import functions as F


def brute(ids, vectors, asked, k):
    m = np.stack(vectors).astype(float)
    u = m / np.linalg.norm(m, axis=1)[:, None]
    out = {}
    for q in asked:
        score = u @ u[ids.index(q)]
        order = sorted((x for x in range(len(ids)) if ids[x] != q), key=lambda x: (-round(score[x], 12), ids[x]))
        out[q] = [(ids[x], score[x]) for x in order[:k]]
    return out


def result(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    return got


def test_hilbert_keys_step_by_one_cell():
    for m, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * m, indexing="ij"), -1).reshape(-1, m)
        key = ann.hilbert_keys(grid.astype(np.uint64), bits)
        assert sorted(key.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(key)].astype(int), axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_recall_against_brute_force(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = [r.vec_id for r in rows]
    want = brute(ids, [np.array(r.embedding) for r in rows], [i for i in ids if i % 50 == 0], 5)
    got = result(op5_ann(spark, folder))
    assert set(got) == set(want) and all(len(g) == 5 for g in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    for q in want:
        true = dict(want[q])
        assert all(abs(s - true[i]) < 1e-12 for i, s in got[q] if i in true)


def test_common_vector_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(1)
    hot, rows = [1.0, 2.0, 3.0, 4.0], []
    rows += [(i, hot) for i in range(0, 3000, 3)]
    rows += [(i, rng.normal(size=4).tolist()) for i in range(3000) if i % 3]
    good = dict(rows)
    rows += [(5000, None), (5050, [0.0] * 4), (5100, [1.0, float("nan"), 1.0, 1.0]), (5150, [1.0, None, 1.0, 1.0]),
             (5200, [float("inf"), 1.0, 1.0, 1.0]), (5250, []), (5300, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = result(ann.nearest(df, 5, F.col("vec_id") % 50 == 0))
    assert set(got) == {i for i in good if i % 50 == 0}
    for q in got:
        if q % 3 == 0:
            assert [i for i, _ in got[q]] == [i for i in range(0, 21, 3) if i != q][:5]
            assert all(abs(s - 1) < 1e-12 for _, s in got[q])


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (7, [1.0, 1.0]), (9, [2.0, 0.0])], "vec_id long, embedding array<float>")
    got = result(ann.nearest(df, 5, F.col("vec_id") % 50 == 0))
    assert [i for i, _ in got[0]] == [9, 7] and abs(got[0][1][1] - 0.5**0.5) < 1e-12
    assert ann.nearest(df.where("vec_id = 0"), 5, F.col("vec_id") == 0).count() == 0
    assert ann.nearest(df.limit(0), 5, F.col("vec_id") == 0).count() == 0


def test_repeated_ids_and_lengths(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.1]), (50, [1.0, 2.0, 3.0]), (3, [3.0, 2.0, 1.0]), (4, [1.0] * 4)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    got = ann.nearest(df, 5, F.col("vec_id") % 50 == 0).collect()
    near = 1 / np.sqrt(1.01)
    want = [(0, 1, 0.1 * near), (0, 1, near), (50, 3, 10 / 14)]
    assert [(r.query_id, r.vec_id) for r in sorted(got)] == [(q, v) for q, v, _ in want]
    assert np.allclose(sorted(r.score for r in got if r.query_id == 0), [0.1 * near, near])
    assert np.allclose([r.score for r in got if r.query_id == 50], 10 / 14)


def test_recall_at_all_windows(spark):
    """20,000 vectors without any structure: every curve is cut into WINDOWS ranges."""
    n, dims = 20_000, 64
    vectors = np.random.default_rng(8).normal(size=(n, dims)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    got = result(ann.nearest(df, 5, F.col("vec_id") % 200 == 0))
    hits = 0
    for q in range(0, n, 200):
        score = unit @ unit[q]
        score[q] = -2
        hits += len({i for i, _ in got[q]} & set(np.argsort(-score)[:5].tolist()))
    assert hits >= 0.9 * 5 * len(got)
    # What the curves look at together, of all rows (README states it).
    ranges = np.stack([np.argsort(np.argsort(ann.hilbert_keys(ann.curve_cells(unit, c, 0), ann.BITS))) * ann.WINDOWS // n
                       for c in range(ann.CURVES)])
    seen = np.mean([(np.abs(ranges - ranges[:, [q]]) <= ann.REACH).any(0).mean() for q in range(0, n, 200)])
    assert 0.6 < seen < 0.85
