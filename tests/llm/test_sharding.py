from collections import Counter

from lakeledger.llm import sharding
from pyspark.sql import functions as F


def place(spark, n, shards, seed=0, parts=5, **more):
    df = spark.range(0, n, 1, parts).withColumnRenamed("id", "doc_id")
    return sharding.shuffle_to_shards(df, shards, seed=seed, **more).collect()


def test_sizes_exact_and_slots_gapless(spark):
    rows = place(spark, 1003, 7, block_rows=20)
    assert sorted(r.doc_id for r in rows) == list(range(1003))
    sizes = Counter(r.shard for r in rows)
    assert sorted(sizes.values()) == sorted([144] * 2 + [143] * 5)
    for s, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))


def test_matrix_sums(spark):
    sizes = spark.createDataFrame([(0, 10), (2, 7), (3, 100), (6, 1)], "p int, n long")
    goal = spark.createDataFrame([([40, 40, 38],)], "counts array<long>")
    got = {r.p: r.counts for r in sharding.communication_matrix(sizes, goal, 7).collect()}
    assert {p: sum(c) for p, c in got.items()} == {0: 10, 2: 7, 3: 100, 6: 1}
    assert [sum(c) for c in zip(*got.values())] == [40, 40, 38]


def test_hypergeometric_law(spark):
    """Chi-square of 4,000 draws against the exact law, and of extreme cases' support."""
    from math import comb

    draw = sharding.hypergeometric("30L", "12L", "9L", "(id + 0.5D) / 4000D")
    got = Counter(r[0] for r in spark.range(4000).selectExpr(draw).collect())
    for x in range(10):
        want = 4000 * comb(12, x) * comb(18, 9 - x) / comb(30, 9)
        assert abs(got.get(x, 0) - want) <= 1.01  # u runs over an even grid
    big = sharding.hypergeometric("1000000000000L", "400000000L", "5000000000L", "(id + 0.5D) / 200D")
    values = [r[0] for r in spark.range(200).selectExpr(big).collect()]
    mean, sd = 2_000_000, (5e9 * 4e-4 * (1 - 4e-4) * (1 - 5e-3)) ** 0.5
    assert abs(sum(values) / 200 - mean) < 0.1 * sd
    assert 0.8 * sd < (sum((v - mean) ** 2 for v in values) / 200) ** 0.5 < 1.2 * sd


def test_uniform_over_shards_and_slots(spark):
    """Neighbouring input rows spread evenly over shards and over halves of a shard."""
    hits, early = Counter(), 0
    for seed in range(3):
        for r in place(spark, 3000, 3, seed=seed, parts=6):
            if r.doc_id < 300:
                hits[r.shard] += 1
                early += r.slot < 500
    assert all(250 <= hits[s] <= 350 for s in range(3)) and 390 <= early <= 510


def test_edge_rows(edge_docs, empty_docs):
    rows = sharding.shuffle_to_shards(edge_docs, 40).select("doc_id", "shard", "slot", F.length("text").alias("n"))
    got = rows.collect()
    assert Counter(r.doc_id for r in got) == Counter([1, 2, 3, 4, 5, 6, 6, 7, 8])
    assert len({r.shard for r in got}) == 9 and all(r.slot == 0 for r in got)
    assert sharding.shuffle_to_shards(empty_docs, 40).count() == 0
