import random
from collections import defaultdict

import pandas as pd
from lakeledger.llm import mixing


def brute_targets(sizes, weights, share, cap):
    """Deal by weight, cap, deal the excess again, until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    done, left = {}, share * sum(sizes.values())
    open_ = list(names)
    while open_:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total > cap * sizes[s] + 1e-9]
        if not over:
            done |= {s: left * w[s] / total for s in open_}
            break
        for s in over:
            done[s] = cap * sizes[s]
        left -= sum(cap * sizes[s] for s in over)
        open_ = [s for s in open_ if s not in over]
    return done


def docs(spark, n=3000, seed=1):
    rng = random.Random(seed)
    names = ["b", "a", "\U0001F600", "\uFF5E", None, "hot", "hot", "hot", "hot"]
    rows = [(i, rng.choice(names), rng.choice([0, 1, 5, 40, 300, 5000 if i % 100 == 0 else 7])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, source string, size long")


def test_targets_and_taken(spark):
    rows, df = docs(spark)
    sums, largest = defaultdict(int), defaultdict(int)
    for _, s, z in rows:
        sums[s] += z
        largest[s] = max(largest[s], z)
    want = brute_targets(sums, (3, 1, 2), 1.5, 2.0)
    got = mixing.mix(df, text=None, block_rows=50).collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source]) and r.source_size == sums[r.source]
        taken[r.source] += r.copies * r.size
        f = r.target / r.source_size
        assert r.copies in (int(f), int(f) + 1) or r.size == 0
        assert r.copies <= 2
    for s in sums:
        assert abs(taken[s] - want[s]) <= largest[s]


def test_reruns_agree_whatever_the_split(spark):
    _, df = docs(spark, 800)
    a = mixing.mix(df.repartition(7), text=None, block_rows=32).collect()
    b = mixing.mix(df.coalesce(1), text=None, block_rows=32).collect()
    assert {(r.doc_id, r.copies) for r in a} == {(r.doc_id, r.copies) for r in b}


def test_expectation_is_kept():
    """Over many coins each document's mean copies come near its fraction."""
    rng, total, runs = random.Random(3), defaultdict(float), 4000
    sizes, f = [9, 7, 4, 4, 2, 1], 0.35
    for _ in range(runs):
        frame = pd.DataFrame([(i, 0, 0, s, 0, f, rng.random()) for i, s in enumerate(sizes)],
                             columns=["row", "sid", "block", "size", "whole", "part", "u"])
        out = pd.concat(mixing.pivotal(iter([frame.iloc[:2], frame.iloc[2:]])))
        assert len(out) == len(sizes) and (out.part > 0).sum() <= 1
        assert abs((out["size"] * (out.whole + out.part)).sum() - f * sum(sizes)) < 1e-9
        for r in out.itertuples():
            total[r.row] += r.whole + r.part
    assert all(abs(t / runs - f) < 0.03 for t in total.values())


def test_edge_rows(edge_docs, empty_docs):
    got = mixing.mix(edge_docs).collect()
    assert sorted(r.doc_id for r in got) == [1, 2, 3, 4, 5, 6, 6, 7, 8]
    by = {r.doc_id: r for r in got}
    assert by[1].size == by[2].size == by[3].size == 0 and by[1].copies == 0
    assert by[4].size == 30_000 and by[5].size == 6 and by[7].size == by[8].size == 1
    assert mixing.mix(empty_docs).count() == 0
