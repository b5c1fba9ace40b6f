import random
import re

import numpy as np
from lakeledger.llm import neardup
from lakeledger.llm.components import connected
from lakeledger.llm.queries import op7_neardup


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def brute(rows, size, percent):
    """(n, component) by comparing all pairs of distinct sets that share a shingle."""
    sets = {}
    for i, t in rows:
        w = words_of(t)
        sets[i] = frozenset([tuple(w)] if 0 < len(w) < size else [tuple(w[k:k + size]) for k in range(len(w) - size + 1)] if w else [])
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    first, holders = {}, {}
    for i, s in sorted(sets.items()):
        if s in first and s:
            root[find(i)] = find(first[s])
        elif s:
            first[s] = i
            for g in s:
                holders.setdefault(g, []).append(i)
    shared = {}
    for g, who in holders.items():
        for x in range(len(who)):
            for y in range(x):
                shared[who[y], who[x]] = shared.get((who[y], who[x]), 0) + 1
    for (x, y), n in shared.items():
        if 100 * n >= percent * (len(sets[x]) + len(sets[y]) - n):
            a, b = sorted((find(x), find(y)))
            root[b] = a
    least = {}
    for i in sorted(sets):
        least.setdefault(find(i), i)
    return {i: (len(sets[i]), least[find(i)]) for i in sets}


def check(got, want):
    assert len(got) == len(want)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id], r
        assert r.kept == (r.doc_id == r.component_id)


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    check(op7_neardup(spark, "/root/testdata/sf0.01").collect(), brute(rows, 2, 80))


def near_copies(n=150, seed=2, vary=6):
    """A large group around one text, most pairs of which are just below or above the
    threshold, beside unrelated texts, exact copies and chains."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base = [word() for _ in range(60)]
    rows = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.randrange(vary)):
            own[rng.randrange(60)] = word()
        rows.append((i, " ".join(own)))
    chain = [word() for _ in range(60)]
    for i in range(n, n + 30):  # each link of the chain changes a little more
        chain = [*chain[2:], word(), word()]
        rows.append((i, " ".join(chain)))
    rows += [(n + 30 + i, " ".join(word() for _ in range(40))) for i in range(100)]
    rows += [(n + 130 + i, rows[5][1].upper()) for i in range(50)]
    return rows


def test_groups_chains_and_copies(spark):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(neardup.near_duplicates(df, words=2).collect(), brute(rows, 2, 80))


def test_sketch_agreement_estimates_similarity():
    rng = np.random.default_rng(7)
    for size in (3, 30, 300, 5000):
        agree = []
        for _ in range(60):
            pool = rng.integers(0, 1 << 63, 2 * size, dtype=np.uint64)
            a, b = np.unique(pool[:size]), np.unique(pool[size // 3:size + size // 3])
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            agree.append((neardup.sketch(a) == neardup.sketch(b)).mean() - true)
        assert abs(np.mean(agree)) < 0.02 and np.std(agree) < 0.06


def test_shingles_are_those_of_the_words():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["a", "B", "é", "\U0001F600", " ", "\t", "\x0b", "\x1c", "word", "\n"]) for _ in range(rng.randrange(40)))
        w = words_of(text)
        for size in (1, 2, 5):
            grams = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
            assert len(neardup.shingles(text, size)) == len(grams)
    assert neardup.shingles("Ab c", 2).tolist() == neardup.shingles(" aB\n\nC ", 2).tolist()
    assert len(neardup.word_hashes("x " * 200_000)) == 200_000


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1100)]
    got = {r.node: r.label for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    alone = {a for a, b in edges if a == b} - set(got)
    assert {x: r for x, r in root.items() if x not in alone} == got and all(root[x] == x for x in alone)


def test_edge_rows(spark, edge_docs, empty_docs):
    more = spark.createDataFrame([(None, "ein Wort und noch ein Wort")], "doc_id long, text string")
    df = edge_docs.select("doc_id", "text").union(more)
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(df, words=2).collect()]
    assert sorted(got, key=str) == sorted([
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 4, 5, True), (6, 4, 5, False), (6, 4, 5, False),
        (7, 1, 7, True), (8, 1, 8, True), (None, 4, None, True)], key=str)
    kept = neardup.drop_near_duplicates(edge_docs.union(edge_docs.where("doc_id = 5")), words=2)
    assert kept.columns == edge_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5, 7, 8]
    assert neardup.near_duplicates(empty_docs).count() == 0 and neardup.drop_near_duplicates(empty_docs).count() == 0


def test_rows_that_share_an_id(spark):
    a, b = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(1, a, "x"), (1, b, "y"), (2, a + " end", "z"), (3, b, "u"), (3, b, "t"), (4, None, "n"), (4, None, "n"), (None, a, "m"), (5, "", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, gone string")
    got = sorted((r.doc_id or -1, r.text or "") for r in neardup.drop_near_duplicates(df).collect())
    assert got == sorted([(1, a), (1, b), (4, ""), (4, ""), (-1, a), (5, "")])
    alone = spark.createDataFrame([(7, a, "x"), (7, b, "y"), (7, b, "z")], df.schema)
    assert sorted(r.text for r in neardup.drop_near_duplicates(alone).collect()) == sorted([a, b])
