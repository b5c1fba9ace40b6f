import random

import numpy as np
from lakeledger.llm import linededup as ld
from pyspark.sql import functions as F


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(docs, edits=ld.EDITS):
    """Cleaned texts: all pairs of distinct lines."""
    place = {}
    order = lambda i: (i is None, i or 0)
    for i, t in docs:
        for n, line in enumerate(t.split("\n") if t is not None else []):
            if len(line) >= ld.MIN_CHARS:
                place[line] = min(place.get(line, ((True, 9e9), 0)), (order(i), n))
    names = sorted(place, key=lambda x: place[x])
    # An edit changes the letter counts by two at most: all other pairs are compared.
    counts = np.zeros((len(names), 64), np.int32)
    for k, x in enumerate(names):
        np.add.at(counts[k], [ord(c) % 64 for c in x], 1)
    near = set()
    for k, b in enumerate(names):
        close = np.flatnonzero(np.abs(counts[:k] - counts[k]).sum(1) <= 2 * edits)
        if any(abs(len(names[m]) - len(b)) <= edits and distance(names[m], b) <= edits for m in close):
            near.add(b)
    out = []
    for i, t in docs:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        lines = t.split("\n")
        kept = [x for n, x in enumerate(lines) if len(x) < ld.MIN_CHARS or (x not in near and place[x] == (order(i), n))]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def edited(rng, line, n):
    chars = list(line)
    for _ in range(n):
        at = rng.randrange(len(chars) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            chars.insert(at, rng.choice("abcé\U0001F600 "))
        elif chars and at < len(chars):
            if kind == 1:
                del chars[at]
            else:
                chars[at] = rng.choice("abcé\U0001F600 ")
    return "".join(chars)


def test_banded_distance(spark):
    rng = random.Random(5)
    rows = []
    for n in range(1500):
        a = "".join(rng.choice("abé ") for _ in range(rng.randrange(0, 25)))
        b = edited(rng, a, rng.randrange(6)) if n % 3 else "".join(rng.choice("ab") for _ in range(rng.randrange(0, 12)))
        rows.append((a, b))
    df = spark.createDataFrame(rows, "a string, b string")
    for edits in (1, 2, 3):
        got = df.select("a", "b", F.expr(ld.within("a", "b", edits)).alias("near")).collect()
        for r in got:
            assert r.near == (distance(r.a, r.b) <= edits), (r, edits)


def test_near_lines_share_a_key(spark):
    """Whatever the edits, the shorter line's index meets a key of the longer one."""
    rng, rows = random.Random(6), []
    for _ in range(1500):
        a = "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(30, 60)))
        b = edited(rng, a, rng.randrange(1, 3))
        rows.append(tuple(sorted((a, b), key=len)))
    df = spark.createDataFrame(rows, "short string, long string").withColumn("m", F.length("short")).withColumn("n", F.length("long"))
    keys = F.expr(f"array({', '.join(ld.index_keys('short', 'm'))})")
    probes = F.expr(f"array({', '.join(ld.index_keys('long', 'n') + ld.probe_keys('long', 'n'))})")
    assert len(ld.probe_keys()) == 9
    missed = df.where(~F.arrays_overlap(keys, F.array_compact(probes))).collect()
    assert missed == []
    near = ld.counts_near("x", "y")
    counts = {x: "array(" + ", ".join(ld.letter_counts(x, c) for c in ld.COUNTED) + ")" for x in ("short", "long")}
    assert df.selectExpr(f"{counts['short']} AS x", f"{counts['long']} AS y").where(f"NOT {near}").count() == 0


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8)))
    lines = [" ".join(word() for _ in range(rng.randrange(1, 14))) for _ in range(60)]
    lines += [edited(rng, lines[0] + " padding to be long enough", n) for n in range(1, 5) for _ in range(12)]
    lines += ["", "short", "\t", "x" * 29, "x" * 30, "x" * 31, "x" * 33]
    docs = [(i, "\n".join(edited(rng, rng.choice(lines), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(1, 12))))
            for i in rng.sample(range(1000), 60)]
    lone = "a line that only the document without an id holds, with one more word"
    return [*docs, (None, "\n".join([*lines[:9], lone, lone + "."])), (2000, None), (2001, ""), (2002, docs[0][1]), (2003, "y" * 900 + "\n" + "y" * 901)]


def test_matches_brute_force(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_lines", F.lit("mine"))
    got = {r.doc_id: (r.doc_id, r.text, r.n_lines, r.n_dropped) for r in ld.dedup_lines(df).collect()}
    assert got == {w[0]: w for w in brute([d for d in docs])}


def test_documents(spark):
    """On the supplied documents: no line of a cleaned corpus is within the edits of another."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.collect()]
    lines = {x for _, t in docs for x in (t or "").split("\n") if len(x) >= ld.MIN_CHARS}
    out = ld.dedup_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_dropped"]
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(docs)
    kept = [x for r in got.values() for x in (r.text or "").split("\n") if len(x) >= ld.MIN_CHARS]
    assert len(kept) == len(set(kept)) and set(kept) <= lines
    by_length = {}
    for x in kept:
        by_length.setdefault(len(x), []).append(x)
    for n, some in by_length.items():
        for a in some:
            for m in range(n, n + 3):
                assert not any(a is not b and a[:9] == b[:9] and distance(a, b) <= 2 for b in by_length.get(m, []))


def test_edge_rows(edge_docs, empty_docs):
    got = ld.dedup_lines(edge_docs).collect()
    assert sorted(r.doc_id for r in got) == [1, 2, 3, 4, 5, 6, 6, 7, 8]
    by = {r.doc_id: r for r in got}
    assert by[1].text is None and by[2].text == "" and len(by[4].text) == 180_000 and by[3].n_dropped == 0
    assert ld.dedup_lines(empty_docs).count() == 0


def test_names_and_ids_of_any_kind(spark):
    text = "a line that is long enough to be compared\nown words of the first"
    rows = [("b", text, "x", 1), ("a", text, "y", 2), (None, text, "z", 3)]
    df = spark.createDataFrame(rows, "doc_id string, text string, drop string, place int")
    got = {r.doc_id: r for r in ld.dedup_lines(df, short_repeats=True).collect()}
    assert (got["a"].text, got["a"].drop, got["b"].n_dropped, got[None].n_dropped) == (text, "y", 2, 2)
