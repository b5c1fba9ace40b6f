"""Exact repeats of lines too short for the edit join: op6_linededup and the stage ``lines``."""

import corpus_pipeline
from lakeledger.llm import linededup as ld
from lakeledger.llm.queries import op6_linededup
from test_linededup import brute

SF = "/root/testdata/sf0.001"


def brute_all(docs):
    """``brute``, after which every later place of a short non-blank line goes."""
    order = lambda i: (i is None, i or 0)
    first = {}
    for i, t in docs:
        for n, line in enumerate(t.split("\n") if t is not None else []):
            first[line] = min(first.get(line, (order(i), n)), (order(i), n))
    long = {i: (t, n, dropped) for i, t, n, dropped in brute(docs)}
    out = {}
    for i, t in docs:
        cleaned, n, _ = long[i]
        if t is None:
            out[i] = (None, 0, 0)
            continue
        stays = iter(cleaned.split("\n"))
        ahead, kept = next(stays, None), []
        for k, line in enumerate(t.split("\n")):
            short = len(line) < ld.MIN_CHARS
            if short or line == ahead:
                ahead = next(stays, None)
                if not short or not line.strip() or first[line] == (order(i), k):
                    kept.append(line)
        out[i] = ("\n".join(kept), n, n - len(kept))
    return out


ROWS = [(3, "All rights reserved.\nown words of three\n\n  \nAll rights reserved."), (1, "one\nAll rights reserved.\n\n  "), (2, "one\none"),
        (4, None), (5, ""), (None, "own words of three\n}"), (6, "own words of three\n{\nAll rights reserved\n" + "x" * 40), (7, "x" * 41 + "\n" + "x" * 40)]


def test_short_repeats(spark):
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped)
           for r in ld.dedup_lines(spark.createDataFrame(ROWS, "doc_id long, text string"), short_repeats=True).collect()}
    assert got == {
        1: ("one\nAll rights reserved.\n\n  ", 4, 0), 2: ("", 2, 2), 3: ("own words of three\n\n  ", 5, 2), 4: (None, 0, 0), 5: ("", 1, 0),
        6: ("{\nAll rights reserved\n" + "x" * 40, 4, 1), 7: ("", 2, 2), None: ("}", 2, 1)}
    assert got == brute_all(ROWS)


def test_query_and_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_all([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in op6_linededup(spark, SF).collect()} == want
    staged = corpus_pipeline.drop_lines(spark, docs, SF).collect()
    assert {r.doc_id: r.text for r in staged} == {i: t for i, (t, _, _) in want.items()}
    stood = [x for r in staged for x in (r.text or "").split("\n") if x.strip()]
    assert len(stood) == len(set(stood))
