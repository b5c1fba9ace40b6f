"""op6_linededup: rows without an id, or with the same id and another text, are documents of their own."""

from lakeledger.llm import linededup as ld

HEADER = "a header that all of these documents begin with"


def test_documents_that_share_an_id(spark):
    rows = [(i, f"{HEADER}\n{what} alone has this line, which is long enough") for i, what in
            ((None, "first"), (None, "another"), (7, "seventh"), (7, "second of the sevens"))]
    twice = (8, "this text and its id stand in two rows, which are one document")
    got = ld.dedup_lines(spark.createDataFrame([*rows, twice, twice], "doc_id long, text string")).collect()
    assert sum(HEADER in r.text for r in got) == 1 and sum(r.n_dropped for r in got) == 3
    assert any(r.doc_id == 7 and HEADER in r.text for r in got)
    assert [r.text for r in got if r.doc_id == 8] == [twice[1]] * 2
