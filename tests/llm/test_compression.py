import zlib

import pytest
from lakeledger.llm import compression
from lakeledger.llm.queries import op11_compression

SF = "/root/testdata/sf0.1"


def auc(pairs):
    """Share of (1, 0) pairs in the right order, from sorted ranks."""
    pairs = sorted(pairs)
    ones = sum(y for _, y in pairs)
    return (sum(n for n, (_, y) in enumerate(pairs) if y) - ones * (ones - 1) / 2) / (ones * (len(pairs) - ones))


def test_held_out_quality(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = op11_compression(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    assert all(r.predicted == (r.score >= 0.3) for r in got)
    held = [(r.score, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 500 and auc(held) > 0.99
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert sum(s >= 0.3 for s in good) >= 0.99 * len(good) and sum(s < 0.3 for s in bad) >= 0.9 * len(bad)
    # Calibrated: in each part of the scale, about so many are good as the scores say.
    for low, high in ((0.0, 0.5), (0.5, 1.01)):
        part = [(s, y) for s, y in held if low <= s < high]
        assert abs(sum(s for s, _ in part) - sum(y for _, y in part)) < 0.06 * len(part) + 3


def test_the_whole_text_counts(spark):
    good, bad = ("the cat sat on a mat and saw the dog " * 3), "$$$ BUY!! NOW%%% ### "
    docs = [(i, good + f"word{i} " * (1 + i % 7)) for i in range(40)] + [(100 + i, bad * (2 + i % 5) + f"X{i}") for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in docs], "doc_id long, quality int")
    model = compression.fit(frame, labels)
    assert model.score((good * 200 + bad * 2000).encode()) < model.score((good * 200).encode())
    assert model.score(b"$$$ SELL!! LATER%%% ### " * 3) < 0.3 < model.score(b"the dog sat on the cat and saw a mat and a dog")


def test_edges(spark, edge_docs, empty_docs):
    marks = [(4, 1), (5, 1), (6, 0), (7, 0), (8, 1), (8, 0), (2, 0), (None, 1), (1, 1), (5, 1), (99, 0), (3, 7), (4, None)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    model = compression.fit(edge_docs, labels)
    assert model.share == pytest.approx(4 / 9)  # 4, 5, 1 good; 6, 7, 2, 99 bad; 8 is both
    got = compression.score(edge_docs, model).collect()
    assert len(got) == 9 and {r.score for r in got if r.doc_id in (1, 2)} == {model.share}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got) and got[0].kept == "x"
    assert len({r.score for r in got if r.doc_id in (5, 6)}) == 1  # equal texts
    assert compression.score(empty_docs, model).count() == 0
    for none in (labels.where("false"), labels.where("quality = 1"), labels.where("doc_id IN (1, 2)")):
        flat = compression.fit(edge_docs, none)
        assert {r.score for r in compression.score(edge_docs, flat).collect()} == {flat.share} and 0 < flat.share < 1
    odd = edge_docs.withColumnRenamed("shard", "a.b").withColumn("__text", edge_docs["lang"])
    assert compression.score(odd, model).select("`a.b`", "predicted").count() == 9


def test_labels_and_ids_are_no_input(spark):
    docs = spark.createDataFrame([(i, "good words here " * 9 if i % 2 else "BAD!! " * 20) for i in range(20)], "doc_id long, text string")
    model = compression.fit(docs, docs.selectExpr("doc_id", "int(doc_id % 2) AS quality"))
    assert len({(r.text, r.score) for r in compression.score(docs, model).collect()}) == 2
