import zlib

import numpy as np
from lakeledger.llm import langid
from lakeledger.llm.queries import op10_langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: (r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op10_langid(spark, SF).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id][1] for r in held) >= 0.97 * len(held)


def test_codewords_correct_errors():
    code = langid.codewords(4)
    assert code.shape == (4, 7) and min((code[i] != code[j]).sum() for i in range(4) for j in range(i)) == 4
    big = langid.codewords(30)
    assert min((big[i] != big[j]).sum() for i in range(30) for j in range(i)) >= 15
    assert (np.abs(big.sum(0)) < 30).all()


def test_a_wrong_bit_is_corrected():
    counts = {x: np.ones(langid.DIMS) for x in "abcd"}
    for i, x in enumerate("abcd"):
        counts[x][langid.places("abcd"[i] * 9)] += 1000
    model = langid.Model(counts)
    for x in "abcd":
        assert model.predict(x * 30)[0] == x
    model.weights[:, 0] *= -1  # one classifier is wrong throughout
    model.weights[:, 0] /= 10
    assert all(model.predict(x * 30)[0] == x for x in "abcd")


def test_edges(spark, edge_docs, empty_docs):
    model = langid.fit(edge_docs)
    assert model.languages == ["de", "en", "fr"]
    got = {r.doc_id: r for r in langid.identify(edge_docs, model).collect()}
    assert len(got) == 8 and [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3
    assert [got[i].lang_pred for i in (4, 5, 6, 7)] == ["en", "de", "de", "fr"] and got[8].lang_pred != "und"
    assert got[4].text is not None and got[1].score == 0.0
    assert langid.identify(empty_docs, model).count() == 0
    none = langid.fit(empty_docs)
    assert {r.lang_pred for r in langid.identify(edge_docs, none).collect()} == {"und"}
    one = langid.fit(edge_docs.where("lang = 'de'"))
    assert {r.lang_pred for r in langid.identify(edge_docs, one).collect()} == {"und", "de"}


def test_other_columns_are_no_input(spark, edge_docs):
    model = langid.fit(edge_docs)
    a = langid.identify(edge_docs.select("doc_id", "text"), model).collect()
    b = langid.identify(edge_docs.selectExpr("doc_id", "text", "'fr' AS lang", "'x' AS source"), model).collect()
    assert [(r.doc_id, r.lang_pred, r.score) for r in a] == [(r.doc_id, r.lang_pred, r.score) for r in b]


def test_rare_languages_and_null_ids(spark, tmp_path):
    rare = [(900_000 + i, "zyx wvu zyx " * 5, "xx") for i in range(3)]
    df = spark.range(30_000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'der die und ', 'the and of ') || id AS text", "IF(id % 3 = 0, 'de', 'en') AS lang")
    df = df.union(spark.createDataFrame(rare, df.schema))
    model = langid.fit(df, max_rows=200)
    assert model.languages == ["de", "en", "xx"] and model.predict("zyx wvu zyx wvu")[0] == "xx"
    rows = [(None, "the and of the", "en", "a", 0), (1, "der die und", "de", "a", 0), (2, "the of and", "en", "a", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, `n.chars` int").write.parquet(f"{tmp_path}/documents.parquet")
    got = op10_langid(spark, str(tmp_path)).collect()
    assert len(got) == 3 and [r.held_out for r in got if r.doc_id is None] == [False]
