import hashlib
from array import array
from collections import defaultdict

import corpus_pipeline
import public_tokenizers
import test_linededup_short
import test_mixing
import test_neardup
import test_quality
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def rows(df):
    return [(r.doc_id, r.text, r.source, r.n_chars) for r in df.collect()]


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, got = docs.columns, [rows(docs)]
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = frames[name] = spark.read.parquet(path)
        if name != "tokens":
            assert docs.columns == columns
            got.append(rows(docs))
    given, good, cleaned, single, mixed = got
    assert sorted(good) == sorted(r for r in given if not test_quality.rejected(r[1]))
    want = {i: t for i, (t, _, _) in test_linededup_short.brute_all([r[:2] for r in good]).items()}
    assert {r[0]: r[1] for r in cleaned} == want and all(r[3] == len(r[1]) for r in cleaned)
    linked = test_neardup.brute([r[:2] for r in cleaned], 5, 80)
    assert sorted(r[0] for r in single) == sorted(i for i, (_, least) in linked.items() if i == least)

    source, size, taken = {r[0]: r[2] for r in single}, {r[0]: len(test_neardup.words_of(r[1])) for r in single}, defaultdict(int)
    sums, largest = defaultdict(int), defaultdict(int)
    for i, n in size.items():
        sums[source[i]] += n
        largest[source[i]] = max(largest[source[i]], n)
    assert {r[:3] for r in mixed} <= {r[:3] for r in single}
    for r in mixed:
        taken[r[2]] += size[r[0]]
    for s, goal in test_mixing.brute_targets(sums, (3, 1, 2), 1.0, 2.0).items():
        assert abs(taken[s] - goal) <= largest[s]

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = {r[0]: r[1] for r in mixed}
    coded = frames["tokens"].collect()
    assert sorted(r.doc_id for r in coded) == sorted(r[0] for r in mixed)
    for r in coded:
        ids = library.encode(text[r.doc_id], add_special_tokens=False).ids
        assert bytes(r.ids) == array("I", ids).tobytes() and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_empty_and_edge_tables(spark, edge_docs, empty_docs, tmp_path):
    for n, docs in enumerate((empty_docs, edge_docs)):
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{n}-{name}")
            stage(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
        assert docs.count() == 0  # every edge row is short or repetitive
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, edge_docs, SF)
        assert {r.doc_id for r in out.collect()} <= set(range(1, 9)) and (name == "mix" or out.count() >= 7)
