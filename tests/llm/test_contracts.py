"""The thin queries of sharding and mixing against Python, and rows without an id."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import test_mixing
from lakeledger.llm import ann, bpe, chat, mixing, quality
from lakeledger.llm.queries import op1_sharding, op2_mixing
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: (r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_op1_against_python(spark, documents):
    got = op1_sharding(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(documents) and {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    for r in got:
        raw = (documents[r.doc_id][0] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_op2_against_python(spark, documents):
    got = op2_mixing(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(documents)
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, (t, _) in documents.items()}
    sums, largest, taken = Counter(), Counter(), Counter()
    for i, (_, s) in documents.items():
        sums[s] += size[i]
        largest[s] = max(largest[s], size[i])
    targets = test_mixing.brute_targets(dict(sums), (3, 1, 2), 1.5, 2.0)
    for r in got:
        s = documents[r.doc_id][1]
        assert (r.size, r.source_size) == (size[r.doc_id], sums[s]) and abs(r.target - targets[s]) < 1e-6 * max(1, targets[s])
        assert 0 <= r.taken <= 2 * r.size and (not r.size or r.taken % r.size == 0)
        taken[s] += r.taken
    assert all(abs(taken[s] - targets[s]) <= largest[s] for s in sums)
    assert sorted(map(repr, op2_mixing(spark, SF).collect())) == sorted(map(repr, got))  # reruns agree


def test_rows_without_an_id_or_with_clashing_columns(spark):
    rng = random.Random(1)
    texts = [None, "", "one two", " ".join(rng.choice(["a", "bc", "def"]) + str(i % 9) for i in range(80))]
    rows = [(i, t, rng.choice(["s", None]), 7, "x") for i in (None, None, 3) for t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, target string")
    mixed = mixing.mix(docs, weights=(3, 1, 2), share=1.5, cap=2.0).collect()
    assert len(mixed) == len(rows) and all(0 <= r.copies <= 2 for r in mixed)
    assert sum(r.doc_id is None for r in quality.judge(docs).collect()) == 8
    import public_tokenizers

    coded = bpe.encode_decode(docs, bpe.load(spark, public_tokenizers.path("byte_bpe_50k.json"))).collect()
    assert sorted(r.decoded for r in coded) == sorted(t or "" for _, t, *_ in rows) and {r.target for r in coded} == {"x"}


def test_extra_columns_are_ignored(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi", "x", 1), (1, 1, "assistant", "ho", "y", 2)],
                                  "conv_id long, turn long, role string, text string, formatted string, n_turns int")
    plain = turns.select("conv_id", "turn", "role", "text")
    assert chat.format_chats(turns).select("conv_id").collect() == chat.format_chats(plain).select("conv_id").collect()
    assert chat.read_back(chat.format_chats(turns)).collect() == chat.read_back(chat.format_chats(plain)).collect()
    near = spark.createDataFrame([(i, [1.0, i / 9], "z", 1) for i in range(6)], "vec_id long, embedding array<double>, rank string, query_id int")
    assert (sorted(ann.nearest(near, 2, F.col("vec_id") == 0).collect())
            == sorted(ann.nearest(near.select("vec_id", "embedding"), 2, F.col("vec_id") == 0).collect()))
