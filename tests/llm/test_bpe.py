import hashlib
import random
from array import array

import public_tokenizers
import pytest
from lakeledger.llm import bpe
from lakeledger.llm.queries import op8_bpe
from pyspark.sql import functions as F
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocab():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Vocabulary(f.read())


def ids(vocab, text):
    return list(array("I", vocab.encode(text)))


def test_same_ids_as_the_library(library, vocab):
    rng = random.Random(4)
    alphabet = ["a", "bq", "'s", "'ll", " ", "  ", "\n", "\t", "é", "\U0001F600", " ", "1", "23", "!", "<|endoftext|>", "<|endof",
                "\x00", "中", "word", "Word", "​", "\x1c", "\x85"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    texts += ["a" * 5000, "ab" * 3000, "é" * 2000, " " * 1000, "no-space" * 2000, "", "qz" * 30 + "!?" * 30]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert ids(vocab, text) == want.ids, text
        assert vocab.decode(vocab.encode(text)) == library.decode(want.ids, skip_special_tokens=False)


def test_every_character(library, vocab):
    texts = [f"a{c}b {c}{c}  x{c} 1{c}2 .{c}. {c}\n {c} " for c in map(chr, [*range(0xD800), *range(0xE000, 0x20000, 3)])]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert ids(vocab, text) == want.ids, text


def test_cuts_are_certain(vocab):
    """No token holds a certain pair, and fragments put together are the piece."""
    assert not any(a * 256 + b in vocab.certain for t in vocab.id_of for a, b in zip(t, t[1:]))
    for piece in (b" bqueasy", b"hxhxhx", bytes(range(256))):
        parts = vocab.fragments(piece)
        assert b"".join(parts) == piece and len(parts) > 1


def test_forgetting_changes_nothing(vocab, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    text = "the cat sat on the mat the cat sat on the mat again and again"
    own = bpe.Remembered(vocab.piece_ids)
    want = vocab.encode(text)
    assert b"".join(own[p] for p in vocab.pieces(text) * 3) == want * 3 and len(own) <= 3


def test_frames(spark, library, edge_docs, empty_docs):
    vocab = bpe.load(spark, PATH)
    texts = {(r.doc_id, r.text) for r in edge_docs.collect()}
    coded = bpe.encode(edge_docs.withColumn("ids", F.lit("mine")), vocab)
    assert "text" not in coded.columns and coded.schema["ids"].dataType.simpleString() == "binary"
    for r in coded.collect():
        want = next(t for i, t in texts if i == r.doc_id) or ""
        assert list(array("I", bytes(r.ids))) == library.encode(want, add_special_tokens=False).ids
    back = bpe.decode(coded, vocab)
    assert {(r.doc_id, r.text) for r in back.collect()} == {(i, t or "") for i, t in texts}
    assert bpe.decode(bpe.encode(empty_docs, vocab), vocab).count() == 0


def test_pieces_made_together(library, vocab, monkeypatch):
    """Fragments of all lengths merged in one go, with a memory that forgets on the way."""
    rng = random.Random(9)
    monkeypatch.setattr(bpe, "REMEMBERED", 200)
    words = ["".join(rng.choice("thearn_Xqz0é中") for _ in range(rng.randrange(1, 45))) for _ in range(4000)]
    texts = [" ".join(rng.sample(words, 30)) for _ in range(300)] + ["", "a" * 3000, "<|endoftext|>", "x<|endoftext|>  <|endoftext|>y", " " * 77]
    own, got = bpe.Vocabulary(vocab.text), []
    for at in range(0, len(texts), 50):
        got += own.encode_decode_all(texts[at:at + 50])
    for text, want, (ids, shown) in zip(texts, library.encode_batch(texts, add_special_tokens=False), got, strict=True):
        assert list(array("I", ids)) == want.ids and shown == library.decode(want.ids, skip_special_tokens=False)
    assert own.encode_decode_all([]) == [] and len(own.both.young[0]) < 4000


def test_every_character_together(library, vocab):
    texts = [f"a{c}b {c}{c}  x{c} 1{c}2 .{c}. {c}\n {c} " for c in map(chr, [*range(0xD800), *range(0xE000, 0x20000, 3)])]
    for text, want, (ids, _) in zip(texts, library.encode_batch(texts, add_special_tokens=False), vocab.encode_decode_all(texts)):
        assert list(array("I", ids)) == want.ids, text


def test_both_in_one_pass(spark, vocab, edge_docs, empty_docs):
    for text in ("the cat <|endoftext|> sat", "", "é" * 5000, "\x00\U0001F600", "a b  c\n\n"):
        assert vocab.encode_decode_all([text]) == [(vocab.encode(text), vocab.decode(vocab.encode(text)))]
    shared = bpe.load(spark, PATH)
    docs = edge_docs.withColumn("ids", F.lit("mine")).withColumn("a.b", F.lit(1))
    got = bpe.encode_decode(docs, shared)
    assert "text" not in got.columns and got.schema["ids"].dataType.simpleString() == "binary"
    want = {(r.doc_id, r.text or "") for r in edge_docs.collect()}
    assert {(r.doc_id, r.decoded) for r in got.collect()} == want and all(bytes(r.ids) == vocab.encode(r.decoded) for r in got.collect())
    assert bpe.encode_decode(empty_docs, shared).count() == 0


def test_query(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = op8_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs)
    for r in got:
        want = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(want) and r.ids_sha256 == hashlib.sha256(array("I", want).tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_what_a_worker_remembers_stays_small():
    table = bpe.Generations()

    def made(pieces):
        return [p.encode() for p in pieces], [p.encode() for p in pieces]

    for at in range(0, 400_000, 500):
        table.holding({f"piece{i}" for i in range(at, at + 500)}, made)
    assert sum(len(t) for g in (table.young, table.old) for t in g) <= 4 * 21_000
