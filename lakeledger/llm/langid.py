"""Language identification by error-correcting output codes.

Every language gets a codeword of +1/-1 bits. For each bit a binary n-gram classifier is
trained that tells the languages with +1 from those with -1; a text's bits are predicted
as log-odds, and the codeword with the least total logistic loss against them wins, so a
bit counts by how sure it is, and single wrong bits are corrected. ``score`` is the
winner's share of exp(-loss) over all languages; a text is ``ambiguous`` when the runner-up
is close.

Features: hashed byte n-grams (2, 3 and 4 bytes) of the lower-cased text, with runs of
anything that isn't a letter of ASCII or part of a longer character as one space. The bit
classifiers are multinomial: languages of one side count alike, however many rows each
has, so a hot language doesn't drown the others.

Training reads a bounded sample (about ``max_rows`` rows, of each language alike); its
n-gram counts are added up in Spark, and the table of counts (languages x ``DIMS``) makes
the model, which is broadcast. Prediction is one pass over whole texts, no exchange.

Edge cases: null text or text without a letter: ``und``, score 0, ambiguous. No learnable
row: every text is ``und``. One language only: every text with a letter gets it, score 1.
Rows without language don't teach. Equal texts get equal answers. An empty table gives
an empty result. Input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.llm.common import by_place, col, others, small_batches

DIMS = 1 << 14
UNKNOWN = "und"
#: Two languages whose losses are nearer than this make a text ambiguous.
CLOSE = 2.0
#: n-grams that a text's evidence counts as at most: neighbouring n-grams overlap, so
#: the sum of their log-odds overstates what a long text proves.
EVIDENCE = 200.0

_LETTER = regex.compile(r"\p{L}")
_CLASS = np.full(256, 32, np.uint8)
_CLASS[0x61:0x7B] = np.arange(0x61, 0x7B)
_CLASS[0x80:] = np.arange(0x80, 0x100)


def places(text: str) -> np.ndarray:
    """Hashed places of all n-grams of a text."""
    raw = _CLASS[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    b = raw[np.r_[True, (raw[1:] != 32) | (raw[:-1] != 32)]].astype(np.uint32)
    grams, v = [], b
    for n in (2, 3, 4):
        if len(b) < n:
            break
        v = (v[:-1] << np.uint32(8)) | b[n - 1:]
        grams.append(((v + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(18))
    return np.concatenate(grams) if grams else np.zeros(0, np.uint32)


def codewords(languages: int, seed: int = 0) -> np.ndarray:
    """(languages, bits) of +1/-1. Up to 7 languages: every split into two sides, each
    once; beyond: the random code, of several, with the largest least distance."""
    if languages < 2:
        return np.ones((languages, 0))
    if languages <= 7:
        sides = np.arange(1, 1 << (languages - 1))
        return np.where((sides[None, :] >> np.arange(languages)[:, None]) & 1, 1.0, -1.0)
    rng, bits, best = np.random.default_rng(seed), int(np.ceil(15 * np.log2(languages))), None
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], size=(languages, bits))
        code[:, np.abs(code.sum(0)) == languages] *= np.where(np.arange(languages) % 2, 1.0, -1.0)[:, None]
        far = (bits - (code @ code.T - 2 * bits * np.eye(languages)).max()) / 2
        if best is None or far > best[0]:
            best = (far, code)
    return best[1]


class Model:
    """Languages, their codewords, and a weight per place and bit."""

    def __init__(self, counts: dict[str, np.ndarray], smooth: float = 0.5):
        self.languages = sorted(counts)
        self.code = codewords(len(self.languages))
        share = np.stack([(counts[x] + smooth) / (counts[x].sum() + smooth * DIMS) for x in self.languages]) if counts else np.ones((0, DIMS))
        self.weights = np.stack(
            [np.log(share[bit > 0].mean(0)) - np.log(share[bit < 0].mean(0)) for bit in self.code.T], axis=1
        ) if self.code.shape[1] else np.zeros((DIMS, 0))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or not text or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        at = places(text)
        odds = np.bincount(at, minlength=DIMS) @ self.weights * (min(1.0, EVIDENCE / len(at)) if len(at) else 0.0)
        loss = np.logaddexp(0.0, -self.code * odds).sum(1)
        order = np.argsort(loss, kind="stable")
        share = np.exp(loss[order[0]] - loss)
        return self.languages[order[0]], float(1.0 / share.sum()), bool(loss[order[1]] - loss[order[0]] < CLOSE)


def fit(labelled: DataFrame, *, text: str = "text", lang: str = "lang", key: str = "doc_id", max_rows: int = 20_000,
        seed: int = 0) -> Model:
    """A model from the rows with a text and a language; about ``max_rows`` of them (by a
    hash of ``key``), as many of each language as it has and its part of them allows: the
    fit's cost doesn't grow with the table, and a rare language is learned all the same."""
    known = labelled.select(col(key).alias("key"), col(text).alias("text"), col(lang).cast("string").alias("lang")).where(
        "lang IS NOT NULL")
    rows = known.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))  # one row a language
    each = F.ceil(F.lit(float(1 << 30)) * F.least(F.lit(1.0), F.lit(max_rows / max(rows.count(), 1)) / F.col("rows")))
    sample = known.join(F.broadcast(rows.select("lang", each.alias("below"))), "lang").where(
        F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(1 << 30)) < F.col("below"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for t, x in zip(batch.column(0), batch.column(1)):
                if (s := t.as_py()) and _LETTER.search(s):
                    sums.setdefault(x.as_py(), np.zeros(DIMS, np.int64))
                    sums[x.as_py()] += np.bincount(places(s), minlength=DIMS)
        for x, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])], names=["lang", "place", "n"])

    found = (sample.select("text", "lang").mapInArrow(count, "lang string, place int, n long")
             .groupBy("lang", "place").agg(F.sum("n").alias("n")).toPandas())  # languages x DIMS rows at most
    counts = {}
    for x, part in found.groupby("lang"):
        counts[x] = np.zeros(DIMS)
        counts[x][part["place"].to_numpy()] = part["n"].to_numpy()
    return Model(counts)


def identify(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``ambiguous``; only the text is looked at."""
    out = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
    keep = others(docs, [f.name for f in out])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in small_batches(batches):
            langs, scores, doubts = [], [], []
            for t in batch.column(batch.num_columns - 1):
                a, b, c = own.predict(t.as_py())
                langs.append(a), scores.append(b), doubts.append(c)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(doubts, pa.bool_())],
                names=[*keep, *(f.name for f in out)])

    schema = T.StructType([*(docs.schema[c] for c in keep), *out])
    return by_place(docs.select(*[col(c) for c in keep], col(text).alias("__text"))).mapInArrow(run, schema)
