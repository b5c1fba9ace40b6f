"""Quality classifier by compression: zstandard dictionaries of good and of bad text.

A text is cut into pieces of ``PIECE`` bytes, and each piece is compressed with a dictionary
trained on good labelled text and with one trained on bad; sizes add up over all pieces, so
a text of any length is judged whole and the dictionaries count at its end as at its start.
The normalised difference (bad - good) / (bad + good) says which text it resembles; the
mean size a byte says how much the text repeats itself, whatever either dictionary holds.
Both are taken twice: of the bytes, and of their shape (small letters, capitals and digits
each as one sign), which knows signs and capitals in words never seen.

A logistic curve turns these four numbers into the odds of label 1. It is fitted on
labelled documents by dictionaries that haven't seen them (``FOLDS`` parts, each compressed
with the dictionaries of the others), weighted back to the labels' real shares.

The fit reads a bounded sample: up to ``max_rows`` labelled ids of each class and
``max_pieces`` of their distinct pieces, by hash. Dictionaries (1 MB in all) are broadcast;
scoring is one pass over whole texts without an exchange.

Edge cases: a null or empty text has the labels' share of 1 as its score. With no label, or
labels of one class, or no text in one of them, every score is that share (one row of each
class is added to it, so it is never 0 or 1). An id labelled both 0 and 1 isn't learned; a
label repeated counts once; other labels and null ids don't count. Rows of documents that
share a labelled id are all learned from. Equal texts get equal scores. An empty table
gives no rows. Columns named like an output column are replaced; others stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.llm.common import by_place, col, others, small_batches, staged

PIECE = 1024
DICTIONARY = 256 << 10  # bytes, for each class and view
SEGMENT, GRAM = 32, 8  # of the dictionary builder: what repeats is taken over in short stretches
LEVEL = 3
FOLDS = 4
#: Signs of a byte's shape; bytes of longer characters count as small letters.
SHAPE = bytes(97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))
VIEWS = (bytes, lambda b: b.translate(SHAPE))


def cut(text: bytes) -> list[bytes]:
    return [text[at:at + PIECE] for at in range(0, len(text), PIECE)]


def dictionary(pieces: list[bytes]) -> bytes:
    """Dictionary content; what is too little for the builder is taken as it is."""
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces, k=SEGMENT, d=GRAM).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY:]


class Compressors:
    """One compressor for each (view, class), built where it is first used."""

    def __init__(self, contents: list[list[bytes]]):
        self.contents = contents
        self.own = None

    def __getstate__(self):
        return {"contents": self.contents, "own": None}

    @classmethod
    def of(cls, pieces: dict[int, list[bytes]]) -> Compressors:
        """Dictionaries of the pieces of class 0 and 1."""
        return cls([[dictionary([view(p) for p in pieces[c]]) for c in (0, 1)] for view in VIEWS])

    def measures(self, text: bytes) -> list[float]:
        if self.own is None:
            flags = {"write_content_size": 0, "write_checksum": 0, "write_dict_id": 0}
            how = zstandard.ZstdCompressionParameters.from_level(LEVEL, **flags)
            self.own = [[zstandard.ZstdCompressor(compression_params=how, dict_data=zstandard.ZstdCompressionDict(d)) for d in pair]
                        for pair in self.contents]
        out = []
        for view, pair in zip(VIEWS, self.own):
            pieces = cut(view(text))
            bad, good = (sum(len(c.compress(p)) for p in pieces) for c in pair)
            out += [(bad - good) / (bad + good), np.log((bad + good) / (2 * len(text)))]
        return out


@dataclass
class Curve:
    """Logistic curve over standardised measures, held within what the fit has seen."""

    low: np.ndarray
    high: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> Curve:
        low, high = np.quantile(x, 0.01, axis=0), np.quantile(x, 0.99, axis=0)
        x = np.clip(x, low, high)
        mean, spread = x.mean(0), x.std(0) + 1e-9
        a = np.column_stack([np.ones(len(x)), (x - mean) / spread])
        w = np.zeros(a.shape[1])
        penalty = np.diag([1e-6, *[ridge] * x.shape[1]])
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + penalty, a.T @ (weight * (p - y)) + penalty @ w)
            w -= np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-9:
                break
        return cls(low, high, mean, spread, w)

    def __call__(self, measures) -> float:
        x = (np.clip(measures, self.low, self.high) - self.mean) / self.spread
        return float(1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -30, 30))))


@dataclass
class Model:
    share: float  # of label 1
    compressors: Compressors | None = None
    curve: Curve | None = field(default=None)

    def score(self, text: bytes | None) -> float:
        return self.curve(self.compressors.measures(text)) if text and self.curve else self.share


def fit(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "quality",
        max_rows: int = 4_000, max_pieces: int = 16_000, seed: int = 0) -> Model:
    """A model from the documents whose ids ``labels`` marks 0 or 1."""
    spark = docs.sparkSession
    known = (labels.select(col(id).alias("id"), col(label).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
             .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").select("id", "label"))
    rows = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = (rows.get(1, 0) + 1) / (sum(rows.values()) + 2)
    if len(rows) < 2:
        return Model(share)
    by_hash = known.withColumn("h", F.xxhash64(F.lit(seed), "id"))
    chosen = by_hash.where("label = 0").orderBy("h", "id").limit(max_rows).union(by_hash.where("label = 1").orderBy("h", "id").limit(max_rows))
    chosen = chosen.withColumn("fold", F.pmod("h", F.lit(FOLDS)).cast("int")).drop("h")
    texts = docs.select(col(id).alias("id"), col(text).cast("binary").alias("text")).where("octet_length(text) > 0")
    sample = staged(texts.join(F.broadcast(chosen), "id").select("label", "fold", "text"), "compression-sample")  # 2 * max_rows ids

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 64):
            made = [(a.as_py(), b.as_py(), p) for a, b, t in zip(*batch.columns) for p in cut(t.as_py())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([m[0] for m in made], pa.int32()), pa.array([m[1] for m in made], pa.int32()),
                 pa.array([m[2] for m in made], pa.binary())], names=["label", "fold", "piece"])

    cuts = sample.mapInArrow(cut_up, "label int, fold int, piece binary").distinct().withColumn("h", F.xxhash64("piece"))
    pieces = {c: [(r.fold, bytes(r.piece)) for r in cuts.where(F.col("label") == c).orderBy("h", "piece", "fold").limit(max_pieces).collect()]
              for c in (0, 1)}  # max_pieces * PIECE bytes each
    folds = [{c: [p for f, p in own if f != k] for c, own in pieces.items()} for k in range(FOLDS)]
    if not all(part[c] for part in folds for c in (0, 1)):
        folds = [{c: [p for _, p in own] for c, own in pieces.items()}] * FOLDS  # too few to hold some back
    if not all(folds[0].values()):
        return Model(share)
    shared = spark.sparkContext.broadcast([Compressors.of(part) for part in folds])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = [shared.value[b.as_py()].measures(t.as_py()) for b, t in zip(*batch.columns[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], names=["label", "x"])

    # Equal rows as one with their number: a hot id's rows don't fill the driver.
    seen = sample.mapInArrow(measure, "label int, x array<double>").groupBy("label", "x").count().orderBy("label", "x").collect()
    y, many = np.array([r["label"] for r in seen], float), np.array([r["count"] for r in seen], float)
    real = {c: rows[c] / many[y == c].sum() for c in (0, 1) if (y == c).any()}
    weight = many * np.array([real[c] for c in y])
    curve = Curve.fit(np.array([r["x"] for r in seen]), y, weight * len(y) / weight.sum())
    return Model(share, Compressors.of({c: [p for _, p in own] for c, own in pieces.items()}), curve)


def score(docs: DataFrame, model: Model, *, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; only the text is looked at."""
    out = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    keep = others(docs, [f.name for f in out])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = [shared.value.score(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.float64()), pa.array([int(s >= threshold) for s in found], pa.int32())],
                names=[*keep, *(f.name for f in out)])

    rows = docs.select(*[col(c) for c in keep], col(text).cast("binary").alias("__text"))
    return by_place(rows).mapInArrow(run, T.StructType([*(docs.schema[c] for c in keep), *out]))
