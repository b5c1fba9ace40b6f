"""The corpus pipeline: stages applied one after the other to ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's documents. Every stage works on all rows its
predecessor kept and calls one operator of ``lakeledger.llm``:

- quality: documents that a quality rule rejects go;
- lines: repeated lines go (first place in the corpus stays), ``n_chars`` follows;
- near_duplicates: of each group linked by five-word shingles at 0.8 one document stays;
- mix: sources are mixed to weights 3, 1, 2, ... over as many words as there are, none
  beyond twice its own; a document taken twice is two rows, one not taken is none;
- tokens: texts become token ids; the digest of the decoded text shows the round trip.

Edge cases are those of the operators: a document without a text is rejected by the
first stage, so later stages see texts; rows that share an id are told apart by their
texts, so unlinked ones both stay; empty tables pass through empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.llm import bpe, linededup, mixing, neardup, quality
from lakeledger.llm.common import col
from lakeledger.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def docs_only(result: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` (an operator's column of the same name takes its place)."""
    return result.select(*[col(c) for c in docs.columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return docs_only(quality.judge(docs).where("kept"), docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = linededup.dedup_lines(docs, short_repeats=True)
    return docs_only(cleaned.withColumn("n_chars", F.length("text").cast("long")), docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return docs_only(neardup.drop_near_duplicates(docs, words=5, percent=80), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs, weights=(3, 1, 2), share=1.0, cap=2.0)
    taken = mixed.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return docs_only(taken, docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocab = bpe.load(spark, public_tokenizers.path("byte_bpe_50k.json"))
    coded = bpe.encode_decode(docs.select("doc_id", "lang", "source", "text"), vocab)
    return coded.select(
        "doc_id", "lang", "source", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.length("decoded").cast("long").alias("decoded_chars"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("lines", drop_lines),
    ("near_duplicates", drop_copies),
    ("mix", mix_sources),
    ("tokens", to_tokens),
]

#: SQL can't state these stages; tests/llm holds them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
