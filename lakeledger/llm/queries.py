"""The registered queries of the operators: thin readers of the operators' outputs."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.llm import ann, bpe, chat, compression, langid, linededup, mixing, neardup, quality, sharding, urlfilter, whitening, zfast
from lakeledger.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

SHARDS = 40
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = sharding.shuffle_to_shards(docs, SHARDS)
    return placed.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sized = docs.select("doc_id", "source", mixing.n_words("text").alias("size"))
    mixed = mixing.mix(sized, text=None, weights=(3, 1, 2), share=1.5, cap=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op3_urlfilter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = urlfilter.filter_urls(pages, urlfilter.labels(spark), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op4_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality.judge(docs, measures=base)
    failed = F.expr(" OR ".join(r.sql(frozenset(base)) for r in quality.BASE))
    return judged.select("doc_id", *base, failed.alias("base_failed"), "kept", "failed_rule")


def op5_ann(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), 5, F.col("vec_id") % 50 == 0)


def op6_linededup(spark, sf_dir):
    return linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), short_repeats=True)


def op7_neardup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op8_bpe(spark, sf_dir, vocabulary: str | None = None):
    vocab = bpe.load(spark, vocabulary or public_tokenizers.path("byte_bpe_50k.json"))
    coded = bpe.encode_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocab)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op9_chat(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).selectExpr(
        "-1L AS conv_id", "id AS turn", "IF(id = 0, 'user', 'assistant') AS role", f"'{said}' AS text")
    return chat.read_back(chat.format_chats(turns.unionByName(own)))


def op10_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))  # no id: not held out
    model = langid.fit(docs.where(~held_out))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op11_compression(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = compression.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    return compression.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op12_whitening(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(rows, components=4).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def op13_zfast(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = zfast.positioned(turns)
    ids = rows.select("conv").distinct().selectExpr(
        "conv", "conv - conv % 100 AS base", "CAST(crc32(CAST(CAST(conv AS STRING) AS BINARY)) % 6 AS INT) AS head")
    return zfast.prefix_trie(zfast.with_heads(rows, ids), ids.select("conv"))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_mixing": op2_mixing,
    "op3_urlfilter": op3_urlfilter,
    "op4_quality": op4_quality,
    "op5_ann": op5_ann,
    "op6_linededup": op6_linededup,
    "op7_neardup": op7_neardup,
    "op8_bpe": op8_bpe,
    "op9_chat": op9_chat,
    "op10_langid": op10_langid,
    "op11_compression": op11_compression,
    "op12_whitening": op12_whitening,
    "op13_zfast": op13_zfast,
}
