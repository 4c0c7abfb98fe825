"""The registered queries of this package; each derives the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verisift.llm import (
    byte_bpe,
    decontaminate,
    lang_id,
    line_dedup,
    lm_score,
    minhash,
    prefix_trie,
    quality_rules,
    source_mix,
    substring,
    token_counts,
    topk,
    whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes(F.col("failure_bits"), "base-1")).alias("base_failed"),
        quality_rules.passes(F.col("failure_bits"), "full-1").alias("kept"),
        "failure_bits",
    )


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = source_mix.plan(table(spark, sf_dir, "documents"))
    return planned.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.transcode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, keep=["doc_id"])
    return coded.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    stored = token_counts.prefix_store(
        sized, public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id", "n_bytes"]
    )
    return stored.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"), lm_score.fold_of("doc_id"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.decisions(table(spark, sf_dir, "documents"))


def op8_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", lang_id.fold("doc_id", 5) == 0)
    idf, fitted = lang_id.train(docs.filter("NOT held_out").select("doc_id", "text", "lang"))
    found = lang_id.predict(docs, idf, fitted)
    return found.select("doc_id", (lang_id.fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "rejected")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.components_of(table(spark, sf_dir, "documents"), width=3, num=85, den=100)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removal_digests(table(spark, sf_dir, "documents"), window=35)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.nodes(table(spark, sf_dir, "conversations"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.findings(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated")
    )


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    fitted = whitening.fit(vectors).first(32)
    error = whitening.identity_error(vectors, fitted)
    explained = F.array(*[F.lit(float(e)) for e in fitted.explained]).cast("array<double>")
    return whitening.whiten(vectors, fitted).select(
        "vec_id", F.col("deviation").cast("long").alias("deviation"), F.posexplode("whitened").alias("at", "whitened")
    ).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_source_mix": op2_source_mix,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_token_counts": op4_token_counts,
    "op5_topk_search": op5_topk_search,
    "op6_lm_score": op6_lm_score,
    "op7_line_dedup": op7_line_dedup,
    "op8_lang_id": op8_lang_id,
    "op9_minhash": op9_minhash,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_decontaminate": op12_decontaminate,
    "op13_embedding_whitening": op13_embedding_whitening,
}
