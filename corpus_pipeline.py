"""From documents to packed token ids, stage by stage.

quality rules -> line dedup -> MinHash near-dedup -> source mix -> byte-level BPE. Every
stage but the last returns the columns of ``documents``; each is written as Parquet and read
again, so a lost executor costs one stage at most; the shuffle files of a stage go with it.

Defined results: NULL or blank texts fail the quality rules; a document that loses all its
lines stays as an empty text; rows with the same ``doc_id`` are kept or dropped together by
the near-dedup; the mix repeats or leaves out whole documents; further columns are carried to
the mix and dropped by the encoding; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verisift.llm import byte_bpe, line_dedup, minhash, quality_rules, source_mix
from verisift.session import stored

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return quality_rules.accept(docs, "full-1")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line equals or resembles."""
    return line_dedup.remove_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its runs of five words."""
    return minhash.deduplicate(docs, width=5, num=80, den=100)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by their target weights; a document appears as often as the mix takes it."""
    return source_mix.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids, and whether decoding them gives the text again."""
    coded = byte_bpe.round_trip(
        docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, keep=["doc_id", "lang", "source"]
    )
    return coded.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        "token_ids",
        "round_trip",
    )


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("source mix", mix),
    ("byte-level BPE", encode),
]

#: SQL has no byte-pair encoding; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return docs
