"""The training-data operators bound to the driver tables."""

from __future__ import annotations

import os
import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from seisma.llm import alignment, ann, bpe, decontaminate, line_dedup, merkle, ngram_join, pii, quality, sharding, token_files, toxicity, warc
from seisma.llm.oracle import ORACLE
from seisma.llm.tables import table
from seisma.session import scratch_path

END_ID = 2


def tokenizer_path() -> str:
    """The tokenizer file; SEISMA_TOKENIZER names another one."""
    import public_tokenizers

    return os.environ.get("SEISMA_TOKENIZER") or public_tokenizers.path("word_bpe_49k.json")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.responses(table(spark, sf_dir, "pages"))).drop("record")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), lambda i: F.pmod(i, F.lit(20)) == 0, 20)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), folder, tokenizer_path(), END_ID)
    return token_files.read_digests(spark, folder)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts of every document, the numbers of the lines that went, and the digest of the text that stays."""
    kept = line_dedup.dedup(table(spark, sf_dir, "documents"))
    lines = F.size(F.split("text", "\n", -1)).cast("bigint")
    dropped = F.coalesce(F.size("dropped_lines"), F.lit(0)).cast("bigint")
    return kept.select(
        "doc_id", F.when(F.coalesce(F.col("text"), F.lit("")) == "", 0).otherwise(lines).alias("n_kept"), dropped.alias("n_dropped"),
        F.coalesce("dropped_lines", F.array().cast("array<int>")).alias("dropped"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs over all documents; of those whose id's checksum 5 divides, the text is found lower-cased."""
    docs = table(spark, sf_dir, "documents")
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    return merkle.verify(merkle.build(merkle.leaves(docs, now={"text": lower}, when=tampered)))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


__all__ = ["END_ID", "ORACLE", "QUERIES", "tokenizer_path"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_toxicity": op2_toxicity,
    "op3_decontaminate": op3_decontaminate,
    "op4_sharding": op4_sharding,
    "op5_ann": op5_ann,
    "op6_token_files": op6_token_files,
    "op7_bpe": op7_bpe,
    "op8_pii": op8_pii,
    "op9_ngram_join": op9_ngram_join,
    "op10_line_dedup": op10_line_dedup,
    "op11_quality": op11_quality,
    "op12_merkle": op12_merkle,
    "op13_alignment": op13_alignment,
}

