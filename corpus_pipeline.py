"""Cleaning of ``documents`` in stages: each takes (spark, docs, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from seisma.llm import bpe, decontaminate, line_dedup, ngram_join, toxicity
from seisma.llm.registry import tokenizer_path
from seisma.llm.tables import table
from seisma.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents whose P(toxic) reaches one half go."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one line of each group of similar lines stays; n_chars follows the text.

    A document all of whose content stands in earlier documents goes; one that was empty before stays.
    """
    kept = line_dedup.dedup(docs, report="__dropped")
    kept = kept.where(F.col("__dropped").isNull() | F.col("text").rlike(r"(?U)[^\s\x1c-\x1f]"))  # blank as in line_dedup.fold
    columns = [F.length("text").cast(docs.schema["n_chars"].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return kept.select(columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of documents linked at five words and similarity 0.8 the smallest doc_id stays."""
    return ngram_join.keep_one(docs, ngram=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents in which a benchmark window occurs go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: digests of each document's ids and of the text decoded from them."""
    return bpe.digests(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", tokenize),
]

#: The trained classifier and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again before the next stage."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            folder = scratch_path(spark, f"pipeline-{name}")
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
    return docs
