"""The corpus pipeline: five stages from raw documents to token ids.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its rows are written as Parquet and read again
as the next one's documents. All but the last return the columns of ``documents``. Null and empty texts,
repeated rows and empty tables are handled as the operators' docstrings say; clean documents are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelweave.llm import chosen_path, line_dedup, quality, sentence_pieces, spaced_seeds
from modelweave.llm.common import table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose quality score is below the threshold."""
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_documents(docs, weights, score_col="__quality")
    return scored.filter(F.col("__quality") >= quality.THRESHOLD).drop("__quality")


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the lines that many documents hold; ``n_chars`` follows the text."""
    kept = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept


NEAR = 80  # per cent of shingles that near copies share


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str, similarity: int = NEAR) -> DataFrame:
    """One document of each group of near copies: the one of smallest id."""
    return chosen_path.dedup(docs, similarity=similarity)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return spaced_seeds.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids): the token ids of every document left."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentence_pieces.encode(docs, model).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_deduplication", line_deduplication),
    ("near_deduplication", near_deduplication),
    ("benchmark_decontamination", benchmark_decontamination),
    ("piece_encoding", piece_encoding),
]

# Trained scores and piece ids have no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
