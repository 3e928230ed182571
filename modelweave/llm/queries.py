"""The registered queries of the subpackage: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelweave.llm.common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modelweave.llm.line_dedup import dedup_lines

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.coalesce("text", F.lit(""))
    return dedup_lines(docs, counts=True).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(kept.cast("binary"), 256).alias("kept_sha256")
    )


def op4_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from modelweave.llm.sentence_pieces import digests

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_license_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modelweave.llm.license_markup import scan

    return scan(table(spark, sf_dir, "documents"))


# Fixed rows: a conversation whose texts hold control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"
CONTROL_ROWS = [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)]


def op10_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modelweave.llm.reply_trees import format_conversations, read_back, threads

    given = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), "turn", "role", "text")
    control = spark.createDataFrame(CONTROL_ROWS, "conv_id long, turn long, role string, text string")
    formatted = format_conversations(threads(given.unionByName(control)))
    return read_back(formatted).withColumnRenamed("conv", "conv_id").drop("branch")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modelweave.llm.toxicity import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modelweave.llm.quality import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modelweave.llm.permutation_index import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op9_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modelweave.llm.spaced_seeds import leaks

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modelweave.llm.suffix_dedup import dedup_strings

    return dedup_strings(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modelweave.llm.chosen_path import components

    return components(table(spark, sf_dir, "documents"))


def op11_heap_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modelweave.llm.heap_clusters import cluster

    return cluster(table(spark, sf_dir, "embeddings"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from modelweave.llm.token_files import digests

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from modelweave.llm.dual_tree import compress

    return compress(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op4_sentence_pieces": op4_sentence_pieces,
    "op5_license_markup": op5_license_markup,
    "op10_reply_trees": op10_reply_trees,
    "op3_toxicity": op3_toxicity,
    "op7_quality": op7_quality,
    "op8_permutation_index": op8_permutation_index,
    "op9_spaced_seeds": op9_spaced_seeds,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op6_chosen_path": op6_chosen_path,
    "op11_heap_clusters": op11_heap_clusters,
    "op12_token_files": op12_token_files,
    "op13_dual_tree": op13_dual_tree,
}
