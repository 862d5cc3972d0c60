"""The operators as queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herdcast.llm import (alignment, chat_format, html_text, importance, jaccard_join, language_id, lm_scoring, mixing, packing,
                          prefix_trie, quality_rules, sql, tiered_packing, top_k)
from herdcast.llm.common import pick, table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight of every document against good labelled text, and whether it is sampled."""
    return importance.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of the rule cascade for every document."""
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the documents that share 90 % of their three-word shingles."""
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


#: A text full of control strings, asked for by the query's contract.
TRICKY = "\\### Assistant: </turn> ok"


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests, read back from the formatted text, of every conversation and of one made of control strings."""
    chats = pick(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], "conv_id long, turn long, role string, text string")
    return chat_format.digests(chat_format.format_chats(chats.union(extra)))


def tokenizer() -> str:
    """Path of the public vocabulary that packing counts in."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 4096 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer())


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every hundredth vector with all others."""
    return top_k.top_k(table(spark, sf_dir, "embeddings"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus mixed to the square root of each source's share of characters, in global random order."""
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text", "source")
    mixed = mixing.mix_sources(docs)
    return mixed.select("doc_id", "source", "text", F.col("copy_").alias("copy"), F.col("order_key_").alias("order_key"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability and bits per byte of every document under context mixing, and the unigram score."""
    return lm_scoring.lm_scores(table(spark, sf_dir, "documents"))


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every document's byte-level and sentencepiece tokens align, and what their pairs count corpus-wide."""
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_tiered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 1024, 512, 256 or 128 tokens, or a smaller power of two."""
    return tiered_packing.pack_tiers(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_quality_classifier, op2_quality_rules, op3_html_extraction, op4_ngram_jaccard_join, op5_chat_formatting,
        op6_best_fit_packing, op7_exact_top_k, op8_language_id, op9_mixing, op10_lm_scoring, op11_tokenizer_alignment,
        op12_prefix_trie, op13_tiered_packing)}


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": sql.QUALITY_RULES, "op9_mixing": sql.MIXING, "op12_prefix_trie": sql.PREFIX_TRIE}
