"""Registered queries of this package; each runs its operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linklake.llm import (
    bpe, filter_audit, html_tree, jaccard, mtree, packing, pii, quality, resampling, substrings, token_counts, toxicity, warc_dictionary,
)
from linklake.llm.tables import ship, stored, table

RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encoded(table(spark, folder, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op2_site_style_tree(spark: SparkSession, folder: str) -> DataFrame:
    return html_tree.extracted(table(spark, folder, "pages"))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    rows = stored(docs.select("doc_id", quality.signals(F.col("text").cast("binary")).alias("s")), "signals")
    model = quality.fit(*quality.vote_frame(rows))
    posterior, kept = quality.verdict(model)
    s = F.col("s")
    return rows.select(
        "doc_id", s["n_words"].alias("n_words"), s["word_chars"].alias("word_chars"), s["n_symbols"].alias("n_symbols"),
        s["n_dup_lines"].alias("n_dup_lines"), s["n_repeat_words"].alias("n_repeat_words"),
        quality.base_failed(s).alias("base_failed"), kept.alias("kept"), posterior.alias("quality"),
    )


def op4_warc_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    return warc_dictionary.roundtrip(table(spark, folder, "pages"))


def op5_mtree_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return mtree.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.sequences(table(spark, folder, "documents"), public_tokenizers.path(WORD_BPE))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    features = toxicity.lexicon(docs, table(spark, folder, "labels"))
    seen = toxicity.looked_at(F.col("text"), features).alias("seen")
    rows = stored(docs.select(F.col("doc_id").alias("ident"), seen), "votes")
    score = toxicity.trained(rows, features).score(F.col("seen"))
    return rows.select(
        F.col("ident").alias("doc_id"), toxicity.held_out(F.col("ident")).alias("held_out"), score.alias("score"),
        (score >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.components(table(spark, folder, "documents"))


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.removals(table(spark, folder, "documents"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return token_counts.line_counts(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_pii_deobfuscation(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(pii.personal_data(table(spark, folder, "documents")))


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _shipped(f)
    for f in (
        op1_byte_bpe, op2_site_style_tree, op3_quality_rules, op4_warc_dictionary, op5_mtree_top_k, op6_best_fit_packing, op7_toxicity,
        op8_ngram_jaccard, op9_substring_dedup, op10_token_counts, op11_importance_resampling, op12_pii_deobfuscation, op13_filter_audit,
    )
}
