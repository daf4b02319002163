"""The operators as registered queries: production parameters on whole tables, and the columns of their contracts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bestfit, codes, decontaminate, exact, html, language, lines, neardup, packing, quality, substring, tokens, trie
from .shared import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN)


def long_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return language.identify(documents, language.fit(documents))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), VOCABULARY)


def benchmark_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")


def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.keep_one(table(spark, sf_dir, "documents"))


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.groups(table(spark, sf_dir, "documents"), size=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.remove_lines(table(spark, sf_dir, "documents")).drop("kept_text")


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.score(documents, quality.fit(documents, table(spark, sf_dir, "labels")))


def conversation_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.rebuilt(table(spark, sf_dir, "conversations")))


def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))[0]


def fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack(table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": packed,
    "op2_substring_dedup": long_repeats,
    "op3_language": languages,
    "op4_token_counts": token_counts,
    "op5_decontamination": benchmark_items,
    "op6_exact_dedup": exact_copies,
    "op7_minhash_dedup": near_copies,
    "op8_html_text": page_texts,
    "op9_line_dedup": fuzzy_lines,
    "op10_quality": quality_scores,
    "op11_prefix_trie": conversation_prefixes,
    "op12_vector_codes": vector_codes,
    "op13_best_fit_packing": fitted,
}
EXPECTED: dict[str, str] = {
    "op2_substring_dedup": substring.ORACLE,
    "op5_decontamination": decontaminate.ORACLE,
    "op6_exact_dedup": exact.ORACLE,
    "op11_prefix_trie": trie.ORACLE,
    "op12_vector_codes": codes.ORACLE,
}
