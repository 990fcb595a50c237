"""Registered queries of the training-data operators: thin wrappers with production parameters.

Each reads its whole table, applies one operator and derives the digest columns from the
operator's real output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath.llm import alignment, html_text, oracles, quality, secrets, simhash, toxicity, url_rules
from clickpath.llm.common import table
from clickpath.llm.decontaminate import contamination
from clickpath.llm.licenses import licenses
from clickpath.llm.packing import pack_documents
from clickpath.llm.prefix_tree import prefix_tree
from clickpath.llm.token_counts import count_documents
from clickpath.llm.token_files import write_and_read

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
BYTE_END = 50256        # the tokenizer's own end-of-document id


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every whole text by diagonal voting."""
    return licenses(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written to context-mixed, range-coded files and read back."""
    return write_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 ids by minimum bin slack."""
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of whole texts, with the corpus-wide ownership of their values."""
    found = secrets.secrets(table(spark, sf_dir, "documents"))
    kinds = F.col("spans.kind")
    n_of = {k: F.size(kinds) - F.size(F.array_remove(kinds, k)) for k in secrets.BASE_KINDS}
    base = F.filter("spans", lambda s: s["kind"] != "live")
    return found.select("doc.doc_id", *(n.cast("long").alias(f"n_{k}") for k, n in n_of.items()),
                        F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda s: s["copied"])).cast("long").alias("n_copied"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics of whole texts and an isolation forest's verdict."""
    found = quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", *quality.COUNTS[:5], "base_failed", "kept", "score")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat token files by their separators."""
    counted = count_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER), BYTE_END)
    return counted.select("doc_id", "file", "start", "n_tokens")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints (3-word shingles) and components of pairs within 3 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("bits")).alias("fingerprint"), "component_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text by a lexicon learned from the rows not held out."""
    found = toxicity.toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), keep_text=False)
    return found.select("doc.doc_id", toxicity.held_out(F.col("doc.doc_id")).alias("held_out"), "score", "predicted")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside 13-word windows of benchmark items."""
    found = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), keep_text=False)
    return found.select("doc.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), "contaminated")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by tree scoring."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of two tokenizers' tokens of every whole text, and corpus-wide counts of their links."""
    a, b = public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(PIECE_MODEL)
    return alignment.align(table(spark, sf_dir, "documents"), a, b)


def op12_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations, with totals over its subtree."""
    return prefix_tree(table(spark, sf_dir, "conversations"))


def op13_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL by the stated rules and the library's patterns."""
    found = url_rules.judged(table(spark, sf_dir, "pages").select("page_id", "url"), url_rules.stated_rules(spark))
    return found.select("doc.page_id", "host", "path", "rule", "verdict")


QUERIES = {
    "op1_licenses": op1_licenses,
    "op2_token_files": op2_token_files,
    "op3_packing": op3_packing,
    "op4_secrets": op4_secrets,
    "op5_quality": op5_quality,
    "op6_token_counts": op6_token_counts,
    "op7_simhash": op7_simhash,
    "op8_toxicity": op8_toxicity,
    "op9_decontamination": op9_decontamination,
    "op10_html_extraction": op10_html_extraction,
    "op11_alignment": op11_alignment,
    "op12_prefix_tree": op12_prefix_tree,
    "op13_url_rules": op13_url_rules,
}

ORACLES = {
    "op1_licenses": oracles.LICENSES,
    "op9_decontamination": oracles.CONTAMINATION,
    "op12_prefix_tree": oracles.PREFIX_TREE,
    "op13_url_rules": oracles.URL_RULES,
}
