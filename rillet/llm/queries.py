"""Registered queries of this subpackage: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.llm import cutting_stock, decontam, html_template, lm_scoring, packing, quality, role_repair, secret_scan, simhash, spelling, substring_dedup, toxicity, url_data, url_filter
from rillet.sources.tables import table


def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op5_secret_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", simhash.hex_of().alias("fingerprint"), "component_id")


def op7_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents", "doc_id", "text"),
                          table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op8_temporal_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    found = url_filter.judge(url_data.captures(pages), url_data.entries(pages))
    return found.withColumn("fetched", F.date_format("fetched", "yyyy-MM-dd"))


def op9_gear_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of text that documents share; a passage's first place is marked as kept."""
    return substring_dedup.repeated_runs(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated documents with the benchmark items found in them."""
    return decontam.matches(table(spark, sf_dir, "documents", "doc_id", "text"),
                            table(spark, sf_dir, "benchmark", "item_id", "text"))


def op11_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences without padding."""
    return cutting_stock.pack(table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words with the form and the root that they are variants of."""
    return spelling.variants(table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations with their faults and their cheapest repair."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return role_repair.repair(role_repair.damage(turns))


QUERIES = {
    "op1_compression_bands": op1_compression_bands,
    "op2_context_tree": op2_context_tree,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_template_extraction": op4_template_extraction,
    "op5_secret_entropy": op5_secret_entropy,
    "op6_simhash": op6_simhash,
    "op7_ftrl_toxicity": op7_ftrl_toxicity,
    "op8_temporal_url_lists": op8_temporal_url_lists,
    "op9_gear_chunk_dedup": op9_gear_chunk_dedup,
    "op10_latent_decontamination": op10_latent_decontamination,
    "op11_cutting_stock": op11_cutting_stock,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_role_repair": op13_role_repair,
}

#: DuckDB SQL of the queries that SQL can express.
SQL: dict[str, str] = {
    "op5_secret_entropy": secret_scan.oracle(),
    "op8_temporal_url_lists": url_data.oracle(),
}
