"""Searches over stored structures: the inverted index of the wide table's item names (T1-T5),
highlight fragments of long texts (T4), deep pages (L2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.functions.text import best_fragment, fragments, highlight, match_any
from rillet.operators import inverted_index, paging
from rillet.operators.inverted_index import Index
from rillet.plans.orders import stored_wide
from rillet.plans.publisher import ANY_ITEM, FUZZY_TERM
from rillet.session import stored_once
from rillet.sources.tables import table

#: Search for fragments in the documents' texts.
FRAGMENT_QUERY = "the license de"
DEEP_SIZE = 20


def item_index(spark: SparkSession, sf_dir: str) -> Index:
    """The index of item names, as the order job would keep it."""
    wide = stored_wide(spark, sf_dir).select("detail_id", "sku_name")
    return Index(spark, stored_once(spark, "item-index", sf_dir, lambda path: inverted_index.build(
        wide, "detail_id", "sku_name", path)))


def _names(spark: SparkSession, sf_dir: str, hits: DataFrame, index: Index | None = None) -> DataFrame:
    """The hits' rows; ``index`` deals them by id, for hits of any number."""
    wide = stored_wide(spark, sf_dir).select("detail_id", "sku_name")
    if index is not None:
        wide = index.by_id(wide, "detail_id").hint("merge")
    return wide.join(hits.withColumnRenamed("id", "detail_id"), "detail_id")


def bm25_index_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 + T2: the best 100 rows by relevance, from the postings of two terms."""
    hits = item_index(spark, sf_dir).rank(ANY_ITEM, 100)
    return _names(spark, sf_dir, hits).select("detail_id", "sku_name", F.round("score", 6).alias("score"))


def index_match_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose name holds every term."""
    index = item_index(spark, sf_dir)
    return _names(spark, sf_dir, index.match_all(ANY_ITEM), index)


def fuzzy_index_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two edits, by the term dictionary."""
    index = item_index(spark, sf_dir)
    return _names(spark, sf_dir, index.fuzzy(FUZZY_TERM, 2), index)


def fuzzy_index_transpose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An exchange of neighbours is one edit."""
    index = item_index(spark, sf_dir)
    return _names(spark, sf_dir, index.fuzzy("wdiget", 1), index)


def highlight_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: the best fragment of each matching document, its query tokens marked."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text").where(match_any("text", FRAGMENT_QUERY))
    best = best_fragment("text", FRAGMENT_QUERY)
    out = docs.select("doc_id", F.size(fragments("text")).alias("n_fragments"), best.alias("best"))
    return out.select("doc_id", "n_fragments", F.col("best.score").alias("score"),
                      highlight("best.fragment", FRAGMENT_QUERY).alias("fragment"))


def deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: the page in the middle of all rows by amount; it reads its own range."""
    order = [F.desc("split_total_amount"), F.asc("detail_id")]
    wide = stored_wide(spark, sf_dir).select("detail_id", "split_total_amount")
    path = stored_once(spark, "by-amount", sf_dir, lambda to: paging.write_ordered(wide, order, to))
    ordered = paging.Ordered(spark, path, order, wide.schema)
    rows = ordered.page(ordered.total // 2 // DEEP_SIZE + 1, DEEP_SIZE)
    return rows.select("detail_id", F.col("split_total_amount").cast("double").alias("split_total_amount"))
