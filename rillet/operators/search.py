"""Search-style reads (T1-T5, P13, L2): filter by text match, score, page, highlight.

BM25 (k1=1.2, b=0.75, idf = ln(1 + (N - n + 0.5)/(n + 0.5))) over the scope's
documents. Corpus statistics (N, average length, document frequency of each query
term) are one aggregate of the text column alone, taken over its distinct texts with
their counts, so that equal texts are analysed once; it returns a single row of numbers,
which enter the score as literals. Over a stored table both passes read pruned columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.functions.misc import include_fields
from rillet.functions.text import analyze, highlight, match_all, term_frequency, tokens
from rillet.operators.aggregates import day_scope

K1 = 1.2
B = 0.75


def corpus_stats(df: DataFrame, text_col: str, terms: list[str]) -> dict:
    """N, avgdl and per-term document frequency (one row)."""
    per = df.groupBy(F.col(text_col).alias("__text")).agg(F.count(F.lit(1)).alias("__n"))
    t = tokens("__text")
    n = F.col("__n")
    length = F.when(F.col("__text").isNotNull(), F.size(t))
    aggs = [F.sum(n).alias("n_docs"),
            (F.sum(n * length) / F.sum(F.when(length.isNotNull(), n))).alias("avgdl")]
    aggs += [F.sum(F.when(F.array_contains(t, F.lit(term)), n).otherwise(0)).alias(f"df_{i}")
             for i, term in enumerate(terms)]
    row = per.agg(*aggs).first()
    return {"n_docs": row["n_docs"] or 0, "avgdl": row["avgdl"] or 0.0,
            "df": [row[f"df_{i}"] or 0 for i in range(len(terms))]}


def bm25_score(df: DataFrame, text_col: str, query: str, k1: float = K1,
               b: float = B) -> Column:
    """Column expression of the BM25 score of ``text_col`` for ``query``."""
    terms = sorted(set(analyze(query)))
    if not terms:
        return F.lit(0.0)
    st = corpus_stats(df, text_col, terms)
    n, avgdl = st["n_docs"], st["avgdl"] or 1.0
    toks = tokens(text_col)
    dl = F.size(toks).cast("double")
    score = F.lit(0.0)
    for term, dfreq in zip(terms, st["df"]):
        idf = math.log(1.0 + (n - dfreq + 0.5) / (dfreq + 0.5))
        tf = term_frequency(toks, term).cast("double")
        score = score + F.lit(idf) * tf * (k1 + 1) / (tf + F.lit(k1) * (1 - b + b * dl / F.lit(avgdl)))
    return score


def bm25_rank(df: DataFrame, text_col: str, query: str, id_col: str, k: int = 100) -> DataFrame:
    """T5: documents matching any query token ranked by BM25 (score desc, id asc), top k."""
    from rillet.functions.text import match_any
    scored = df.where(match_any(text_col, query)).select(
        id_col, text_col, bm25_score(df, text_col, query).alias("score"))
    return scored.orderBy(F.desc("score"), F.asc(id_col)).limit(k)


#: The fields that the detail search returns.
DETAIL_FIELDS = ["sku_name", "sku_num", "province_name", "order_price", "total_amount",
                 "user_age", "user_gender", "create_time"]


def detail_by_item(wide: DataFrame, item: str, page_no: int = 1, page_size: int = 20,
                   fields: list[str] | None = None, id_col: str = "detail_id",
                   pre_tag: str = "<em>", post_tag: str = "</em>",
                   date: str | None = None) -> DataFrame:
    """T1 + T5 + L2 + T4 + P13: rows whose sku_name holds every item token, of one day's
    partition if ``date`` is given, in relevance order (ties by id), one page, sku_name
    replaced by its highlight."""
    wide = day_scope(wide, date, "create_date")
    fields = fields or DETAIL_FIELDS
    score = bm25_score(wide, "sku_name", item)
    hits = wide.where(match_all("sku_name", item)).withColumn("__score", score)
    start = (page_no - 1) * page_size
    page = hits.orderBy(F.desc("__score"), F.asc(id_col)).offset(start).limit(page_size)
    if "sku_name" in fields:
        page = page.withColumn("sku_name", highlight("sku_name", item, pre_tag, post_tag))
    return include_fields(page, [id_col, *fields])


def detail_total(wide: DataFrame, item: str, date: str | None = None) -> DataFrame:
    """Total hit count of the detail search (exact; 0 for a day without a partition)."""
    return day_scope(wide, date, "create_date").where(match_all("sku_name", item)).agg(F.count(F.lit(1)).alias("total"))
