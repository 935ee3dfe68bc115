"""Search over an inverted index (T1-T5): postings in files ordered by term.

``build`` writes four tables: postings (term, id, tf, len), ordered by (term, id) within each
pass over the documents, so that a term's rows stand in few row groups of a pass and a term of
a third of all documents in many files;
terms (term, df); deletes (variant, term), the forms of a term's first letters with up to
``MAX_EDITS`` letters taken out; and stats, one row. A query reads the row groups of its own
terms: no document is tokenised again.

Two terms within k edits (an exchange of neighbours is one) have an equal form after at most
k letters are taken out of the first ``PREFIX`` letters of each, for any PREFIX over k. So a
fuzzy search joins candidates by equality and takes the exact distance of these alone.

Defined cases: a null text counts as a document without a length, as in ``search``; an empty
query finds nothing; an id that stands twice is scored by its texts together, so ids should
be unique; an empty table gives an empty index.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.functions.text import analyze, tokens, within_edits
from rillet.operators.search import K1, B
from rillet.session import no_shuffle_left

PREFIX, MAX_EDITS = 8, 2
#: Documents whose hits meet in one task, and whose postings are written in one pass.
TASK_DOCS, PASS_DOCS = 1 << 18, 1 << 24
#: Terms near those of a fuzzy search that are looked up by name; more are joined.
FOUND_TERMS = 1000


def _less_one(word: Column) -> Column:
    """The forms of ``word`` with one letter taken out."""
    places = F.when(F.char_length(word) > 0, F.sequence(F.lit(1), F.char_length(word)))
    return F.coalesce(F.transform(places, lambda i: F.concat(
        F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.char_length(word)))),
        F.array().cast("array<string>"))


def _variants(word: Column) -> Column:
    """The forms of the first letters of ``word`` with up to MAX_EDITS letters taken out."""
    forms = F.array(F.substring(word, 1, PREFIX))
    found = forms
    for _ in range(MAX_EDITS):
        forms = F.array_distinct(F.flatten(F.transform(forms, _less_one)))
        found = F.array_union(found, forms)
    return found


def variants(word: str, edits: int) -> list[str]:
    """The same forms of a query term (a parameter)."""
    forms = found = {word[:PREFIX]}
    for _ in range(edits):
        forms = {w[:k] + w[k + 1:] for w in forms for k in range(len(w))}
        found = found | forms
    return sorted(found)


def _postings(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The postings of ``docs`` by (term, id). Tokens move once: a range holds every row of a
    (term, id), so that they are counted where they lie."""
    toks = docs.select(F.col(id_col).alias("id"), tokens(text_col).alias("toks"))
    rows = toks.select("id", F.size("toks").alias("len"), F.explode("toks").alias("term"))
    return (rows.repartitionByRange("term", "id").groupBy("term", "id")
            .agg(F.count(F.lit(1)).alias("tf"), F.first("len").alias("len"))
            .sortWithinPartitions("term", "id"))


def build(docs: DataFrame, id_col: str, text_col: str, path: str) -> None:
    """Write the index of ``docs`` below ``path``. The postings come in passes of about
    ``PASS_DOCS`` documents by id, whose shuffle files go when they are written."""
    spark = docs.sparkSession
    counts = docs.agg(F.count(F.lit(1)).alias("n_docs"), F.count(F.col(text_col)).alias("n_texts"))
    with no_shuffle_left(spark):
        known = counts.first()
        parts = max(1, -(-known["n_docs"] // PASS_DOCS))
        for part in range(parts):
            some = docs if parts == 1 else docs.where(F.pmod(F.xxhash64(id_col), F.lit(parts)) == part)
            (_postings(some, id_col, text_col).write.mode("append").option("compression", "zstd")
             .parquet(f"{path}/postings"))
        stored = spark.read.parquet(f"{path}/postings")
        terms = stored.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        terms.repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{path}/terms")
        deletes = spark.read.parquet(f"{path}/terms").select(
            F.explode(_variants(F.col("term"))).alias("variant"), "term")
        (deletes.repartitionByRange("variant", "term").sortWithinPartitions("variant", "term")
         .write.parquet(f"{path}/deletes"))
        # the tokens are counted in the postings: no text is tokenised again
        n_docs, n_texts = (F.lit(known[c]).cast("bigint") for c in ("n_docs", "n_texts"))
        n_tokens = F.coalesce(F.sum("tf"), F.lit(0)).cast("double")
        stats = stored.agg(F.when(n_texts > 0, n_tokens / n_texts).alias("avgdl"))
        stats.select(n_docs.alias("n_docs"), "avgdl").write.parquet(f"{path}/stats")


class Index:
    def __init__(self, spark: SparkSession, path: str):
        self.postings = spark.read.parquet(f"{path}/postings")
        self.terms = spark.read.parquet(f"{path}/terms")
        self.deletes = spark.read.parquet(f"{path}/deletes")
        self.stats = spark.read.parquet(f"{path}/stats")

    def by_id(self, rows: DataFrame, id_col: str = "id") -> DataFrame:
        """``rows`` by id in parts of about ``TASK_DOCS`` documents: what a task holds does not
        grow with the index, whatever number of partitions the session has."""
        return rows.repartition(max(1, -(-self.stats.first()["n_docs"] // TASK_DOCS)), id_col)

    def _of(self, terms: list[str]) -> DataFrame:
        return self.postings.where(F.col("term").isin(terms) if terms else F.lit(False))

    def rank(self, query: str, k: int = 100, every: bool = False, k1: float = K1, b: float = B) -> DataFrame:
        """T5: ``(id, score)`` of the k best documents by BM25 (ties by id) that hold any, or
        ``every``, term of the query. One row of stats and one a term are read first."""
        terms = sorted(set(analyze(query)))
        stats = self.stats.first()
        known = dict(self.terms.where(F.col("term").isin(terms) if terms else F.lit(False)).collect())
        n, avgdl = stats["n_docs"], stats["avgdl"] or 1.0
        idf = F.lit(0.0)
        for term, df in known.items():
            idf = F.when(F.col("term") == term, math.log(1 + (n - df + 0.5) / (df + 0.5))).otherwise(idf)
        tf, length = F.col("tf").cast("double"), F.col("len").cast("double")
        weight = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / F.lit(avgdl)))
        scored = self._of(terms).groupBy("id").agg(F.sum(weight).alias("score"), F.count(F.lit(1)).alias("held"))
        if every:
            scored = scored.where(F.col("held") == len(terms))
        return scored.select("id", "score").orderBy(F.desc("score"), "id").limit(k)

    def match_all(self, query: str) -> DataFrame:
        """``id`` of documents that hold every term of the query."""
        terms = sorted(set(analyze(query)))
        held = self.by_id(self._of(terms)).groupBy("id").agg(F.count(F.lit(1)).alias("held"))
        return held.where(F.col("held") == len(terms)).select("id")

    def near(self, term: str, max_edits: int = MAX_EDITS) -> DataFrame:
        """The index's terms within ``max_edits`` of ``term``."""
        if max_edits > MAX_EDITS:
            raise ValueError(f"the index holds forms for {MAX_EDITS} edits")
        candidates = self.deletes.where(F.col("variant").isin(variants(term, max_edits)))
        return candidates.select("term").distinct().where(within_edits(F.col("term"), term, max_edits))

    def fuzzy(self, query: str, max_edits: int = MAX_EDITS) -> DataFrame:
        """``id`` of documents in which every query term has a term within ``max_edits``."""
        terms = sorted(set(analyze(query)))
        if not terms:
            return self.postings.select("id").limit(0)
        found = reduce(DataFrame.unionByName, [
            self.near(t, max_edits).withColumn("asked", F.lit(k)) for k, t in enumerate(terms)])
        few = found.limit(FOUND_TERMS + 1).collect()
        postings = self.postings
        if len(few) <= FOUND_TERMS:  # their row groups are read, and no distance is taken again there
            found = F.broadcast(found.sparkSession.createDataFrame(few, found.schema))
            postings = self._of(sorted({r["term"] for r in few}))
        held = self.by_id(postings.join(found, "term").select("id", "asked")).distinct()
        return held.groupBy("id").agg(F.count(F.lit(1)).alias("held")).where(
            F.col("held") == len(terms)).select("id")
