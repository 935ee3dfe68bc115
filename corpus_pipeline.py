"""Corpus pipeline: raw documents to packed training sequences.

STAGES are (name, function) in order; each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and reread as the next one's docs.
All but the last return the columns of ``documents``.

Defined cases: null and empty texts fail the quality rules and go; an id that is null
loses to any other in its near-duplicate group; repeated rows of one id and text are
exact copies, so one stays; a text that holds a benchmark passage goes whatever its id,
null or shared, and no other text of this id goes with it; an empty table gives an empty result; extra columns are
carried up to packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.llm import decontam, packing, quality, secret_scan, simhash
from rillet.llm.common import stored
from rillet.operators.joins import bounded_broadcast
from rillet.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group stays."""
    return simhash.survivors(docs, simhash.SHINGLE, simhash.RADIUS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go; whether one does, its text alone says."""
    digest = F.sha2("text", 256)
    found = decontam.matches(docs.select(digest.alias("doc_id"), "text"),
                             table(spark, sf_dir, "benchmark", "item_id", "text"))
    # a few digests: with their number known, the documents need not be shuffled for them
    gone = stored(found.select(F.col("doc_id").alias("gone")).distinct(), "contaminated")
    return docs.join(bounded_broadcast(gone), F.sha2(docs["text"], 256) == gone["gone"], "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("redact_secrets", redact_secrets),
    ("pack_sequences", pack_sequences),
]

#: Tokenising and the latent search have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
