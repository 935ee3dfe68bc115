"""Toxicity scores: logistic regression by FTRL-proximal over hashed n-grams.

Features are words, word pairs and skip-grams (pairs with one or two words between),
hashed to ``2**BITS`` numbers; a text has a feature or not, however often it occurs.
FTRL-proximal keeps a learning rate for each coordinate and sets weak coordinates to
exactly zero (L1), so the model is a short list of weights, bounded by ``2**BITS``, that
is sent to every task.

The classifier is fitted on a bounded sample: of the labelled rows outside the held-out
fold the ``TRAIN_ROWS`` with the least hash of id and text, in this order, ``EPOCHS``
times over, streamed through one task. Everything else covers all documents.

Defined cases: a null text scores as an empty one, by the bias alone; a null id has no
label and is not held out; null labels are left out; repeated rows each give a row;
without training rows every score is 0; an empty table gives an empty result; columns
other than ``doc_id`` and ``text`` (of labels: ``doc_id`` and ``toxic``) are ignored.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import doc_crc, pack_numbers, text_slices, unpack_numbers

BITS = 20
SKIPS = (1, 2, 3)
TRAIN_ROWS = 20_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 16.0, 0.1
FOLDS, HELD_OUT = 5, 0
#: The bias's number, after the features'.
BIAS = 1 << BITS
_PLAIN = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in bytes(range(256)).lower())


def features(text: bytes, bits: int = BITS) -> np.ndarray:
    """Distinct numbers of a text's features, ordered."""
    words = text.translate(_PLAIN).split()
    if not words:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    shift = np.uint64(64 - bits)
    found = [h * np.uint64(0x9E3779B97F4A7C15)]
    for k in SKIPS:
        pair = (h[:-k] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (h[k:] * np.uint64(0x165667B19E3779F9 + 2 * k))
        found.append(pair * np.uint64(0x9E3779B97F4A7C15))
    return np.unique(np.concatenate(found) >> shift).astype(np.int64)


class Ftrl:
    """FTRL-proximal for logistic loss; the bias is not regularised by L1."""

    def __init__(self, alpha=ALPHA, beta=BETA, l1=L1, l2=L2, bits=BITS):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self.bias = 1 << bits

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == self.bias, 0.0, self.l1)
        rate = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / rate)

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, self.bias)
        w = self.weights(at)
        gradient = _logistic(w.sum()) - label
        n = self.n[at]
        self.z[at] += gradient - (np.sqrt(n + gradient ** 2) - np.sqrt(n)) / self.alpha * w
        self.n[at] += gradient ** 2


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _featured(batches, bits):
    for part, texts in text_slices(batches):
        other = part.drop_columns(["text"])
        # ordered numbers pack well as differences: one or two bytes a feature
        packed = [pack_numbers(np.diff(features(t, bits), prepend=0).astype(np.uint32)) for t in texts]
        found = pa.array(packed, pa.binary())
        yield pa.RecordBatch.from_arrays([*other.columns, found], [*other.schema.names, "features"])


def _fitted(batches, bits):
    model, seen = Ftrl(bits=bits), 0
    for batch in batches:
        for label, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            model.learn(np.cumsum(unpack_numbers(packed, np.uint32), dtype=np.int64), label)
            seen += 1
    if seen:
        at = np.arange(model.bias + 1)
        w = model.weights(at)
        at = at[(w != 0) | (at == model.bias)]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["feature", "weight"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, epochs: int = EPOCHS,
        bits: int = BITS) -> np.ndarray | None:
    """Weights by feature number, the bias last; None without training rows."""
    known = labels.where(F.col("toxic").isNotNull() & (doc_crc() % FOLDS != HELD_OUT)).select(
        "doc_id", F.col("toxic").cast("int").alias("toxic"))
    order = F.xxhash64("doc_id")
    # at most `rows` short rows; documents repeating an id are cut off by the second limit
    known = F.broadcast(known.withColumn("order", order).orderBy("order", "doc_id", "toxic").limit(rows))
    sample = (docs.select("doc_id", "text").join(known, "doc_id")
              .select(F.col("toxic").alias("label"), F.xxhash64("doc_id", "text").alias("order"), "text")
              .mapInArrow(partial(_featured, bits=bits), "label int, order bigint, features binary")
              .orderBy("order", "label").limit(rows))
    turns = sample.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs)))).coalesce(
        1).sortWithinPartitions("epoch", "order", "label")
    found = turns.select("label", "features").mapInArrow(
        partial(_fitted, bits=bits), "feature bigint, weight double").collect()
    if not found:
        return None
    weights = np.zeros((1 << bits) + 1)
    weights[[r["feature"] for r in found]] = [r["weight"] for r in found]
    return weights


def _scored(batches, shared, bits):
    weights = shared.value
    for part, texts in text_slices(batches):
        sums = np.array([weights[features(t, bits)].sum() + weights[-1] for t in texts], float)
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_logistic(sums))], ["doc_id", "score"])


def score(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, epochs: int = EPOCHS,
          bits: int = BITS) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs(doc_id, text)``."""
    weights = fit(docs, labels, rows, epochs, bits)
    kind = docs.schema["doc_id"].dataType.simpleString()
    if weights is None:
        found = docs.select("doc_id", F.lit(0.0).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
        found = docs.select("doc_id", "text").mapInArrow(
            partial(_scored, shared=shared, bits=bits), f"doc_id {kind}, score double")
    held = F.coalesce(doc_crc() % FOLDS == HELD_OUT, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))
