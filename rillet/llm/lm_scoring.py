"""Language-model scoring by context-tree weighting, beside a word-count base score.

Text is lower-cased (A-Z); its tokens are its words and one end. The tree models the
words' bytes, joined by one space, and a line feed as the end. Training documents are
those whose crc32(doc_id as text) mod ``FOLDS`` is not ``HELD_OUT``.

Counting and scoring are sharded on both sides. Documents are dealt into blocks of about
``BLOCK_BYTES`` by a hash; each block reduces to its distinct words and byte contexts
with training counts. These go, packed by bucket, to the tasks that own a bucket of the
model, which sum the counts and send back only the numbers that a block needs. Buckets
of contexts hold whole subtrees, named by the last two context bytes, so a task builds
and mixes its own trees; the depths above have 257 contexts and pass through the driver.
No task holds the whole model or the vocabulary.

Defined cases: a null text is scored as an empty one, its one token the end; a null id
is in training (crc32 null is not the held-out remainder) and is not held out; repeated
rows count and score as often as they occur; an empty table gives an empty result;
without training documents the base score is 0 and every bit has probability 1/2; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm import context_tree as tree
from rillet.llm.common import (doc_crc, pack_numbers, parts_for, stored, text_slices,
                               unpack_numbers)

FOLDS, HELD_OUT = 5, 1
BLOCK_BYTES = 24 << 20
#: Bytes of packed words and contexts that a task sums at once, about.
BUCKET_BYTES = 32 << 20
_WORDS, _CONTEXTS = 0, 1
PACKED = "block int, bucket int, kind int, keys binary, numbers binary"


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _pack_keys(kind: int, keys) -> bytes:
    if kind == _WORDS:
        return _pack(b"\n".join(keys))
    return pack_numbers(np.diff(keys, prepend=np.uint64(0)))


def _unpack_keys(kind: int, data: bytes):
    if kind == _WORDS:
        return _unpack(data).split(b"\n")
    return np.cumsum(unpack_numbers(data, np.uint64), dtype=np.uint64)


def body_of(words: list[bytes]) -> bytes:
    """What the tree models of a text's words."""
    return b" ".join(words) + tree.END


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]):
    return tree.counted(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))


def _reduced(batches, buckets):
    """A block's distinct words and contexts with training counts, packed by bucket. The
    end counts as the empty word."""
    words: Counter = Counter()
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    block = None

    def flush():
        by = [[] for _ in range(buckets)]
        for w in words:
            by[xxhash.xxh64_intdigest(w) % buckets].append(w)
        rows = []
        for b, own in enumerate(by):
            if own:
                own.sort()
                counts = np.array([words[w] for w in own], np.uint32)
                rows.append((block, b, _WORDS, _pack_keys(_WORDS, own), pack_numbers(counts)))
        keys, counts = _merge(parts)
        where = (keys >> np.uint64(8 * (tree.DEPTH + 1 - tree.TOP))) % np.uint64(buckets)
        order = np.argsort(where, kind="stable")
        edges = np.searchsorted(where[order], np.arange(buckets + 1, dtype=np.uint64))
        for b in range(buckets):
            own = order[edges[b]:edges[b + 1]]
            if len(own):
                rows.append((block, b, _CONTEXTS, _pack_keys(_CONTEXTS, keys[own]),
                             pack_numbers(counts[own].astype(np.uint32))))
        words.clear()
        parts.clear()
        cols = list(zip(*rows))
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          [x.split()[0] for x in PACKED.split(", ")])

    for part, texts in text_slices(batches):
        blocks = part.column(0).to_numpy()
        train = part.column(1).to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(np.diff(blocks)) + 1
        for rows in np.split(np.arange(len(blocks)), edges):
            if blocks[rows[0]] != block:
                if block is not None:
                    yield flush()
                block = int(blocks[rows[0]])
            for held in (False, True):
                split = [texts[k].lower().split() for k in rows if train[k] != held]
                if not split:
                    continue
                for tokens in split:
                    if held:
                        words.update(dict.fromkeys(tokens, 0))
                    else:
                        words.update(tokens)
                words[b""] += 0 if held else len(split)
                keys, counts = np.unique(tree.keys_of([body_of(t) for t in split]), return_counts=True)
                parts.append((keys, counts * (not held)))
            if sum(len(k) for k, _ in parts) > 1 << 22:
                parts[:] = [_merge(parts)]
    if block is not None:
        yield flush()


def _bucket_totals(kind: int, table: pa.Table):
    """(keys of each row, distinct keys, totals) of one bucket."""
    keys = [_unpack_keys(kind, k) for k in table.column("keys").to_pylist()]
    counts = [unpack_numbers(c, np.uint32).astype(np.int64)
              for c in table.column("numbers").to_pylist()]
    if kind == _WORDS:
        totals: Counter = Counter()
        for own, n in zip(keys, counts):
            totals.update(dict(zip(own, n.tolist())))
        return keys, totals, None
    return keys, *_merge(list(zip(keys, counts)))


STATISTICS = "id bigint, zeros double, ones double, below double"
#: Ids of the words' totals beside those of the tree's depth-1 nodes.
_TOKENS, _TYPES = -1, -2


def _statistics(key, table):
    """Totals of a bucket that every block needs: counts of tokens and types, or sums
    for the tree's depth-1 nodes."""
    kind = key[0].as_py()
    _, distinct, totals = _bucket_totals(kind, table)
    if kind == _WORDS:
        n = sum(distinct.values())
        v = sum(c > 0 for c in distinct.values())
        cols = [[_TOKENS, _TYPES], [float(n), float(v)], [0.0, 0.0], [0.0, 0.0]]
    else:
        cols = tree.top_sums(distinct, totals)
    return pa.table({f.split()[0]: pa.array(c, pa.int64() if f.startswith("id") else pa.float64())
                     for f, c in zip(STATISTICS.split(", "), cols)})


def _answers(key, table, tops):
    """The rows with what their block asked for: totals of words, log10 of contexts."""
    kind = key[0].as_py()
    keys, distinct, totals = _bucket_totals(kind, table)
    if kind == _WORDS:
        numbers = [np.fromiter(map(distinct.__getitem__, own), np.uint64, len(own)) for own in keys]
    else:
        logs = tree.log10_probability(distinct, totals, tops).astype(np.float32)
        numbers = [logs[np.searchsorted(distinct, own)] for own in keys]
    at = table.schema.get_field_index("numbers")
    return table.set_column(at, "numbers", pa.array([pack_numbers(n) for n in numbers], pa.binary()))


class _Lookup:
    """Numbers by key: direct-mapped tables, each for the keys that lost their slot in the
    one before. Every key asked for must be there."""

    MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                   0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.tables, turn = [], 0
        while len(keys):
            bits = max(4, int(4 * len(keys)).bit_length())
            # odd numbers by turn, should the given ones run out
            by = np.uint64(self.MULTIPLIERS[turn] if turn < 5 else (2 * turn + 1) * 0x9E3779B97F4A7C15 % 2**64)
            shift = np.uint64(64 - bits)
            slots = (keys * by) >> shift
            held = np.full(1 << bits, np.iinfo(np.uint64).max, np.uint64)
            numbers = np.zeros(1 << bits, np.float32)
            held[slots], numbers[slots] = keys, values
            self.tables.append((by, shift, held, numbers))
            lost = held[slots] != keys
            keys, values, turn = keys[lost], values[lost], turn + 1

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out, left = np.zeros(len(keys), np.float32), None
        for by, shift, held, numbers in self.tables:
            asked = keys if left is None else keys[left]
            slots = (asked * by) >> shift
            found = numbers[slots]
            lost = np.flatnonzero(held[slots] != asked)
            if left is None:
                out, left = found, lost
            else:
                out[left] = found
                left = left[lost]
            if not len(left):
                return out
        if len(left):
            raise KeyError(int(keys[left[0]]))
        return out


SCORED = ("n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
          "score double, n_bytes bigint, bits_per_byte double")


class _Model:
    """What a block asked for: totals of its words, log10 of its contexts."""

    def __init__(self, answers: list[tuple[int, bytes, bytes]], tokens: int, types: int):
        below = tokens + 0.5 * (types + 1)
        self.base, self.strange, keys, logs = {}, set(), [], []
        for kind, packed, numbers in answers:
            own = _unpack_keys(kind, packed)
            if kind == _WORDS:
                totals = unpack_numbers(numbers, np.uint64)
                self.base.update(zip(own, np.log10((totals + 0.5) / below).tolist()))
                self.strange.update(own[k] for k in np.flatnonzero(totals == 0))
            else:
                keys.append(own)
                logs.append(unpack_numbers(numbers, np.float32))
        self.tokens, self.lookup = tokens, _Lookup(np.concatenate(keys), np.concatenate(logs))

    def rows(self, texts: list[bytes]):
        """The scores of texts, one tuple each."""
        split = [t.lower().split() for t in texts]
        bodies = [body_of(w) for w in split]
        sizes = np.array([len(b) for b in bodies])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        scores = np.add.reduceat(self.lookup(tree.keys_of(bodies)).astype(np.float64), starts)
        for words, score, size in zip(split, scores.tolist(), sizes.tolist()):
            words.append(b"")  # the end
            base = sum(map(self.base.__getitem__, words))
            strange = sum(map(self.strange.__contains__, words)) if self.strange else 0
            yield (len(words), len(words) - strange, self.tokens, base, score, size,
                   -score / np.log10(2) / size)


def _scored(batches, tokens, types):
    """A block's rows: first the answers to its questions, then its documents."""
    answers, model = [], None
    for batch in batches:
        documents = batch.column("doc").to_numpy(zero_copy_only=False).astype(bool)
        first = int(np.argmax(documents)) if documents.any() else len(documents)
        if first:
            answers += zip(*(batch.column(c).slice(0, first).to_pylist()
                             for c in ("kind", "keys", "numbers")))
        for part, texts in text_slices([batch.slice(first)]):
            model = model or _Model(answers, tokens, types)
            cols = list(zip(*model.rows(texts)))
            kinds = [*[pa.int64()] * 3, pa.float64(), pa.float64(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                ["doc_id", *(x.split()[0] for x in SCORED.split(", "))])


def score(docs: DataFrame, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES
          ) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes,
    bits_per_byte)`` per row of ``docs(doc_id, text)``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = parts_for(total, block_bytes)
    # distinct words and contexts pack to about a sixth of the text
    buckets = parts_for(total // 6, bucket_bytes, 12)
    held = F.coalesce(doc_crc() % FOLDS == HELD_OUT, F.lit(False))
    dealt = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"),
                        (~held).alias("train"), "doc_id", "text")
    packed = stored(dealt.select("block", "train", "text").repartitionById(blocks, "block")
                    .mapInArrow(partial(_reduced, buckets=buckets), PACKED), "features")
    shards = packed.groupBy("kind", "bucket")
    sums = shards.applyInArrow(_statistics, STATISTICS).groupBy("id").agg(
        *(F.sum(c).alias(c) for c in ("zeros", "ones", "below"))).collect()  # at most 65,538 rows
    words = {r["id"]: int(r["zeros"]) for r in sums if r["id"] < 0}
    nodes = [r for r in sums if r["id"] >= 0]
    tops = tree.top_tables(*([r[c] for r in nodes] for c in ("id", "zeros", "ones", "below")))
    sent = shards.applyInArrow(_with(_answers, tops=tops), PACKED)
    # one task a block: the answers come first, the documents stream after them
    both = dealt.select("block", F.lit(True).alias("doc"), "doc_id", "text").unionByName(
        sent.select("block", F.lit(False).alias("doc"), "kind", "keys", "numbers"),
        allowMissingColumns=True)
    found = both.repartitionById(blocks, "block").sortWithinPartitions("doc").mapInArrow(
        partial(_scored, tokens=words.get(_TOKENS, 0), types=words.get(_TYPES, 0)),
        f"doc_id {kind}, {SCORED}")
    return found.select("doc_id", F.coalesce(doc_crc() % FOLDS == HELD_OUT, F.lit(False)).alias("held_out"),
                        *(x.split()[0] for x in SCORED.split(", ")))


def _with(function, **fixed):
    """``function`` of two tables with the other arguments fixed; Spark counts arguments."""
    def run(left, right):
        return function(left, right, **fixed)
    return run
