"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages of at most ``WINDOW`` words. A passage is sought by
its words and, in longer items, by all stretches of ``WINDOW`` words that begin in it, every
``SHIFT`` words and at the item's last ``WINDOW`` words, so that a quote across the cut of
two passages is found whole; the best of them counts. Terms are weighted
by tf-idf, with document frequencies over all documents. A randomised SVD, whose sketch
products run as Spark jobs over the stretches' rows, gives a latent space, which fits these
rows alone. Every document is cut into blocks of
``STRIDE`` words; a window is two adjacent blocks. A window is a candidate for a passage
if its cosine reaches ``LEAST_COSINE`` and its projection on the passage covers
``LEAST_COVER`` of it. Candidates are checked on the words themselves: the longest common
subsequence with the best stretch near the window must reach ``SURE`` of the passage,
or ``LIKELY`` with the passage's answer (its last words) found as well.

The passages are the stated query set. They are taken in blocks of bounded size, each
compared with all windows of all documents. Document frequencies of all their words come
from one reading of the documents, and one more reading serves ``PASS_BLOCKS`` blocks; words
are cut and numbered once a reading. The benchmark's distinct words are held in every task.

Defined cases: null and empty texts and items match nothing; repeated rows each give
rows; an item or a document with a null id is matched and carried with the null; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from functools import partial, reduce
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import stored, text_slices

WINDOW, STRIDE = 64, 32
#: Any quote of SURE * WINDOW + 1 words, and more, has SURE of a stretch so many words apart.
SHIFT = 16
#: Stretches of a query block.
QUERY_BLOCK = 512
#: Query blocks that one reading of the documents serves; a block's space takes at most 33 MB.
PASS_BLOCKS = 8
RANK, OVERSAMPLE, POWER_STEPS, SEED = 256, 16, 2, 7
LEAST_COSINE, LEAST_COVER = 0.25, 0.45
SURE, LIKELY, ANSWER_WORDS, ANSWER_SHARE = 0.75, 0.6, 6, 0.5
#: A stretch may be this much longer than the passage.
SLACK = 1.3
CELLS = 1 << 22
_PLAIN = bytes(32 if 33 <= b < 127 and not chr(b).isalnum() else b for b in bytes(range(256)).lower())
TERMS_PER_BLOB = 256


def tokens(text: bytes | None) -> list[bytes]:
    """Words in lower case (A-Z); white space and ASCII punctuation divide them."""
    return (text or b"").translate(_PLAIN).split()


def _numbers(text: bytes, terms: dict[bytes, int]) -> np.ndarray:
    """Number of each word's query term; -1 for other words."""
    words = tokens(text)
    return np.fromiter(map(terms.get, words, repeat(-1)), np.int32, len(words))


def _starts(n: int, k: int, window: int) -> list[int]:
    """Where the stretches of the passage at ``k`` of an item of ``n`` words begin."""
    found = {k, *(a for a in range(k, min(k + window, n - window + 1), min(SHIFT, window)))}
    if k <= n - window < k + window:
        found.add(n - window)
    return sorted(found)


def _cut(batches, window):
    """Passages of the items."""
    for part, texts in text_slices(batches):
        rows = [(i, k // window, [words[a:a + window] for a in _starts(len(words), k, window)])
                for i, t in zip(part.column(0).to_pylist(), texts)
                for words in [tokens(t)] for k in range(0, len(words), window)]
        cols = list(zip(*rows)) or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], part.schema.field(0).type), pa.array(cols[1], pa.int32()),
             pa.array([[[w.decode() for w in y] for y in x] for x in cols[2]],
                      pa.list_(pa.list_(pa.string())))],
            ["item_id", "passage", "stretches"])


def passages(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    kind = benchmark.schema["item_id"].dataType.simpleString()
    return benchmark.select("item_id", "text").mapInArrow(
        partial(_cut, window=window), f"item_id {kind}, passage int, stretches array<array<string>>")


def _frequencies(batches, terms):
    """Documents of a task by term; term -1 counts all documents."""
    counts, docs = np.zeros(len(terms), np.int64), 0
    for part, texts in text_slices(batches):
        for text in texts:
            found = np.unique(_numbers(text, terms))
            counts[found[found >= 0]] += 1
        docs += len(texts)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(counts[at], docs))],
        ["term", "n"])


def _idf(docs: DataFrame, terms: dict[bytes, int]) -> np.ndarray:
    rows = docs.select("text").mapInArrow(partial(_frequencies, terms=terms), "term int, n bigint")
    found = {r["term"]: r["n"] for r in rows.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    total = found.pop(-1, 0)
    df = np.zeros(len(terms))
    df[list(found)] = list(found.values())
    return np.log((1 + total) / (1 + df)) + 1


class _Block(NamedTuple):
    """What a task needs to search for a query block."""
    local: np.ndarray  # the block's number of each benchmark word; -1 for others, and at the end
    items: list[list[int]]  # term numbers of each stretch
    owners: list[int]  # its passage
    space: np.ndarray  # idf-weighted rows of the latent space
    latent: np.ndarray  # latent stretches


def _times(batches, right, idf):
    """Partial sums of A'(A right) of a task's rows, in blobs of ``TERMS_PER_BLOB`` terms."""
    out = np.zeros(right.shape, np.float64)
    for batch in batches:
        for row in batch.column(0).to_pylist():
            terms, tf = np.unique(np.array(row or [], np.int64), return_counts=True)
            if len(terms):
                w = tf * idf[terms]
                w /= np.linalg.norm(w)
                out[terms] += w[:, None] * (w @ right[terms])
    starts = [k for k in range(0, len(out), TERMS_PER_BLOB) if out[k:k + TERMS_PER_BLOB].any()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(starts, pa.int32()),
         pa.array([out[k:k + TERMS_PER_BLOB].tobytes() for k in starts], pa.binary())],
        ["start", "blob"])


def _added(key, table):
    total = sum(np.frombuffer(b, np.float64) for b in table.column("blob").to_pylist())
    return pa.table({"start": pa.array([key[0].as_py()], pa.int32()),
                     "blob": pa.array([total.tobytes()], pa.binary())})


def _product(rows: DataFrame, right: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """A'(A right) over the rows of a bounded table, summed by Spark."""
    parts = rows.mapInArrow(partial(_times, right=right, idf=idf), "start int, blob binary")
    sums = parts.groupBy("start").applyInArrow(_added, "start int, blob binary").collect()
    out = np.zeros(right.shape)
    for r in sums:
        blob = np.frombuffer(r["blob"], np.float64).reshape(-1, right.shape[1])
        out[r["start"]:r["start"] + len(blob)] = blob
    return out


def latent_space(rows: DataFrame, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Right singular vectors (terms x rank) of the tf-idf rows, by a randomised range
    finder with power steps and a small eigenproblem on the driver."""
    size = min(rank + OVERSAMPLE, len(idf))
    basis = np.random.default_rng(SEED).standard_normal((len(idf), size))
    for _ in range(POWER_STEPS):
        basis, _ = np.linalg.qr(_product(rows, basis, idf))
    small = basis.T @ _product(rows, basis, idf)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values)[:rank]
    return basis @ vectors[:, order[values[order] > 1e-9]]


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, in a big integer's bits."""
    masks: dict[int, int] = {}
    for k, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << k
    full = rest = (1 << len(a)) - 1
    for x in b:
        hit = rest & masks.get(x, 0)
        rest = (rest + hit | rest - hit) & full
    return len(a) - rest.bit_count()


def best_stretch(item: list[int], words: list[int], slack: float = SLACK) -> tuple[int, int]:
    """(start, shared words) of the stretch of ``words`` that shares most with ``item``."""
    size, want = int(len(item) * slack + 0.999), Counter(item)
    have: Counter = Counter()
    shared = best = at = 0
    for k, x in enumerate(words):
        if x in want:
            have[x] += 1
            shared += have[x] <= want[x]
        if k >= size and (old := words[k - size]) in want:
            shared -= have[old] <= want[old]
            have[old] -= 1
        if shared > best:
            best, at = shared, max(0, k - size + 1)
    return at, best


def verdict(item: list[int], words: list[int]) -> tuple[float, bool, bool, int]:
    """(share of the item in order, answer found, contaminated, start)."""
    at, shared = best_stretch(item, words)
    if shared < LIKELY * len(item):
        return 0.0, False, False, at
    stretch = words[at:at + int(len(item) * SLACK + 0.999)]
    share = lcs(item, stretch) / len(item)
    answer = item[-ANSWER_WORDS:]
    found = lcs(answer, stretch) >= ANSWER_SHARE * len(answer)
    return share, found, share >= SURE or (share >= LIKELY and found), at


def _found(each, block, unit, length):
    """Matches of a slice's documents, given by the block's numbers of their words:
    ``{(document, passage): (share, answer found, start, cosine)}``."""
    _, items, owners, space, _ = block
    blocks = np.array([max(1, -(-len(x) // STRIDE)) for x in each])
    first = np.concatenate([[0], np.cumsum(blocks)])
    owner = np.repeat(np.arange(len(each)), blocks)
    words = np.concatenate(each)
    at_block = np.concatenate([f + np.arange(len(x)) // STRIDE for f, x in zip(first, each)])
    known = words >= 0
    words, at_block = words[known], at_block[known].astype(np.int64)
    latent = np.zeros((first[-1], space.shape[1]), np.float32)
    step = max(1, CELLS // max(1, space.shape[1]))
    for lo in range(0, len(words), step):
        b = at_block[lo:lo + step]
        starts = np.flatnonzero(np.diff(b, prepend=-1))
        latent[b[starts]] += np.add.reduceat(space[words[lo:lo + step]], starts, axis=0)
    inner = owner[:-1] == owner[1:]
    window = latent.copy()
    window[:-1][inner] += latent[1:][inner]
    size = np.linalg.norm(window, axis=1)
    best: dict[tuple[int, int], tuple] = {}
    step = max(1, CELLS // max(1, len(unit)))
    for lo in range(0, len(window), step):
        along = window[lo:lo + step] @ unit.T
        near = (along >= LEAST_COSINE * size[lo:lo + step, None]) & (
            along >= LEAST_COVER * length[None, :]) & (length > 0)[None, :]
        for w, q in zip(*np.nonzero(near)):
            doc, at = int(owner[lo + w]), int(lo + w)
            start = max(0, (at - first[doc]) * STRIDE - STRIDE)
            text = each[doc][start:start + WINDOW + 2 * STRIDE].tolist()
            share, answer, bad, off = verdict(items[q], text)
            if bad and share > best.get((doc, owners[q]), (0,))[0]:
                cosine = float(along[w, q] / max(size[at], 1e-12))
                best[doc, owners[q]] = (share, answer, int(start + off), cosine)
    return best


def _search(batches, terms, blocks, schema):
    """Matches of a task's documents with the passages of ``blocks``."""
    lengths = [np.linalg.norm(b.latent, axis=1) for b in blocks]
    units = [(b.latent / np.maximum(n, 1e-12)[:, None]).astype(np.float32)
             for b, n in zip(blocks, lengths)]
    for part, texts in text_slices(batches):
        each = [_numbers(t, terms) for t in texts]
        names, rows = part.column(0).to_pylist(), []
        for block, unit, length in zip(blocks, units, lengths):
            best = _found([block.local[x] for x in each], block, unit, length)
            rows += [(names[d], q, *found) for (d, q), found in sorted(best.items())]
        cols = list(zip(*rows)) or [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, [part.schema.field(0).type, pa.int32(),
             pa.float64(), pa.bool_(), pa.int64(), pa.float64()])], schema)


def _block(spark, rows, first: int, terms: dict[bytes, int], idf: np.ndarray) -> _Block | None:
    """The query block of some passages, numbered from ``first``; None if they have no word."""
    queries = [[terms[w.encode()] for w in x] for r in rows for x in r["stretches"]]
    owners = [first + k for k, r in enumerate(rows) for _ in r["stretches"]]
    words = np.array(list(dict.fromkeys(w for q in queries for w in q)), np.int64)
    if not len(words):
        return None
    local = np.full(len(terms) + 1, -1, np.int32)
    local[words] = np.arange(len(words))
    items = [local[q].tolist() for q in queries]
    own = idf[words]
    fit = stored(spark.createDataFrame([(q,) for q in items], "terms array<int>"), "fit")
    space = (own[:, None] * latent_space(fit, own)).astype(np.float32)
    return _Block(local, items, owners, space, np.array([space[q].sum(axis=0) for q in items]))


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, item_id, passage, share, answer_found, word_start, cosine)``: one row
    per document and benchmark passage found in it."""
    cut = stored(passages(benchmark, window).withColumn(
        "hash", F.xxhash64("item_id", "passage", "stretches")), "passages")
    total = cut.agg(F.sum(F.size("stretches")).alias("n")).first()["n"] or 0
    turns = max(1, -(-total // QUERY_BLOCK))  # each holds about QUERY_BLOCK stretches
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame(
        [], f"doc_id {kind}, item_id {item_kind}, passage int, share double, "
        "answer_found boolean, word_start bigint, cosine double")
    words = cut.select(F.explode(F.flatten("stretches")).alias("word")).distinct().collect()
    terms = {w: k for k, w in enumerate(sorted(r["word"].encode() for r in words))}
    if not terms:
        return out
    idf, parts = _idf(docs, terms), []
    for start in range(0, turns, PASS_BLOCKS):
        names, blocks = [], []
        for turn in range(start, min(turns, start + PASS_BLOCKS)):
            rows = cut.where(F.pmod("hash", F.lit(turns)) == turn).orderBy(
                "item_id", "passage", "hash").collect()
            blocks.append(_block(spark, rows, len(names), terms, idf))
            names += [(len(names) + k, r["item_id"], r["passage"]) for k, r in enumerate(rows)]
        found = docs.select("doc_id", "text").mapInArrow(
            partial(_search, terms=terms, blocks=[b for b in blocks if b],
                    schema=["doc_id", "query", "share", "answer_found", "word_start", "cosine"]),
            f"doc_id {kind}, query int, share double, answer_found boolean, "
            "word_start bigint, cosine double")
        names = F.broadcast(spark.createDataFrame(
            names, f"query int, item_id {item_kind}, passage int"))
        parts.append(found.join(names, "query").select(out.columns))
    return reduce(DataFrame.union, parts)
