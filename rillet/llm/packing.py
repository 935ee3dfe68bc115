"""Best-fit packing of tokenised documents into fixed-length sequences.

Each task tokenises its documents and packs them online: a piece goes to the open bin
with the least free space that takes it. At most ``open_bins`` bins are open; when a
new one is needed beyond that, the fullest closes first. Bins are kept by free space,
and an integer's bits mark which free spaces have a bin, so the best fit is the lowest
set bit at or above the length. Pieces wait in a look-ahead buffer of ``lookahead``
pieces, twice the open bins, and leave it longest first: the packer stays online over
batches that all its bins have seen. Nothing is shuffled.

Defined cases: a null or empty text is one piece with the end id alone; bytes that are no
UTF-8 are read as U+FFFD; a text that the fast library refuses goes through the other;
repeated rows
and null ids are packed like any other; an empty table gives an empty result; columns
other than ``doc_id`` and ``text`` are ignored. ``sequence_id`` is the task's number in
the high bits and a counter in the low 33, so a repeated task gives the same ids.
"""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from rillet.llm.common import text_slices

LENGTH = 1024
END_ID = 2
OPEN_BINS = 512
LOOKAHEAD = 2 * OPEN_BINS
SCHEMA = ("piece int, start bigint, length bigint, ids_crc32 bigint, "
          "sequence_id bigint, offset bigint")


def tokenizer_files() -> tuple[str, str]:
    """Paths of the vocabulary, as the tokenizers and the tiktoken library read it."""
    import public_tokenizers as public

    return public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def _encoder(model: str, ranks: str):
    """``encode(text) -> uint32 ids``, equal to ``Tokenizer.from_file(model)`` without
    special tokens added. The rank file holds the same vocabulary and merges and is
    read by a faster library; texts that spell a special token go to the first."""
    import public_tokenizers as public
    import tiktoken
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(model)
    special = [t.content for t in plain.get_added_tokens_decoder().values()]
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public.PATTERN, mergeable_ranks=table,
                             special_tokens={})

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return np.array(plain.encode(text, add_special_tokens=False).ids, np.uint32)
        try:
            return fast.encode_to_numpy(text, disallowed_special=())
        except ValueError:  # e.g. a run of a million spaces is too deep for its splitter
            return np.array(plain.encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


class Packer:
    """Bounded-space online best-fit. ``place(n)`` gives (sequence, offset)."""

    def __init__(self, length: int = LENGTH, open_bins: int = OPEN_BINS):
        self.length, self.limit = length, open_bins
        self.by_free: list[list[int]] = [[] for _ in range(length + 1)]
        self.bits = self.open = self.made = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, n: int) -> tuple[int, int]:
        fits = self.bits >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.limit:  # the fullest has the least free space
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, number, self.made = self.length, self.made, self.made + 1
        left = free - n
        if left:
            if not self.by_free[left]:
                self.bits |= 1 << left
            self.by_free[left].append(number)
            self.open += 1
        return number, self.length - free


def cut(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; the first may be shorter."""
    first = n % length
    starts = ([(0, first)] if first else [])
    return starts + [(s, length) for s in range(first, n, length)]


def _pack(batches, files, length, end_id, open_bins, lookahead):
    encode = _encoder(*files)
    packer, base = Packer(length, open_bins), TaskContext.get().partitionId() << 33
    waiting: list[tuple] = []

    def flush():
        waiting.sort(key=lambda p: -p[3])
        rows = [(*p, base + s, at) for p in waiting for s, at in [packer.place(p[3])]]
        waiting.clear()
        cols = list(zip(*rows))
        kinds = [id_type, *(pa.int32(), *[pa.int64()] * 5)]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds)], names)

    id_type = None
    for part, texts in text_slices(batches):
        id_type = part.schema.field(0).type
        for doc_id, text in zip(part.column(0).to_pylist(), texts):
            ids = np.append(encode(text.decode("utf-8", "replace")), np.uint32(end_id)).astype("<u4")
            for k, (start, n) in enumerate(cut(len(ids), length)):
                waiting.append((doc_id, k, start, n, zlib.crc32(ids[start:start + n].tobytes())))
                if len(waiting) >= lookahead:
                    yield flush()
    if waiting:
        yield flush()


def pack(docs: DataFrame, files: tuple[str, str] | None = None, length: int = LENGTH,
         end_id: int = END_ID, open_bins: int = OPEN_BINS, lookahead: int = LOOKAHEAD
         ) -> DataFrame:
    """Rows per piece of ``docs(doc_id, text)``: its place in its document, the checksum
    of its ids, and its place in a sequence."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    run = partial(_pack, files=files or tokenizer_files(), length=length, end_id=end_id,
                  open_bins=open_bins, lookahead=lookahead)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {SCHEMA}")
