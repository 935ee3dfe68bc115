"""Packing as a cutting-stock problem solved by column generation.

A document's full sequences are cut off first; what is left of it, its tail, is an item
shorter than a sequence. Tails are counted by length class (``UNIT`` tokens wide, so at most
``length / UNIT`` rows reach the driver). Over this histogram a linear program finds how
often to use which pattern, a multiset of classes that fits a sequence: a revised simplex
whose columns are priced by a knapsack dynamic program over the dual values, until no
pattern has a negative reduced cost. Multiplicities are rounded down, then up where tails
remain, and what is left of a class makes new patterns by a bounded knapsack.

Tails are ranked within their class: a task numbers its own, and the counts of (task, class)
give where each task starts. A pattern owns a range of ranks of each of its classes, so a
tail's rank says its sequence. All of this is joins on small tables; documents are not
collected and no class is sorted in one task.

Classes are rounded up, so a sequence of whole tails keeps a small gap. At most as many
sequences are made as all tails could fill; the tails of no sequence are cut to fill the
gaps, by laying gaps and these tails end to end on one line and joining both by position.
What then remains fills sequences of its own, the last ones with a power of two of tokens
each, so that nothing is padded. Tails in a pattern are never cut.

Defined cases: a null or empty text is the end id alone; bytes that are no UTF-8 are read as
U+FFFD; repeated rows and null ids are packed like any other; an empty table gives an empty
result; columns other than ``doc_id`` and ``text`` are ignored. Sequence ids: patterns from
0, then cut tails, and from 2^62 on sequences that one document fills.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.common import stored, text_slices
from rillet.operators.joins import bounded_broadcast

LENGTH = 4096
END_ID = 2
UNIT = 16
#: The linear program ends within this share of its optimum, or after so many pivots a class
#: that leave its objective as it is.
GAP, STALL = 1e-4, 2
#: First id of sequences that one document fills.
WHOLE = 1 << 62
#: Words encoded together at the most.
KNOWN_WORDS = 1 << 18
#: Longer words are left to the library, whose merges take no square of a word's length.
LONGEST = 256
#: A text is tokenised in stretches of about this many code points, cut at white space.
STRETCH = 1 << 21
#: Rows of one bucket of a prefix sum; tokens of one bucket of the line of gaps.
SUM_ROWS, LINE_TOKENS = 512, 4096

#: Written behind each part of a word that is merged by itself, and behind a word. Texts with
#: such characters are left to the library, which takes them for no white space.
MARK, EDGE = "\x1d", "\x1e"
UNSPLIT = re.compile("[\x1c-\x1f]")
SPACE = re.compile(r"\s")
#: Words with other characters are left to the library: below U+0300 a word is in normal form
#: and lower case goes letter by letter.
UNSURE = r"[\x{130}\x{300}-\x{10FFFF}]"
#: Kinds of characters.
BLANK, LETTER, NUMBER, OTHER = range(4)


def tokenizer_file() -> str:
    import public_tokenizers as public

    return public.path("word_bpe_49k.json")


def _kinds() -> np.ndarray:
    """Kind of every code point below U+10000."""
    kinds = {"L": LETTER, "N": NUMBER}
    found = [BLANK if chr(c).isspace() else kinds.get(unicodedata.category(chr(c))[0], OTHER)
             for c in range(1 << 16)]
    return np.array(found, np.uint8)


def merge_ranks(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """The vocabulary's tokens as bytes, the end of a word as ``MARK``. Ids grow in the order
    of the merges, and each token comes of one merge, so that joining the neighbours of the
    least id gives what the merges give."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
    ranks = {}
    for token, id_ in vocabulary.items():
        stem = token.removesuffix("</w>")
        ranks[bytes(byte[c] for c in stem) + (b"" if stem == token else MARK.encode())] = id_
    return ranks


class Encoder:
    """Ids of texts, equal to the library's ``encode`` without special tokens added. No
    token spans white space in this vocabulary, so the distinct words of many texts are
    encoded once, through a faster library that reads the same vocabulary, and ids are
    gathered by word."""

    def __init__(self, model: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(model)
        self.special = [t.content for t in self.plain.get_added_tokens_decoder().values()]
        ranks = merge_ranks(self.plain.get_vocab(with_added_tokens=False))
        self.fast = tiktoken.Encoding("words", pat_str=f"{EDGE}|[^{MARK}{EDGE}]+{MARK}",
                                      mergeable_ranks=ranks, special_tokens={})
        self.edge = ranks[EDGE.encode()]
        self.unsure = "|".join([UNSURE, *map(re.escape, self.special)])
        self.kinds = _kinds()

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, np.uint32)

    def _marked(self, words: list[str]) -> str:
        """Words with a mark behind each part that the library would merge by itself: a
        contraction, a run of letters, a single number, a run of others."""
        codes = np.frombuffer((" ".join(words).lower() + " ").encode("utf-16-le"), np.uint16)
        kind = self.kinds[codes]
        starts = kind == NUMBER
        starts[1:] |= kind[1:] != kind[:-1]
        starts[0] = True
        # an apostrophe within a run of others is none of a contraction
        at = np.flatnonzero((codes == ord("'")) & starts)
        at = at[kind[at + 1] == LETTER]
        pair = codes[at + 1].astype(np.uint32) << 16 | codes[at + 2]
        size = np.where(np.isin(codes[at + 1], [ord(c) for c in "stmd"]), 1, np.where(
            np.isin(pair, [ord(a) << 16 | ord(b) for a, b in ("re", "ve", "ll")]), 2, 0))
        at, size = at[size > 0], size[size > 0]
        starts[at + 1] = False
        starts[at + 1 + size] = True
        marks = starts.copy()
        marks[1:] &= kind[:-1] != BLANK
        marks[0] = False
        out = np.full(len(codes) + int(marks.sum()), ord(MARK), np.uint16)
        out[np.arange(len(codes)) + np.cumsum(marks)] = np.where(kind == BLANK, ord(EDGE), codes)
        return out.tobytes().decode("utf-16-le")

    def _sure(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word) of words for the faster library."""
        found = self.fast.encode_to_numpy(self._marked(words), disallowed_special=())
        edge = found == self.edge
        return found[~edge], np.diff(np.flatnonzero(edge), prepend=-1) - 1

    def _lookup(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, each word's first place there, number of its ids) of distinct words."""
        left = pc.or_(pc.greater(pc.utf8_length(words), LONGEST),
                      pc.match_substring_regex(words, self.unsure)).to_numpy(zero_copy_only=False)
        ids, sizes = [], np.zeros(len(words), np.int64)
        sure = np.flatnonzero(~left)
        for k in range(0, len(sure), KNOWN_WORDS):
            some = sure[k:k + KNOWN_WORDS]
            found, sizes[some] = self._sure(words.take(pa.array(some)).to_pylist())
            ids.append(found)
        for k in np.flatnonzero(left):
            ids.append(self._encode(words[int(k)].as_py()))
            sizes[k] = len(ids[-1])
        order = np.concatenate([sure, np.flatnonzero(left)])
        first = np.zeros(len(words), np.int64)
        first[order] = np.cumsum(sizes[order]) - sizes[order]
        return np.concatenate([*ids, np.zeros(0, np.uint32)]), first, sizes

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list = [None] * len(texts)
        sure = []
        for k, text in enumerate(texts):
            if UNSPLIT.search(text):
                out[k] = self._encode(text)
            else:
                sure.append(k)
        split = pc.utf8_split_whitespace(pa.array([texts[k] for k in sure], pa.large_string()))
        words = split.flatten().dictionary_encode()
        index = words.indices.to_numpy()
        flat, first, sizes = self._lookup(words.dictionary)
        sizes = sizes[index]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        gathered = flat[np.repeat(first[index] - (ends - sizes), sizes) + np.arange(total)]
        ends = np.concatenate([[0], ends])
        offsets = np.asarray(split.offsets.to_numpy())
        for k, a, b in zip(sure, ends[offsets[:-1]], ends[offsets[1:]]):
            out[k] = gathered[a:b]
        return out

    def ids(self, text: str) -> np.ndarray:
        """Ids of one text of any length, by stretches that end at white space."""
        parts, start = [], 0
        if UNSPLIT.search(text):
            return self._encode(text)
        while start < len(text):
            space = SPACE.search(text, start + STRETCH)
            stop = space.start() if space else len(text)
            parts += self.batch([text[start:stop]])
            start = stop
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


_encoder = lru_cache(maxsize=2)(Encoder)


# ---- the linear program (driver, over the histogram) ------------------------------------
def price(values: np.ndarray, widths: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the multiset of classes of the largest value within ``room``."""
    best, took = np.zeros(room + 1), np.full(room + 1, -1)
    use = np.flatnonzero(values > 1e-12)
    w, v = widths[use], values[use]
    for c in range(1, room + 1):
        best[c] = best[c - 1]
        fits = w <= c
        if fits.any():
            gain = best[c - w[fits]] + v[fits]
            k = int(gain.argmax())
            if gain[k] > best[c] + 1e-12:
                best[c], took[c] = gain[k], np.flatnonzero(fits)[k]
    count, c = np.zeros(len(widths)), room
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            count[use[took[c]]] += 1
            c -= w[took[c]]
    return float(best[room]), count


def inverse_of(matrix: np.ndarray) -> np.ndarray:
    """Inverse by row operations. Threaded linear algebra may hang in a driver process that
    has started a JVM; these loops use none, and 256 rows take a tenth of a second."""
    n = len(matrix)
    rows = np.hstack([matrix, np.eye(n)])
    for k in range(n):
        best = k + int(np.abs(rows[k:, k]).argmax())
        if best != k:
            rows[[k, best]] = rows[[best, k]]
        rows[k] /= rows[k, k]
        factor = rows[:, k].copy()
        factor[k] = 0
        rows -= factor[:, None] * rows[k]
    return rows[:, n:]


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    return np.einsum("ij,j->i", matrix, vector)


def solve(widths: np.ndarray, demand: np.ndarray, room: int, gap: float = GAP
          ) -> tuple[np.ndarray, np.ndarray]:
    """(patterns as rows, multiplicities) of the least number of sequences, fractions
    allowed: a revised simplex that prices columns by ``price``. The best column's value
    bounds the optimum from below (the duals divided by it are feasible), so the search ends
    within ``gap`` of it. Degenerate pivots may go round without end on floating numbers: it
    ends as well if the objective has not fallen for ``STALL`` pivots a class. Every basis on
    the way is a plan that meets the demand."""
    m = len(widths)
    patterns = np.diag((room // widths).astype(float))
    inverse = np.diag(1 / patterns.diagonal())
    # slightly unlike demands, so that rows seldom tie
    shifted = demand * (1 + 1e-6 * np.random.default_rng(1).random(m))
    x, pivots, least, since = _times(inverse, shifted), 0, 1e300, 0
    while True:
        duals = inverse.sum(axis=0)
        value, column = price(duals, widths, room)
        since = 0 if x.sum() < least - 1e-9 * least else since + 1
        least = min(least, float(x.sum()))
        if value <= 1 + max(gap, 1e-9) or since > STALL * m:
            break
        step = _times(inverse, column)
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        row = int(ratio.argmin())
        if not np.isfinite(ratio[row]):
            break
        patterns[:, row] = column
        pivots += 1
        if pivots % 128 == 0:
            inverse = inverse_of(patterns)
        else:
            pivot = inverse[row] / step[row]
            inverse -= step[:, None] * pivot
            inverse[row] = pivot
        x = np.maximum(_times(inverse, shifted), 0)
    return patterns.T, np.maximum(_times(inverse_of(patterns), demand.astype(float)), 0)


def fullest(widths: np.ndarray, left: np.ndarray, room: int) -> np.ndarray:
    """Bounded knapsack: counts of at most ``left`` per class that fill ``room`` most;
    wide classes are preferred."""
    reach = np.full(room + 1, -1)
    reach[0] = len(widths)
    used = np.zeros(room + 1, int)
    for k in np.argsort(-widths):
        if left[k] <= 0:
            continue
        w, used = int(widths[k]), np.zeros(room + 1, int)
        for c in range(w, room + 1):
            if reach[c] < 0 and reach[c - w] >= 0 and used[c - w] < left[k]:
                reach[c], used[c] = k, used[c - w] + 1
    c, count = int(np.flatnonzero(reach >= 0)[-1]), np.zeros(len(widths), int)
    while c > 0:
        count[reach[c]] += 1
        c -= int(widths[reach[c]])
    return count


def plan(widths: np.ndarray, demand: np.ndarray, most: int, room: int
         ) -> list[tuple[np.ndarray, int]]:
    """Whole patterns with their multiplicities, ``most`` sequences at the most, the
    fullest first; no class is used beyond its demand."""
    if not len(widths) or not most:
        return []
    patterns, x = solve(widths, demand, room)
    patterns = np.rint(patterns).astype(int)
    left, made = demand.astype(int).copy(), []

    def use(pattern, times):
        some = pattern > 0
        times = min(times, int((left[some] // pattern[some]).min())) if some.any() else 0
        if times > 0:
            left[:] -= pattern * times
            made.append((pattern, times))

    for pattern, times in zip(patterns, np.floor(x + 1e-6).astype(int)):
        use(pattern, int(times))
    for k in np.argsort(-(x - np.floor(x + 1e-6))):
        use(patterns[k], 1)
    while left.any():  # few: each pattern of the program left less than one sequence
        count = fullest(widths, left, room)
        use(count, int(left.max()))
    made.sort(key=lambda p: -int(p[0] @ widths))
    kept, room_left = [], most
    for pattern, times in made:
        times = min(times, room_left)
        if times:
            kept.append((pattern, times))
            room_left -= times
    return kept


def slots(kept: list[tuple[np.ndarray, int]], classes: np.ndarray) -> list[tuple]:
    """(class, first rank, end rank, tails a sequence, first sequence) of every class of
    every pattern."""
    rows, at, base = [], np.zeros(len(classes), int), 0
    for pattern, times in kept:
        for k in np.flatnonzero(pattern):
            n = int(pattern[k])
            rows.append((int(classes[k]), int(at[k]), int(at[k]) + n * times, n, base))
            at[k] += n * times
        base += times
    return rows


# ---- tokenising -------------------------------------------------------------------------
def _measure(batches, model, length, end_id, unit):
    """Per document: its tokens, the checksums of its full sequences, its tail."""
    encoder, part = _encoder(model), TaskContext.get().partitionId()
    ranks, whole, kind = np.zeros(length // unit + 2, int), 0, None
    narrow = "<u2" if encoder.plain.get_vocab_size() <= 1 << 16 else "<u4"
    names = ["doc_id", "tokens", "whole", "first", "tail", "crc", "ids", "class", "part", "rank"]
    types = [pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.int64(), pa.binary(),
             pa.int32(), pa.int64(), pa.int64()]
    for slice_, texts in text_slices(batches):
        kind = slice_.schema.field(0).type
        rows = []
        texts = [t.decode("utf-8", "replace") for t in texts]
        found = encoder.batch(texts) if len(texts) > 1 else [encoder.ids(t) for t in texts]
        for doc_id, ids in zip(slice_.column(0).to_pylist(), found):
            ids = np.append(ids, np.uint32(end_id)).astype("<u4")
            full = len(ids) // length
            crcs = [zlib.crc32(ids[k * length:(k + 1) * length].tobytes()) for k in range(full)]
            tail = ids[full * length:]
            size = -(-len(tail) // unit)
            rows.append((doc_id, len(ids), crcs, whole, len(tail), zlib.crc32(tail.tobytes()),
                         tail.astype(narrow).tobytes(), size, part, int(ranks[size])))
            ranks[size] += 1
            whole += full
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), [kind, *types])], names)


def _checksums(batches, width):
    """Checksums of pieces as unsigned 32-bit ids from their stored bytes."""
    for batch in batches:
        crcs = [zlib.crc32(np.frombuffer(b, f"<u{width}").astype("<u4").tobytes())
                for b in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(crcs, pa.int64())], [*batch.schema.names[:-1], "ids_crc32"])


# ---- placing ----------------------------------------------------------------------------
def running(rows: DataFrame, group: str, order: str, size: str, out: str) -> DataFrame:
    """``out``: the sum of ``size`` over the rows before, in the order of (group, order),
    which is unique. Summed within buckets of ``SUM_ROWS`` orders; only one row a bucket
    meets in one window."""
    bucket = F.floor(F.col(order) / SUM_ROWS).alias("__b")
    rows = rows.withColumn("__b", bucket)
    sums = rows.groupBy(group, "__b").agg(F.sum(size).alias("__s"))
    base = F.coalesce(F.sum("__s").over(Window.orderBy(group, "__b").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(group, "__b", base.alias("__base"))
    inner = Window.partitionBy(group, "__b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.join(sums, [group, "__b"])
            .withColumn(out, F.col("__base") + F.coalesce(F.sum(size).over(inner), F.lit(0)))
            .drop("__b", "__base"))


def _on_line(rows: DataFrame, at: str, size: str) -> DataFrame:
    """A row per stretch of the line that an interval touches."""
    last = F.col(at) + F.col(size) - 1
    return rows.withColumn("stretch", F.explode(F.sequence(
        F.floor(F.col(at) / LINE_TOKENS), F.floor(last / LINE_TOKENS))))


def pack(docs: DataFrame, model: str | None = None, length: int = LENGTH, end_id: int = END_ID,
         unit: int = UNIT) -> DataFrame:
    """Rows per piece of ``docs(doc_id, text)`` with its place in a sequence."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    measure = partial(_measure, model=model or tokenizer_file(), length=length, end_id=end_id, unit=unit)
    read = stored(docs.select("doc_id", "text").mapInArrow(
        measure, f"doc_id {kind}, tokens bigint, whole array<bigint>, first bigint, tail int, "
                 "crc bigint, ids binary, class int, part bigint, rank bigint"), "measured")

    # full sequences of one document
    whole = read.select("doc_id", "tokens", "part", "first", F.posexplode("whole").alias("k", "crc"))
    whole = whole.select(
        "doc_id", (F.col("k").cast("bigint") * length).alias("start"),
        F.lit(length).cast("bigint").alias("length"), F.col("crc").alias("ids_crc32"),
        F.col("tokens").alias("doc_tokens"),
        (F.lit(WHOLE) + F.shiftleft("part", 33) + F.col("first") + F.col("k")).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"))

    # the histogram: one row a class
    counts = read.where("tail > 0").groupBy("part", "class").agg(
        F.count(F.lit(1)).alias("n"), F.sum("tail").alias("t"))
    counts = stored(counts, "counts")
    histogram = sorted(counts.groupBy("class").agg(F.sum("n"), F.sum("t")).collect())
    classes, demand = (np.array([h[k] for h in histogram], int) for k in (0, 1))
    total = sum(h[2] for h in histogram)
    kept = plan(classes, demand, total // length, length // unit)
    made = sum(times for _, times in kept)
    places = slots(kept, classes)
    used: dict[int, int] = {}
    for c, _, end, _, _ in places:
        used[c] = max(used.get(c, 0), end)

    # ranks within a class
    offsets = counts.select("part", "class", (F.sum("n").over(
        Window.partitionBy("class").orderBy("part")) - F.col("n")).alias("base"), "n")
    limit = spark.createDataFrame([(int(c), used.get(int(c), 0)) for c in classes],
                                  "class int, used bigint")  # a row a class
    offsets = stored(offsets.join(F.broadcast(limit), "class"), "offsets")
    tails = (read.where("tail > 0").drop("whole", "first", "ids")
             .join(bounded_broadcast(offsets.select("part", "class", "base")), ["part", "class"])
             .withColumn("place", F.col("base") + F.col("rank")))
    table = spark.createDataFrame(  # a row per class of a pattern
        places, "of int, low bigint, high bigint, each bigint, seq bigint")
    fits = ((F.col("class") == F.col("of")) & (F.col("place") >= F.col("low"))
            & (F.col("place") < F.col("high")))
    at = F.col("place") - F.col("low")
    put = tails.join(F.broadcast(table), fits).select(
        "doc_id", (F.col("tokens") - F.col("tail")).alias("start"), F.col("tail").alias("length"),
        F.col("crc").alias("ids_crc32"), F.col("tokens").alias("doc_tokens"),
        (F.col("seq") + F.floor(at / F.col("each"))).alias("sequence_id"), "class",
        (at % F.col("each")).alias("slot"))
    one = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "slot")
    put = stored(put.withColumn("end", F.sum("length").over(one)), "placed")
    whole_tails = put.select("doc_id", "start", F.col("length").cast("bigint"), "ids_crc32",
                             "doc_tokens", "sequence_id", (F.col("end") - F.col("length")).alias("offset"))

    # gaps of these sequences, then sequences of cut tails alone
    gaps = put.groupBy("sequence_id").agg(F.max("end").alias("from")).withColumn(
        "room", F.lit(length) - F.col("from")).where("room > 0")
    rest = total - made * length
    more = spark.range(rest // length).select(
        (F.col("id") + made).alias("sequence_id"), F.lit(0).cast("bigint").alias("from"),
        F.lit(length).cast("bigint").alias("room"))
    powers = [(made + rest // length + k, 0, 1 << b) for k, b in enumerate(
        b for b in range(length.bit_length()) if rest % length >> b & 1)]
    more = more.union(spark.createDataFrame(powers, "sequence_id bigint, from bigint, room bigint"))
    gaps = gaps.withColumn("kind", F.lit(0)).unionByName(more.withColumn("kind", F.lit(1)))
    gaps = running(gaps, "kind", "sequence_id", "room", "gap")

    # tails beyond the patterns, end to end
    beyond = offsets.where("base + n > used").select("part", "class", "base", "used")
    cut = (read.where("tail > 0").drop("whole", "first", "crc").join(bounded_broadcast(beyond), ["part", "class"])
           .withColumn("place", F.col("base") + F.col("rank")).where("place >= used"))
    cut = stored(cut.select("doc_id", "tokens", "tail", "ids", "class", "place"), "cut")
    line = running(cut.select("class", "place", "tail"), "class", "place", "tail", "at")
    a, b = _on_line(gaps, "gap", "room").alias("a"), _on_line(line, "at", "tail").alias("b")
    low, high = F.greatest("gap", "at"), F.least(F.col("gap") + F.col("room"), F.col("at") + F.col("tail"))
    pieces = (a.join(b, (F.col("a.stretch") == F.col("b.stretch")) & (low < high)
                     & (F.floor(low / LINE_TOKENS) == F.col("a.stretch")))
              .select("class", "place", (low - F.col("at")).alias("skip"), (high - low).alias("length"),
                      "sequence_id", (F.col("from") + low - F.col("gap")).alias("offset")))
    width = F.floor(F.length("ids") / F.col("tail"))
    bytes_ = F.substring("ids", (F.col("skip") * width + 1).cast("int"), (F.col("length") * width).cast("int"))
    filled = pieces.join(cut, ["class", "place"]).select(
        "doc_id", (F.col("tokens") - F.col("tail") + F.col("skip")).alias("start"), "length",
        F.col("tokens").alias("doc_tokens"), "sequence_id", "offset", bytes_.alias("bytes"))
    filled = filled.mapInArrow(
        partial(_checksums, width=2 if vocabulary(model) <= 1 << 16 else 4),
        f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
        "offset bigint, ids_crc32 bigint")
    return whole.unionByName(whole_tails).unionByName(filled)


def vocabulary(model: str | None = None) -> int:
    """Number of ids of the tokenizer."""
    return _encoder(model or tokenizer_file()).plain.get_vocab_size()
