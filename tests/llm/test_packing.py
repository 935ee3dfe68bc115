import random
import zlib

import numpy as np
from rillet.llm import packing
from rillet.llm.queries import QUERIES
from rillet.sources.tables import table
from tokenizers import Tokenizer

from .conftest import SF


def brute(texts):
    """(doc_id, piece, start, length, crc) of every piece."""
    model = Tokenizer.from_file(packing.tokenizer_files()[0])
    out = []
    for i, t in texts:
        ids = model.encode(t or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids), 1024), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            crc = zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
            out.append((str(i), k, a, b - a, crc))
    return sorted(out)


def valid(rows):
    """Sequences are gapless from 0 and within the length; how many there are."""
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 1024
    return len(bins)


def test_pieces_and_places(spark):
    texts = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    rows = QUERIES["op3_best_fit_packing"](spark, SF).collect()
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == brute(texts)
    full = sum(r.length for r in rows) / 1024
    assert full <= valid(rows) <= 1.05 * full + 3


def test_odd_rows(odd_docs, odd_rows, no_docs, spark):
    extra = [(90, "ends <|endoftext|> here"), (91, "<|endoftext|>")]
    docs = odd_docs.select("doc_id", "text").union(
        spark.createDataFrame(extra, "doc_id bigint, text string"))
    rows = packing.pack(docs).collect()
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32)
                  for r in rows) == brute(odd_rows + extra)
    valid(rows)
    assert packing.pack(no_docs).count() == 0


def test_white_space_and_bytes_that_are_no_text(spark):
    texts = [(1, " " * 1_000_000), (2, "\n" * 1_000_000), (3, "a" + "\t " * 300_000 + "b")]
    rows = packing.pack(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == brute(texts)
    valid(rows)
    docs = spark.sql("select 1 doc_id, cast(X'61FF20C3' as string) text")
    rows = packing.pack(docs).collect()
    assert [(str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows] == brute([(1, "a\ufffd \ufffd")])


def test_near_the_best_fit_of_all_pieces(spark):
    """Whole sf0.1 against best fit of all its pieces, longest first, with bins without end."""
    docs = table(spark, SF.replace("0.001", "0.1"), "documents", "doc_id", "text")
    rows = packing.pack(docs.coalesce(1)).select("length", "sequence_id").collect()
    packer = packing.Packer(packing.LENGTH, 10**9)
    for n in sorted((r.length for r in rows), reverse=True):
        packer.place(n)
    assert len({r.sequence_id for r in rows}) <= 1.005 * packer.made


def test_packer_is_best_fit_and_bounded():
    """Against a plain search over the open bins."""
    rng = random.Random(2)
    packer, bins, made = packing.Packer(64, 5), {}, 0
    for _ in range(3000):
        n = rng.choice([rng.randrange(1, 65), 64, 1])
        number, offset = packer.place(n)
        fits = [free for free in bins.values() if free >= n]
        if fits:
            assert bins[number] == min(fits) == 64 - offset
        else:
            if len(bins) >= 5:
                least = min(bins.values())
                gone = [k for k, v in bins.items() if v == least and k not in
                        packer.by_free[least]]
                assert len(gone) == 1
                del bins[gone[0]]
            assert (number, offset) == (made, 0)
            bins[number], made = 64, made + 1
        bins[number] -= n
        if not bins[number]:
            del bins[number]
        assert len(bins) <= 5 and packer.open == len(bins)


def test_cut():
    assert packing.cut(1024) == [(0, 1024)]
    assert packing.cut(1) == [(0, 1)]
    assert packing.cut(2050) == [(0, 2), (2, 1024), (1026, 1024)]
