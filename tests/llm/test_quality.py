import re
from collections import Counter

import zstandard
from rillet.llm import quality
from rillet.llm.queries import QUERIES
from rillet.sources.tables import table

from .conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
    covered = {k + j for k in range(len(words) - 4)
               if seen[tuple(words[k:k + 5])] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    ratio = len(text.encode()) / len(zstandard.ZstdCompressor(level=3).compress(text.encode()))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:k] for k, x in enumerate(lines)), len(covered), failed, ratio)


def columns(rows):
    return [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
             r.base_failed, r.doc_ratio) for r in rows]


def test_base_matches_brute_force(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op1_compression_bands"](spark, SF).collect()
    assert len(rows) == len(texts)
    assert columns(rows) == [brute(texts[r.doc_id]) for r in rows]
    assert all(not (r.base_failed and r.kept) for r in rows)


def test_clean_documents_stay(spark):
    good = {r.doc_id for r in table(spark, SF, "labels").where("quality = 1").collect()}
    rows = QUERIES["op1_compression_bands"](spark, SF).collect()
    assert all(r.kept for r in rows if r.doc_id in good and not r.base_failed)


def test_odd_rows(odd_docs, odd_rows):
    rows = quality.quality(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    assert sorted(columns(rows)) == sorted(brute(t) for _, t in odd_rows)
    assert not any(r.kept for r in rows if r.doc_id in (1, 2, 3, 4))


def test_bands_reject_repetition_and_noise(spark):
    import base64
    import random
    rng = random.Random(1)
    noise = " ".join(base64.b85encode(rng.randbytes(9)).decode() for _ in range(900))
    near = " ".join(f"the same line again and again number {k}" for k in range(900))
    rows = quality.quality(spark.createDataFrame([(1, noise), (2, near)],
                                                 "doc_id int, text string")).collect()
    verdict = {r.doc_id: (r.base_failed, r.in_band) for r in rows}
    assert verdict[1] == (False, False) and not verdict[2][1]


def test_kept_documents_keep_their_columns(odd_docs, no_docs):
    kept = quality.kept_documents(odd_docs)
    assert kept.schema == odd_docs.schema
    want = {r.doc_id for r in quality.quality(odd_docs).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == want
    assert quality.kept_documents(no_docs).count() == quality.quality(no_docs).count() == 0
