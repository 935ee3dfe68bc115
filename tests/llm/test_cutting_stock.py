import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from rillet.llm import cutting_stock
from rillet.llm.queries import QUERIES
from rillet.sources.tables import table
from tokenizers import Tokenizer

from .conftest import SF


def valid(rows, texts, length=4096):
    """Every id lies in one piece, pieces' checksums are right, sequences are gapless; gives
    (padding, documents whose tail is cut)."""
    model = Tokenizer.from_file(cutting_stock.tokenizer_file())
    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    encoded = {}
    for doc_id, text in texts:
        ids = np.array(model.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        encoded.setdefault((doc_id, len(ids)), []).append(ids)
    assert set(encoded) == set(pieces)
    cut = 0
    for key, copies in encoded.items():
        got = sorted((r.start, r.length, r.ids_crc32) for r in pieces[key])
        # one piece starts where another ends, once for each document of this id and size
        assert sum(n for _, n, _ in got) == key[1] * len(copies)
        starts, ends = Counter(s for s, _, _ in got), Counter(s + n for s, n, _ in got)
        starts.subtract(ends)
        assert {k: v for k, v in starts.items() if v} == {0: len(copies), key[1]: -len(copies)}
        for start, n, crc in got:
            assert any(zlib.crc32(ids[start:start + n].tobytes()) == crc for ids in copies)
        cut += len(got) > len(copies) * -(-key[1] // length)
    padding = 0
    for found in places.values():
        at = 0
        for offset, n in sorted(found):
            assert offset == at and n > 0
            at += n
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding, cut


@pytest.mark.parametrize("sf,share", [("0.001", 0.2), ("0.01", 0.08)])
def test_query(spark, sf, share):
    at = SF.replace("0.001", sf)
    texts = [(r.doc_id, r.text) for r in table(spark, at, "documents").collect()]
    padding, cut = valid(QUERIES["op11_cutting_stock"](spark, at).collect(), texts)
    assert padding == 0
    assert cut <= share * len(texts)


def test_odd_rows(odd_docs, odd_rows, no_docs, spark):
    extra = [(90, "ends <|endoftext|> here"), (91, "<|endoftext|>"), (92, " " * 100_000),
             (93, "'s'S it's 'twas' don't''ll"), (94, "Ünḯcöde ẛ̣ 漢字かな 12½ \U0001f600͸")]
    docs = odd_docs.select("doc_id", "text").union(
        spark.createDataFrame(extra, "doc_id bigint, text string"))
    docs = docs.selectExpr("*", "1 class", "2 place", "'a' ids", "3 tail")
    assert valid(cutting_stock.pack(docs).collect(), odd_rows + extra)[0] == 0
    assert cutting_stock.pack(no_docs).count() == 0


def test_bytes_that_are_no_text(spark):
    docs = spark.sql("select 1 doc_id, cast(X'61FF20C3' as string) text")
    rows = cutting_stock.pack(docs).collect()
    assert valid(rows, [(1, "a� �")])[0] == 0


def test_encoder_equals_the_library(monkeypatch):
    model = Tokenizer.from_file(cutting_stock.tokenizer_file())
    fast = cutting_stock.Encoder(cutting_stock.tokenizer_file())
    rng = random.Random(1)
    every = [chr(c) for c in range(0xD800)]
    texts = ["".join(f"a{c}1{c}! {c}" for c in every[k:k + 50]) for k in range(0, 0x400, 50)]
    texts += ["".join(f"a{c}1{c}! {c}" for c in every[k:k + 500]) for k in range(0, len(every), 500)]
    texts += ["".join(rng.choice("ab'sStTreR,. \n\t\xa09é") for _ in range(300)) for _ in range(200)]
    texts += ["", " ", "\n a", "a <|endoftext|> b", "ΟΔΟΣ"]
    want = [model.encode(text, add_special_tokens=False).ids for text in texts]
    assert [i.tolist() for i in fast.batch(texts)] == want
    assert [i.tolist() for i in fast.batch(texts)] == want  # known words
    monkeypatch.setattr(cutting_stock, "STRETCH", 40)
    monkeypatch.setattr(cutting_stock, "KNOWN_WORDS", 30)
    assert [fast.ids(text).tolist() for text in texts] == want


def test_encoder_equals_the_library_on_its_vocabulary():
    """Every token as a word and within one, and words made of random tokens."""
    model = Tokenizer.from_file(cutting_stock.tokenizer_file())
    encoder = cutting_stock.Encoder(cutting_stock.tokenizer_file())
    ranks = cutting_stock.merge_ranks(model.get_vocab(with_added_tokens=False))
    assert len(ranks) == len(set(ranks.values())) == 49406
    tokens = [r.decode("utf-8", "ignore").replace(cutting_stock.MARK, "") for r in ranks]
    tokens = [t for t in tokens if t and not cutting_stock.UNSPLIT.search(t)]
    rng = random.Random(2)
    words = tokens + [f"{t}x" for t in tokens] + [f"x{t}" for t in tokens]
    words += ["".join(rng.choices(tokens, k=rng.randrange(2, 6))) for _ in range(30000)]
    words += ["it's", "'s", "''s", "x''s's", "'sts", "we'llx'", "'re've1'd", "!'s", "1's", "'re", "r'e", "'l", "a'", "'"]
    texts = [" ".join(words[k:k + 500]) for k in range(0, len(words), 500)]
    for text, ids in zip(texts, encoder.batch(texts)):
        assert ids.tolist() == model.encode(text, add_special_tokens=False).ids


def test_library_gets_odd_words_alone():
    """A mark or a word beyond the fast path leaves the text's other words on it."""
    encoder = cutting_stock.Encoder(cutting_stock.tokenizer_file())
    model, seen = encoder.plain, []

    class Watched:
        def encode(self, text, **more):
            seen.append(text)
            return model.encode(text, **more)

    encoder.plain = Watched()
    texts = ["The house\u2019s own, it's 12 words!!! (caf\xe9) " * 50, "one \u2014 two \u0394x three", "ab" * 200,
             "some<|endoftext|>text ends", "", " \u3000 \x85\xa0"]
    want = [model.encode(text, add_special_tokens=False).ids for text in texts]
    assert [ids.tolist() for ids in encoder.batch(texts)] == want
    assert sorted(seen) == sorted(["house\u2019s", "\u2014", "\u0394x", "ab" * 200, "some<|endoftext|>text"])
    assert [ids.tolist() for ids in encoder.batch([""])] == [[]]


def test_linear_program_against_all_patterns():
    """No pattern has a negative reduced cost, and demands are met exactly."""
    rng = random.Random(4)
    for _ in range(20):
        widths = np.array(sorted(rng.sample(range(1, 15), 5)))
        demand = np.array([rng.randrange(1, 60) for _ in widths])
        patterns, x = cutting_stock.solve(widths, demand, 16, 0)
        assert np.allclose(patterns.T @ x, demand, atol=1e-6)
        assert ((patterns @ widths) <= 16).all()
        duals = cutting_stock.inverse_of(patterns) @ np.ones(len(widths))
        every = [c for c in itertools.product(*[range(16 // w + 1) for w in widths])
                 if np.dot(c, widths) <= 16]
        assert max(np.dot(c, duals) for c in every) <= 1 + 1e-6
        value, best = cutting_stock.price(np.maximum(duals, 0), widths, 16)
        assert value == pytest.approx(max(np.dot(c, np.maximum(duals, 0)) for c in every))
        assert np.dot(best, widths) <= 16
        kept = cutting_stock.plan(widths, demand, 10**9, 16)
        assert (sum(p * n for p, n in kept) == demand).all()
        assert sum(n for _, n in kept) <= np.ceil(x.sum()) + 2


def test_degenerate_programs_end():
    """Many classes of equal demand, as small tables have them; near the bound by size."""
    for seed in range(2):
        rng = np.random.default_rng(seed)
        widths = np.sort(rng.choice(np.arange(1, 257), 100, replace=False))
        demand = rng.integers(1, 4, 100) if seed % 2 else np.full(100, 30)
        patterns, x = cutting_stock.solve(widths, demand, 256)
        assert np.allclose(patterns.T @ x, demand, atol=1e-3)
        back = cutting_stock.inverse_of(patterns)
        assert np.allclose(np.einsum("ij,jk->ik", back, patterns), np.eye(100), atol=1e-6)
        _, best = cutting_stock.price(np.maximum(back.sum(axis=1), 0), widths, 256)
        assert x.sum() >= demand @ widths / 256 - 1e-6 and best @ widths <= 256


def test_hot_length(spark):
    """Most documents have one length; a few sequences' worth of others."""
    docs = [(k, "word " * 1500) for k in range(300)] + [(300 + k, "word " * (k % 40)) for k in range(100)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    assert valid(cutting_stock.pack(frame).collect(), docs)[0] == 0
