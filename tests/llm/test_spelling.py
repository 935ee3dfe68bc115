import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from rillet.llm import spelling
from rillet.llm.queries import QUERIES
from rillet.sources.tables import table

from .conftest import SF

LOWER = {c: c + 32 for c in range(65, 91)}


def counted(docs):
    """Words and their counts."""
    out = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def neighbours(words):
    """Near words of each word: equal after the same or no letter is taken out."""
    gaps = {}
    for w in words:
        for k in range(len(w)):
            gaps.setdefault((w[:k], w[k + 1:]), set()).add(w)
    near = {w: set() for w in words}
    for group in gaps.values():  # replaced
        for w in group:
            near[w] |= group - {w}
    for w in words:  # a letter less
        for k in range(len(w)):
            less = w[:k] + w[k + 1:]
            if less in near:
                near[w].add(less)
                near[less].add(w)
    return near


def brute(docs):
    words = counted(docs)
    near, form = neighbours(words), {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words.get(form[w]))
    return out


def of(frame):
    rows = frame.collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("sf", [SF, SF.replace("0.001", "0.01")])
def test_query(spark, sf):
    docs = [tuple(r) for r in table(spark, sf, "documents", "doc_id", "text").collect()]
    found = of(QUERIES["op12_spelling_variants"](spark, sf))
    assert found == brute(docs)
    assert any(f for f, *_ in found.values())


def test_close_words_and_chains(spark):
    """Few letters, so that signatures are shared by many words and forms make chains."""
    rng = random.Random(8)
    docs = []
    for doc in range(60):
        picked = ["".join(rng.choice("abé×") for _ in range(rng.randrange(4, 9))) for _ in range(200)]
        docs.append((doc, " ".join(w for w in picked for _ in range(rng.choice([1, 3])))))
    chain = ["basis", "basiss", "basisss", "basissss"]
    docs += [(100 + k, " ".join(chain[k:k + 1] * 4 ** (k + 1))) for k in range(4)]
    docs += [(None, "Basis, BASISÀ basis"), (1, None), (2, ""), (2, "x" * 3_000 + " " + "y" * 9),
             (3, "x" * 3_000), (4, "x" * 3_000), (5, ("x" * 2_999 + " ") * 9)] * 2
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    frame = frame.selectExpr("*", "'w' word", "1 n", "'k' key", "2 side", "3 h", "'r' run")
    assert of(spelling.variants(frame)) == brute(docs)


def test_groups_do_not_change_the_pairs(spark):
    found = spark.createDataFrame([(w,) for w in counted(
        (r.doc_id, r.text) for r in table(spark, SF, "documents").collect())], "word string")
    few, many = (set(map(tuple, spelling.near(found, g).collect())) for g in (1, 10**9))
    assert few == many
    large = spelling.candidates(found, 10**9).count()
    assert spelling.candidates(found, 1).count() < large / 3


def test_empty(no_docs):
    assert spelling.variants(no_docs).count() == 0
    assert spelling.variants(no_docs.withColumn("doc_id", F.lit("a"))).count() == 0
