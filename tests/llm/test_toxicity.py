import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from rillet.llm import toxicity
from rillet.llm.queries import QUERIES
from rillet.sources.tables import table

from .conftest import SF, prose


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def test_features_are_sets_of_grams():
    one = set(toxicity.features(b"a b c d e").tolist())
    assert len(one) == 5 + 4 + 3 + 2  # words, pairs and skips of one and two words
    assert set(toxicity.features(b"A b, c! d e. a").tolist()) >= one
    assert toxicity.features(b"a a a a a").tolist() == sorted(set(toxicity.features(b"a a a a").tolist()))
    assert len(toxicity.features(b" \n")) == 0


def test_ftrl_matches_the_scalar_update():
    rng = random.Random(1)
    model = toxicity.Ftrl(alpha=0.3, beta=1.0, l1=0.4, l2=0.2, bits=4)
    z, n = Counter(), Counter()

    def weight(k):
        l1 = 0.0 if k == 16 else 0.4
        if abs(z[k]) <= l1:
            return 0.0
        return (math.copysign(l1, z[k]) - z[k]) / ((1.0 + math.sqrt(n[k])) / 0.3 + 0.2)

    for _ in range(400):
        at = sorted(rng.sample(range(16), rng.randrange(0, 6)))
        label = int(3 in at or rng.random() < 0.1)
        model.learn(np.array(at, np.int64), label)
        every = [*at, 16]
        g = 1 / (1 + math.exp(-sum(map(weight, every)))) - label
        for k, w in [(k, weight(k)) for k in every]:
            z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / 0.3 * w
            n[k] += g * g
    assert model.weights(np.arange(17)) == pytest.approx([weight(k) for k in range(17)])


def auc(pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
    rows = QUERIES["op7_ftrl_toxicity"](spark, sf).collect()
    assert len(rows) == table(spark, sf, "documents").count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1
               and r.predicted == (r.score >= 0.5) for r in rows)
    out = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert auc(out) > 0.97
    assert sum((s >= 0.5) == y for s, y in out) > 0.96 * len(out)


def test_held_out_labels_change_nothing(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    same = labels.selectExpr(
        "doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - toxic else toxic end toxic")
    a = toxicity.fit(docs, labels, bits=12)
    assert np.array_equal(a, toxicity.fit(docs, same, bits=12))
    assert not np.array_equal(a, toxicity.fit(docs, labels.selectExpr("doc_id", "1 - toxic toxic"), bits=12))


def test_the_sample_is_bounded(spark):
    rows = [(7 if k % 2 else k, f"text {k}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)], "doc_id int, toxic int")
    assert toxicity.fit(docs, labels, rows=10, epochs=1, bits=8) is not None


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    rng = random.Random(2)
    known = [(1000 + k, prose(rng, 20) + (" foul" * (k % 3 == 0))) for k in range(600)]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(known, "doc_id bigint, text string"))
    labels = spark.createDataFrame(
        [(i, int("foul" in t), 1.0) for i, t in known] + [(None, 1, 1.0), (4, None, 1.0), (5, 0, 1.0)],
        "doc_id bigint, toxic int, score double")
    rows = toxicity.score(docs, labels).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in odd_rows + known)
    empty = {r.score for r in rows if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1
    texts = dict(known)
    assert all(r.predicted == ("foul" in texts[r.doc_id]) for r in rows if r.doc_id in texts)
    assert {r.score for r in toxicity.score(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score(no_docs, labels).count() == 0
