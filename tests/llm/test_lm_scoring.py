import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from rillet.llm import context_tree as tree
from rillet.llm import lm_scoring
from rillet.llm.queries import QUERIES
from rillet.sources.tables import table

from .conftest import SF, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def brute_base(rows):
    counts, docs = Counter(), 0
    for i, t in rows:
        if not held(i):
            counts.update(split(t))
            docs += 1
    if docs:
        counts["\n"] = docs
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        words = [*split(t), "\n"]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        out.append((i, held(i), len(words), sum(counts[w] > 0 for w in words), n, base))
    return out


def brute_tree(rows):
    """log10 of each text by the recursive definition, node by node."""
    counts = defaultdict(lambda: [0, 0])
    children = defaultdict(set)

    def steps(text):
        body = b"\n" * tree.DEPTH + " ".join(split(text)).encode() + b"\n"
        for k in range(tree.DEPTH, len(body)):
            context = body[k - tree.DEPTH:k][::-1]
            for bit in range(8):
                yield context, (1 << bit) | (body[k] >> (8 - bit)), body[k] >> (7 - bit) & 1

    for i, t in rows:
        if not held(i):
            for context, node, one in steps(t):
                for d in range(tree.DEPTH + 1):
                    counts[context[:d], node][one] += 1
                    if d:
                        children[context[:d - 1], node].add(context[:d])
    half = math.log(0.5)
    known = {}

    def weighted(context, node):
        if (context, node) not in known:
            a, b = counts[context, node]
            own = (math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi))
            if len(context) < tree.DEPTH:
                below = sum(weighted(c, node) for c in children[context, node])
                both = np.logaddexp(half + own, half + below)
                known[context, node] = (both, math.exp(half + own - both))
            else:
                known[context, node] = (own, 1.0)
        return known[context, node][0]

    def probability(context, node, one, d=0):
        key = context[:d], node
        a, b = counts[key] if key in counts else (0, 0)
        kt = ((b if one else a) + .5) / (a + b + 1)
        if d == tree.DEPTH:
            return kt
        weighted(*key)
        w = known[key][1]
        return w * kt + (1 - w) * probability(context, node, one, d + 1)

    memo = {}

    def log10(step):
        if step not in memo:
            memo[step] = math.log10(probability(*step))
        return memo[step]

    return [sum(map(log10, steps(t))) for _, t in rows]


def sorted_rows(rows):
    return sorted(rows, key=lambda r: (str(r[0]), r[2], r[5]))


def same_base(rows, texts):
    got = sorted_rows([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score)
                       for r in rows])
    want = sorted_rows(brute_base(texts))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want])


def test_log_gamma_and_keys():
    x = np.array([0.5, 1, 1.5, 2, 7.5, 100, 1e6, 1e12])
    assert tree.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], abs=1e-9)
    bodies = [b"ab\n", b"\n", b"xyz\n"]
    want = []
    for b in bodies:
        full = b"\n" * tree.DEPTH + b
        want += [int.from_bytes(full[k - tree.DEPTH:k][::-1] + full[k:k + 1])
                 for k in range(tree.DEPTH, len(full))]
    assert tree.keys_of(bodies).tolist() == want


def test_query_base_and_held_out_gain(spark):
    texts = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    rows = QUERIES["op2_context_tree"](spark, SF).collect()
    same_base(rows, texts)
    bodies = {i: (" ".join(split(t)) + "\n").encode() for i, t in texts}
    seen = Counter(b for i, t in bodies.items() if not held(i) for b in t)
    total = sum(seen.values())
    out = [r for r in rows if r.held_out]  # against the bytes' own frequencies
    flat = sum(math.log10((seen[b] + 0.5) / (total + 128)) for r in out for b in bodies[r.doc_id])
    assert out and sum(r.score for r in out) > 0.75 * flat
    assert all(r.bits_per_byte == pytest.approx(-r.score * math.log2(10) / r.n_bytes) for r in rows)


def test_scores_match_the_definition(spark):
    rng = random.Random(8)
    texts = [(k, prose(rng, rng.randrange(1, 25), 30)) for k in range(25)]
    texts += [(30, None), (31, ""), (1, "é ñ Ünï"), (None, "no id"), (2, "same"), (2, "same"), (33, "Q" * 90)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    for block, bucket in ((lm_scoring.BLOCK_BYTES, lm_scoring.BUCKET_BYTES), (300, 10)):
        rows = lm_scoring.score(frame, block, bucket).collect()
        same_base(rows, texts)
        want = sorted((str(i), s) for (i, _), s in zip(texts, brute_tree(texts)))
        got = sorted((str(r.doc_id), r.score) for r in rows)
        assert [i for i, _ in got] == [i for i, _ in want]
        assert [s for _, s in got] == pytest.approx([s for _, s in want], rel=1e-5)


def test_odd_rows(odd_docs, odd_rows, no_docs, spark):
    same_base(lm_scoring.score(odd_docs).collect(), odd_rows)
    assert lm_scoring.score(no_docs).count() == 0
    only = next(i for i in range(99) if held(i))
    alone = spark.createDataFrame([(only, "no training here")], "doc_id int, text string")
    row = lm_scoring.score(alone).first()
    assert row.held_out and row.train_tokens == row.n_known == 0 and row.base_score == 0
    assert row.bits_per_byte == pytest.approx(8)
