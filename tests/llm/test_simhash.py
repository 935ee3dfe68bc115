import random
import re

import xxhash
from rillet.llm import simhash
from rillet.llm.components import components
from rillet.llm.queries import QUERIES
from rillet.sources.tables import table

from .conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_print(text):
    text = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    words = WORD.findall(text)
    grams = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute_classes(prints):
    """{(id, fp)} -> least id reachable, by a search over all pairs."""
    nodes = {}
    for i, fp in prints:
        nodes.setdefault(fp, []).append(i)
    left, out = set(nodes), {}
    while left:
        todo = [left.pop()]
        group = list(todo)
        while todo:
            x = todo.pop()
            near = [y for y in left if (x ^ y).bit_count() <= 3]
            left.difference_update(near)
            todo += near
            group += near
        least = min((i for fp in group for i in nodes[fp] if i is not None), default=None)
        out |= {fp: least for fp in group}
    return out


def same(rows, texts):
    prints = [(i, brute_print(t)) for i, t in texts]
    classes = brute_classes(prints)
    want = sorted((str(i), f"{fp:016x}", str(classes[fp])) for i, fp in prints)
    assert sorted((str(i), fp, str(c)) for i, fp, c in rows) == want


def test_query_matches_brute_force(spark):
    texts = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    same(QUERIES["op6_simhash"](spark, SF).collect(), texts)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    found = simhash.near_duplicates(odd_docs).select(
        "doc_id", simhash.hex_of(), "component_id")
    same([tuple(r) for r in found.collect()], odd_rows)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_a_fingerprint_that_a_third_of_the_rows_share(spark, odd_rows, monkeypatch):
    """Hot and other fingerprints and groups take their own joins."""
    texts = odd_rows + [(1000 + k, "the same five words here") for k in range(40)]
    texts += [(2000 + k, f"text number {k} of its own kind {k * 7}") for k in range(40)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    for share in (1, 4, 10**6):  # none hot, some, all
        monkeypatch.setattr(simhash, "HOT", share)
        found = simhash.near_duplicates(docs).select("doc_id", simhash.hex_of(), "component_id")
        same([tuple(r) for r in found.collect()], texts)


def test_links_of_a_dense_group_and_large_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = random.Random(5)
    base = rng.getrandbits(64)
    fps = {base}
    while len(fps) < 400:  # a chain of near copies, and strangers
        x = rng.choice(sorted(fps)[-50:])
        for _ in range(rng.randrange(1, 4)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(300)}
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    frame = spark.createDataFrame(signed, "fp bigint")
    linked = simhash.links(frame)
    roots = {r.node & (2**64 - 1): r.root for r in components(linked).collect()}
    want = brute_classes([(x, x) for x in fps])
    groups = {}
    for x in fps:
        groups.setdefault(want[x], set()).add(x)
    for members in groups.values():
        assert len({roots.get(x) for x in members}) == 1
        assert len(members) == 1 or roots[next(iter(members))] is not None
    assert len(set(roots.values())) == sum(len(g) > 1 for g in groups.values())


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 200)] + [(500, 501), (7, 7)],
                                  "a bigint, b bigint")
    rows = components(edges).collect()
    assert {(r.node, r.root) for r in rows} == (
        {(k, 1) for k in range(1, 201)} | {(500, 500), (501, 500)})
    assert components(edges.limit(0)).count() == 0
