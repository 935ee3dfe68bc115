import random

import xxhash
from rillet.llm import substring_dedup as dedup
from rillet.llm.queries import QUERIES
from rillet.sources.tables import table

from .conftest import SF, prose


def brute_cuts(text, reach=dedup.REACH):
    """Places by the rule, one by one."""
    h = [0] * len(text)
    roll = 0
    for i, b in enumerate(text):
        roll = ((roll << 1) + int(dedup._TABLE[b])) % 2**64
        if i >= dedup.GEAR:
            roll = (roll - (int(dedup._TABLE[text[i - dedup.GEAR]]) << dedup.GEAR)) % 2**64
        h[i] = (roll * 0x9E3779B97F4A7C15 % 2**64) >> 16
        if i + 1 < len(text) and text[i + 1] & 0xC0 == 0x80:
            h[i] = 0
    inside = range(dedup.GEAR + reach, len(text) - reach)
    top = {i: (max(h[i - reach:i]), max(h[i + 1:i + reach + 1])) for i in inside}
    at = [i for i in inside if h[i] > top[i][0] and h[i] >= top[i][1]]
    soft = [i for i in inside if h[i] and h[i] >= max(top[i])]
    out, edges = list(at), [0, *at, len(text)]
    for a, b in zip(edges, edges[1:]):
        if b - a > dedup.LONG_GAP * reach:
            for k in soft:
                if a < k < b and k - a >= reach:
                    out.append(k)
                    a = k
    return [k + 1 for k in sorted(out)]


def brute_runs(rows):
    """(doc, start, end, spans, first doc, kept) by dictionaries."""
    texts, places = dict.fromkeys((i, t or "") for i, t in rows if i is not None), {}
    for no, (i, t) in enumerate([*texts, *[(None, t or "") for i, t in rows if i is None]]):
        raw = t.encode()
        at = brute_cuts(raw)
        for k, a in enumerate(at):
            end = next((b for b in at[k:] if b - a >= dedup.LEAST_BYTES), None)
            if end:
                key = no if i is None else xxhash.xxh64_intdigest(raw, 42)
                key -= 2**64 if key >= 2**63 else 0
                place = (i is None, i or 0, key, len(raw[:a].decode()), len(raw[:end].decode()))
                places.setdefault(raw[a:end], set()).add(place)
    marked = {}
    for found in places.values():
        if len({p[:3] for p in found}) > 1:
            first = min(found)
            for p in found:
                marked.setdefault(p[:3], []).append((p[3], p[4], first[:2], p[:4] == first[:4]))
    out = []
    for doc, hits in marked.items():
        runs = []
        for a, b, first, own in sorted(hits):
            if runs and a <= runs[-1][1]:
                r = runs[-1]
                r[1], r[2], r[3], r[4] = max(r[1], b), r[2] + 1, min(r[3], first), r[4] and own
            else:
                runs.append([a, b, 1, first, own])
        out += [(None if doc[0] else doc[1], a, b, n, None if f[0] else f[1], own)
                for a, b, n, f, own in runs if b - a >= dedup.LEAST_CHARS]
    return sorted(out, key=str)


def rows_of(frame):
    return sorted(((r.doc_id, r.start, r.end, r.n_spans, r.first_doc_id, r.kept)
                   for r in frame.collect()), key=str)


def test_cuts():
    rng = random.Random(1)
    texts = [rng.randbytes(2000), b"", b"a" * 1000, b"word " * 300, ("é ñ" * 200).encode(), b"x" * 47,
             prose(rng, 500).encode(), prose(rng, 40).encode() + b"again " * 200 + prose(rng, 40).encode()]
    for t in texts:
        assert dedup.cuts(t).tolist() == brute_cuts(t)


def test_query_matches_brute_force(spark):
    texts = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    got = rows_of(QUERIES["op9_gear_chunk_dedup"](spark, SF))
    assert got and got == brute_runs(texts)


def test_shared_passages_are_found_wherever_they_stand(spark):
    rng = random.Random(6)
    docs, want = [], set()
    for k in range(60):
        words = [f"{rng.randrange(10**6):x}" for _ in range(51)]
        passage = " ".join(words)
        for j in (0, 1):
            docs.append((2 * k + j, prose(rng, rng.randrange(0, 200), 10**5) + " é" * rng.randrange(9) + " "
                         + passage + " " + prose(rng, rng.randrange(0, 200), 10**5)))
            want.add(2 * k + j)
    frame = spark.createDataFrame(docs, "doc_id int, text string")
    runs = dedup.repeated_runs(frame).collect()
    assert {r.doc_id for r in runs} == want
    assert all(r.kept == (r.doc_id % 2 == 0) and r.first_doc_id == r.doc_id // 2 * 2 for r in runs)
    texts = dict(docs)
    left = {r.doc_id: r.text for r in dedup.deduplicate(frame).collect()}
    for r in runs:
        if not r.kept:
            assert left[r.doc_id] == texts[r.doc_id][:r.start] + texts[r.doc_id][r.end:]
        else:
            assert left[r.doc_id] == texts[r.doc_id]


def test_a_copy_that_holds_a_widely_shared_passage_survives_once(spark):
    rng = random.Random(11)
    words = lambda n: " ".join(f"{rng.randrange(10**6):x}" for _ in range(n))
    shared, before, after, again = words(60), words(80), words(80), words(60)
    copy = f"{before} {shared} {after}"
    docs = [(1, f"{words(30)} {shared} {words(30)}"), (2, copy), (3, copy),
            (4, f"{again} {words(30)} {shared} {again}"), (5, f"{words(9)} {again} {words(9)}")]
    frame = spark.createDataFrame(docs, "doc_id int, text string")
    runs = dedup.repeated_runs(frame).collect()
    left = {r.doc_id: r.text for r in dedup.deduplicate(frame).collect()}
    places = {}
    for d, t in docs:
        for a, b in dedup.spans(t.encode()):
            places.setdefault(t[a:b], []).append((d, a))
    repeated = {x: min(p) for x, p in places.items() if len({d for d, _ in p}) > 1}
    # each repeated passage stays in its first document, and goes from the others
    assert repeated and all(x in left[d] for x, (d, _) in repeated.items())
    for part in (shared, before, after, again):
        middle = part[100:-100]
        assert sum(t.count(middle) for t in left.values()) == 1
    assert all(r.first_doc_id == r.doc_id for r in runs if r.kept)
    assert [r.kept for r in sorted(runs) if r.doc_id == 2] == [True, False, True]
    assert [r.kept for r in sorted(runs) if r.doc_id == 3] == [False]
    for d, t in docs:  # runs of a document do not overlap
        bounds = sorted((r.start, r.end) for r in runs if r.doc_id == d)
        assert all(e <= s for (_, e), (s, _) in zip(bounds, bounds[1:])) and len(t) >= bounds[-1][1]


def test_texts_of_one_id_keep_their_own_cuts(spark):
    rng = random.Random(12)
    words = lambda n: " ".join(f"{rng.randrange(10**6):x}" for _ in range(n))
    shared, alone = words(90), words(120)
    docs = [(0, f"{shared} {words(20)}"), (1, f"{shared} {words(30)}"), (1, alone), (1, alone),
            (None, f"{shared} {words(9)}"), (None, alone + " x"), (None, alone + " x")]
    frame = spark.createDataFrame(docs, "doc_id int, text string")
    left = [(r.doc_id, r.text) for r in dedup.deduplicate(frame).collect()]
    assert left.count((1, alone)) == 2 and (0, docs[0][1]) in left  # nothing unique is cut
    assert sum(t.count(shared[100:-100]) for i, t in left if i is not None) == 1
    runs = dedup.repeated_runs(frame).collect()
    assert len({r.text_key for r in runs if r.doc_id is None}) == 3  # each a document of its own
    assert len({r.text_key for r in runs if r.doc_id == 1}) == 2
    assert rows_of(dedup.repeated_runs(frame)) == brute_runs(docs)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    assert rows_of(dedup.repeated_runs(odd_docs)) == brute_runs(odd_rows)
    assert dedup.deduplicate(odd_docs).count() == len(odd_rows)
    assert dedup.repeated_runs(no_docs).count() == 0 and dedup.deduplicate(no_docs).count() == 0
