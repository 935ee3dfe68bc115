import random

from rillet.llm import decontam
from rillet.llm.queries import QUERIES
from rillet.sources.tables import table

from .conftest import SF, prose


def brute(texts, items):
    """(doc, item, passage) by the word checks alone, over every pair."""
    out = set()
    for i, name in items:
        words = decontam.tokens((name or "").encode())
        for k in range(0, len(words), decontam.WINDOW):
            item = words[k:k + decontam.WINDOW]
            for d, t in texts:
                if decontam.verdict(item, decontam.tokens((t or "").encode()))[2]:
                    out.add((d, i, k // decontam.WINDOW))
    return out


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = [0] + [0] * len(b) if not row else row
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_lcs():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.randrange(6) for _ in range(rng.randrange(0, 70))]
        b = [rng.randrange(-1, 6) for _ in range(rng.randrange(0, 90))]
        assert decontam.lcs(a, b) == plain_lcs(a, b)


def test_query_matches_brute_force(spark):
    texts = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    rows = QUERIES["op10_latent_decontamination"](spark, SF).collect()
    got, want = {(r.doc_id, r.item_id, r.passage) for r in rows}, brute(texts, items)
    assert want and len(got & want) >= 0.9 * len(want) and got <= want


def test_paraphrases_and_odd_rows(spark, odd_docs, odd_rows, no_docs, monkeypatch):
    rng = random.Random(9)
    items = [(k, prose(rng, n, 3000)) for k, n in enumerate([20, 40, 60, 150, 33])]
    items += [(5, None), (6, ""), (None, prose(rng, 30, 3000))]
    planted = []
    for k, t in items:
        words = (t or "").split()
        changed = [w for j, w in enumerate(words) if j % 9]  # words left out
        planted += [(200 + len(planted), prose(rng, 500) + " " + " ".join(words) + " " + prose(rng, 77)),
                    (200 + len(planted) + 1, prose(rng, 45) + " " + " ".join(changed).upper() + ".")]
    docs = odd_docs.select("doc_id", "text").union(
        spark.createDataFrame(planted, "doc_id bigint, text string"))
    bench = spark.createDataFrame([(i, t, 1) for i, t in items],
                                  "item_id bigint, text string, doc_id int")
    for most, served in ((1024, 8), (2, 8), (2, 3)):  # one block; several, in one reading or more
        monkeypatch.setattr(decontam, "QUERY_BLOCK", most)
        monkeypatch.setattr(decontam, "PASS_BLOCKS", served)
        rows = decontam.matches(docs, bench).collect()
        got = {(r.doc_id, r.item_id, r.passage) for r in rows}
        assert got == brute(odd_rows + planted, items)
        assert len(rows) == len(got) and {d for d, _, _ in got} >= {
            d for d, t in planted if len(t.split()) > 590}
    assert decontam.matches(no_docs, bench).count() == 0
    assert decontam.matches(docs, bench.limit(0)).count() == 0
    assert decontam.matches(docs, bench.where("item_id in (5, 6)")).count() == 0


def test_readings_do_not_grow_with_the_blocks(spark, tmp_path, monkeypatch):
    """Three query blocks: the documents are read once for the frequencies, once for the search."""
    rng = random.Random(12)
    items = [(k, prose(rng, 40, 3000)) for k in range(30)]
    path = str(tmp_path / "docs")
    spark.createDataFrame([(k, prose(rng, 90) + " " + t) for k, t in items],
                          "doc_id bigint, text string").write.parquet(path)
    counted = []
    plain = decontam._idf
    monkeypatch.setattr(decontam, "_idf", lambda *a: counted.append(1) or plain(*a))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (512, 10):
        monkeypatch.setattr(decontam, "QUERY_BLOCK", block)
        counted.clear()
        found = decontam.matches(spark.read.parquet(path), bench)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert len(counted) == 1 and plan.count("MapInArrow ") == 1, plan
        assert {(r.doc_id, r.item_id) for r in found.collect()} >= {(k, k) for k, _ in items}


def test_quotes_across_passages(spark):
    rng = random.Random(31)
    items = {k: [f"i{k}w{j}" for j in range(n)] for k, n in enumerate([128, 150, 64, 300, 70])}
    quotes = [(0, 32, 96), (0, 26, 102), (1, 86, 150), (1, 100, 150), (1, 128, 150), (2, 0, 64), (4, 6, 70)]
    quotes += [(3, a, a + 50) for a in range(0, 251, 7)]
    fill = lambda n: [f"f{rng.randrange(10**6)}" for _ in range(n)]
    docs = [(d, " ".join(fill(rng.randrange(200)) + items[k][a:b] + fill(rng.randrange(200))))
            for d, (k, a, b) in enumerate(quotes)]
    # short of a quote: 60 % of no stretch
    docs.append((len(quotes), " ".join(fill(90) + items[3][110:145] + fill(90))))
    rows = decontam.matches(
        spark.createDataFrame(docs, "doc_id int, text string"),
        spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id int, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(d, k) for d, (k, _, _) in enumerate(quotes)}
    assert len(rows) == len({(r.doc_id, r.item_id, r.passage) for r in rows})
    assert all(0 <= r.passage <= (len(items[r.item_id]) - 1) // decontam.WINDOW for r in rows)


def test_paraphrases_in_a_full_block(spark):
    """Two fifths of the words before the answer are others; 512 items leave the rank short."""
    rng = random.Random(37)
    pool = [f"w{k}" for k in range(6000)]
    some = lambda n: [pool[min(5999, int(rng.expovariate(0.001)))] for _ in range(n)]
    items = [some(rng.randrange(30, 60)) for _ in range(decontam.QUERY_BLOCK)]
    docs, want = [], set()
    for k, item in enumerate(items):
        for _ in range(3):
            words = [w if rng.random() > 0.4 or j >= len(item) - decontam.ANSWER_WORDS else some(1)[0]
                     for j, w in enumerate(item)]
            text = some(rng.randrange(100)) + words + some(50)
            if decontam.verdict(item, text)[2]:
                want.add((len(docs), k))
                docs.append((len(docs), " ".join(text)))
    rows = decontam.matches(
        spark.createDataFrame(docs, "doc_id int, text string"),
        spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id int, text string")).collect()
    missed = want - {(r.doc_id, r.item_id) for r in rows}
    assert len(want) > 500 and len(missed) <= 0.004 * len(want), (len(missed), len(want))
