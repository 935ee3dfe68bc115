import hashlib
import math
import random
import re
import string
from collections import Counter

from rillet.llm import secret_scan
from rillet.llm.queries import QUERIES
from rillet.sources.tables import table

from .conftest import SF

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def entropy(s):
    return -sum(c / len(s) * math.log2(c / len(s)) for c in Counter(s).values())


def brute(text):
    """(start, rank, end) of every span."""
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    last = 0
    for m in re.finditer(secret_scan.CANDIDATE, text):
        before, last, word = text[last:m.start()][-40:], m.end(), m[0]
        if (re.search(secret_scan.ALLOW_BEFORE.replace(r"\z", r"\Z"), before, re.A)
                or any(re.search(a, word) for a in secret_scan.ALLOW)):
            continue
        for rank, (_, every, some, window, least) in enumerate(secret_scan.CLASSES, 3):
            if re.search(every, word):
                hot = [k for k in range(len(word) - window + 1)
                       if entropy(word[k:k + window]) >= least - 1e-9]
                if re.search(some, word) and hot:
                    out.append((m.start() + hot[0], rank, m.start() + hot[-1] + window))
                break
    return sorted(out)


def written(spans):
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def same(rows, texts):
    want = []
    for i, t in texts:
        spans = brute(t)
        base = [s for s in spans if s[1] < 3]
        want.append((str(i), *(sum(s[1] == k for s in base) for k in range(3)),
                     hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
    assert sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans)
                  for r in rows) == sorted(want)


def hard_texts():
    rng = random.Random(11)
    key = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    b64, alnum = string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits
    texts = ["password=hunter2hunter2", "PassWord\"  :  'abcdefgh'", "token==abc", "api_key: short",
             "APIKEY=" + key(alnum, 30), "xAKIA" + key(string.ascii_uppercase, 16) + "z", "AKIA1",
             key("0123456789abcdef", 31), key("0123456789abcdef", 64), "é" * 9 + " " + key(b64, 44) + "==",
             "sha256: " + key("0123456789abcdef", 64), "123e4567-e89b-12d3-a456-426614174000",
             key("0123456789ABCDEF", 40), "word-after-word/and/another_word", "A1" * 30,
             "\U0001f600 " + key(alnum, 25) + " " + key(b64, 300) + "\n" + key(alnum, 20),
             "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1", "secret_token=abc.def-ghi", "password passwd=12345678 token:87654321",
             "x" * 40 + key(alnum, 24) + "y" * 40, "EXAMPLE" + key(alnum, 30)]
    texts += [" ".join(rng.choice([key(b64, rng.randrange(1, 60)), "secret=" + key(b64, 9),
                                   "AKIA" + key(string.ascii_uppercase, rng.randrange(8, 20)), "the", "ñ"])
                       for _ in range(30)) for _ in range(30)]
    return [(100 + k, t) for k, t in enumerate(texts)]


def test_query_matches_brute_force(spark):
    texts = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    same(QUERIES["op5_secret_entropy"](spark, SF).collect(), texts)


def test_odd_and_hard_rows(spark, odd_docs, odd_rows, no_docs):
    hard = hard_texts()
    docs = odd_docs.select("doc_id", "text").union(
        spark.createDataFrame(hard, "doc_id bigint, text string"))
    same(secret_scan.scan(docs).collect(), odd_rows + hard)
    assert any(s[1] >= 3 for _, t in hard for s in brute(t))
    assert len(secret_scan.scan(odd_docs).collect()) == len(odd_rows)
    assert secret_scan.scan(no_docs).count() == 0


def test_a_long_candidate(spark):
    rng = random.Random(4)
    word = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(20_000))
    same(secret_scan.scan(spark.createDataFrame([(1, word)], "doc_id int, text string")).collect(), [(1, word)])


def test_many_matches_in_one_text(spark):
    rng = random.Random(9)
    text = " ".join(f"token={rng.randrange(10**9):09d} é" for _ in range(3000))
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    same(secret_scan.scan(docs).collect(), [(1, text)])
    assert secret_scan.redact(docs).first().text == re.sub(r"token=\d+", "[SECRET]", text)


def test_redact(spark, odd_docs, no_docs):
    hard = hard_texts()
    rows = [(i, t, len(t), "x") for i, t in hard] + [(1, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint, found string")
    out = secret_scan.redact(docs)
    assert out.schema == docs.schema
    got = {r.doc_id: r for r in out.collect()}
    for i, t in hard:
        text, end = "", 0
        merged = []
        for a, _, b in brute(t):
            if merged and a < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        for a, b in merged:
            text, end = text + t[end:a] + "[SECRET]", b
        assert got[i].text == text + t[end:]
        assert got[i].n_chars == len(got[i].text)
    assert got[1].text is None and got[1].n_chars is None
    assert secret_scan.redact(no_docs).count() == 0


def test_native_plan(spark):
    plan = QUERIES["op5_secret_entropy"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_sql_matches_on_hard_texts(spark):
    import duckdb
    import pandas as pd
    hard = hard_texts()
    hard_table = pd.DataFrame(hard + [(1, None), (2, "")], columns=["doc_id", "text"])
    con = duckdb.connect()
    con.register("hard_table", hard_table)
    got = con.sql(secret_scan.oracle("hard_table"))
    names = got.columns
    want = secret_scan.scan(spark.createDataFrame(hard + [(1, None), (2, "")], "doc_id bigint, text string"))
    assert sorted(got.fetchall()) == sorted(tuple(r[n] for n in names) for r in want.collect())
