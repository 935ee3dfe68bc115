import datetime as dt
import random

from rillet.llm import url_filter
from rillet.llm.queries import QUERIES, SQL
from rillet.sources.tables import table

from .conftest import SF

START = dt.date(2024, 1, 1)
ENTRIES = "list string, kind string, value string, action string, day date, seq int"


def brute(captures, entries):
    """Verdicts by walking every entry's events for every capture."""
    out = []
    for name, url, day in captures:
        rest = (url or "").strip().partition("://")[2].split("#")[0].split("?")[0]
        host, slash, path = rest.partition("/")
        host = host.rpartition("@")[2].partition(":")[0].lower().rstrip(".")
        hits = []
        for key in sorted({e[:3] for e in entries if None not in e[:5]}):
            kind, value = key[1:]
            events = sorted(((e[4], e[5], e[3]) for e in entries if e[:3] == key and e[4]))
            state = [a for d, _, a in events if day and d <= day]
            match = {"domain": ("." + host).endswith("." + value), "host": host == value,
                     "prefix": (host + "/" + path).startswith(value)}[kind]
            if host and match and state and state[-1] == "add":
                hits.append(key)
        rules = [k for k in hits if k[0] != "allow"]
        rule = max((":".join(k) for k in rules), key=lambda r: (len(r.split(":", 2)[2]), r), default=None)
        out.append((name, url, host, len(hits), ",".join(sorted({k[0] for k in hits})), rule,
                    bool(rules) and all(k[0] != "allow" for k in hits)))
    return sorted(out, key=str)


def got(frame):
    return sorted(((r.page_id, r.url, r.host, r.n_active, r.lists, r.rule, r.blocked)
                   for r in frame.collect()), key=str)


def history(rng):
    hosts = ["a.com", "www.a.com", "x.y.a.com", "b.org", "hot.example"]
    urls = [f"http://{h}{p}" for h in hosts for p in ("", "/", "/en/1", "/en/deep/er?q=1", "/de#f")]
    urls += ["HTTPS://User:pw@WWW.A.com.:8080/en/1", "not a url", "", None, "http://nota.com/x"]
    day = lambda: START + dt.timedelta(days=rng.randrange(0, 400))
    captures = [(k, rng.choice(urls), rng.choice([day(), day(), None])) for k in range(300)]
    captures += [(None, urls[0], START), captures[0], captures[0]]
    keys = [("spam", "domain", "a.com"), ("spam", "host", "b.org"), ("legal", "prefix", "www.a.com/en/"),
            ("allow", "host", "x.y.a.com"), ("spam", "domain", "hot.example"), ("adult", "prefix", "hot.example/")]
    entries = []
    for k in keys:
        entries += [(*k, rng.choice(["add", "remove"]), day(), seq) for seq in range(rng.randrange(1, 30))]
    entries += [("spam", "host", None, "add", START, 0), ("spam", "domain", "b.org", "add", None, 0),
                ("spam", "domain", "never.com", "remove", START, 0)]
    return captures, entries


def test_judge_matches_brute_force(spark):
    for seed in range(3):
        captures, entries = history(random.Random(seed))
        frame = spark.createDataFrame([(*c, "kept") for c in captures],
                                      "page_id int, url string, fetched date, `kind` string")
        out = url_filter.judge(frame, spark.createDataFrame(entries, ENTRIES))
        assert got(out) == brute(captures, entries) and "kind" in out.columns


def test_intervals(spark):
    days = lambda *n: [START + dt.timedelta(days=k) for k in n]
    events = [("s", "host", "h", a, d, k) for k, (a, d) in enumerate(zip(
        ["remove", "add", "add", "remove", "add", "remove", "add"], days(0, 1, 5, 9, 9, 9, 20)))]
    base = (START - dt.date(1970, 1, 1)).days
    rows = url_filter.intervals(spark.createDataFrame(events, ENTRIES)).collect()
    assert sorted((r.first - base, r.last and r.last - base) for r in rows) == [(1, 9), (20, None)]


def test_empty_tables(spark):
    captures, entries = history(random.Random(9))
    frame = spark.createDataFrame(captures, "page_id int, url string, fetched date")
    listed = spark.createDataFrame(entries, ENTRIES)
    assert url_filter.judge(frame.limit(0), listed).count() == 0
    assert got(url_filter.judge(frame, listed.limit(0))) == brute(captures, [])


def test_query_is_native_and_decides(spark):
    frame = QUERIES["op8_temporal_url_lists"](spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    rows = frame.collect()
    assert len(rows) == table(spark, SF, "pages").count()
    assert 0 < sum(r.blocked for r in rows) < len(rows)
    assert "op8_temporal_url_lists" in SQL
