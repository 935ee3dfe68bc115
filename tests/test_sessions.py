import random


from rillet.operators.sessions import sessions
from rillet.plans import dashboard

SCHEMA = ("mid string, dt string, ts bigint, seq bigint, last_page_id string, during_time bigint, "
          "channel string, is_new string")


def brute(rows):
    """Sessions by one ordered pass over each device-day."""
    out, groups = [], {}
    for r in rows:
        groups.setdefault(r[:2], []).append(r)
    for own in groups.values():
        own.sort(key=lambda r: (r[2] is not None, r[2] or 0, r[3]))
        open_ = None
        for mid, dt, ts, seq, last, time, channel, new in own:
            if open_ is None or last is None:
                open_ = [mid, dt, ts, seq, 0, None, channel, new]
                out.append(open_)
            open_[4] += 1
            if time is not None:
                open_[5] = (open_[5] or 0) + time
    return sorted(map(repr, map(tuple, out)))


def _same(spark, rows, **kw):
    got = sessions(spark.createDataFrame(rows, SCHEMA), **kw).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows)


def test_sessions_match_one_ordered_pass(spark):
    rng = random.Random(5)
    for chance, span in ((0.5, 600), (0.1, 5_000), (0.02, 100), (0.9, 3_000)):
        rows = []
        for seq in range(900):
            # one device holds a third of the rows; few times, so many ties
            mid = "hot" if rng.random() < 0.33 else rng.choice(["a", "b", None, ""])
            rows.append((mid, rng.choice(["d1", "d2", None]),
                         None if rng.random() < 0.03 else rng.randrange(span), seq,
                         None if rng.random() < chance else rng.choice(["p", ""]),
                         rng.choice([None, 1, 7]), rng.choice([None, "c1", "c2"]),
                         rng.choice([None, "0", "1"])))
        _same(spark, rows, chunk_ms=100)


def test_sessions_of_odd_logs(spark):
    _same(spark, [])
    # no entry page at all, over many chunks; then entries only
    _same(spark, [("m", "d", 10 * k, k, "p", 1, "c", "0") for k in range(50)], chunk_ms=20)
    _same(spark, [("m", "d", 10 * k, k, None, 1, "c", "0") for k in range(50)], chunk_ms=200)
    # one session over chunks that are far apart
    _same(spark, [("m", "d", 10_000 * k, k, "p" if k else None, None, None, None) for k in range(20)],
          chunk_ms=20)


def test_visit_statistics_read_the_log_once_beside_its_summary(spark):
    for query in (dashboard.q04_new_visit_stats, dashboard.q06_channel_bounce):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        # the rows, and one summary per chunk that carries the previous page over
        assert plan.count("Relation [") == 2, plan
