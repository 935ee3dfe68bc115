import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from rillet.llm import role_repair
from rillet.llm.queries import QUERIES
from rillet.sources.tables import table

from .conftest import SF

COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    """Rows by conversation after the damage, in order of turn."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        way = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if way == 1:
            text = ""
        if way == 2:
            text = re.sub("[.!?]", "", text)
        if way == 4:
            role = "user"
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(way, 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def cheapest(turns):
    """(cost, audit, repaired turns) by a search over all edits: states are (row, roles so
    far by what they allow next), ordered by (cost, audit)."""
    def after(state, symbol):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a",
                ("a", "u"): "u"}.get((state, symbol))

    names = {"u": "user", "a": "assistant"}
    heap, best = [(0, "", 0, "", ())], {}
    while heap:
        cost, audit, k, state, done = heapq.heappop(heap)
        if k == len(turns) and state in ("", "a"):
            return cost, audit, done
        if best.get((k, state), (cost, audit)) < (cost, audit):
            continue
        best[k, state] = cost, audit
        moves = [(3, "I", k, after(state, c), (names[c], "")) for c in names]
        if k < len(turns):
            (role, text), fault = turns[k]
            late = 3 * (fault == "truncated")
            moves.append((4, "D", k + 1, state, None))
            if fault not in ("blank", "duplicate"):
                moves.append((late, "K", k + 1, after(state, role[:1]), (role, text)))
                moves += [(3 + late, "R", k + 1, after(state, c), (names[c], text)) for c in names]
        for price, edit, to, now, turn in moves:
            if now is not None:
                heapq.heappush(heap, (cost + price, audit + edit, to, now,
                                      done + ((turn,) if turn else ())))
    raise AssertionError


def brute(rows):
    out = {}
    for conv, kept in damaged(rows).items():
        faults, seen = [], set()
        for _, role, text in kept:
            last = text.rstrip(SPACE)[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen
                          else None if last in ".!?" else "truncated")
            seen.add((role, text))
        pairs = zip(kept, kept[1:])
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs)
        turns = {t for t, _, _ in kept if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit, done = cheapest(list(zip([r[1:] for r in kept], faults)))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest()
        out[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                     illegal, cost, audit, digest)
    return out


def of(frame):
    rows = frame.collect()
    found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("sf", [SF, SF.replace("0.001", "0.01")])
def test_query(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "conversations", "conv_id", "turn", "role", "text").collect()]
    assert of(QUERIES["op13_role_repair"](spark, sf)) == brute(rows)


def test_random_roles(spark):
    """Many short conversations of every kind of row, ties and nulls among them."""
    rng = random.Random(5)
    rows = []
    for conv in range(3000):
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "system", "tool", "", None, "sys", "Ärzte"])
            text = rng.choice(["A.", "B!", "c", "", " \n", "x. y", "?\t ", None, "é", " "])
            at = rng.choice([turn, turn, turn, rng.randrange(4), None, turn * 3])
            rows.append((conv, at, role, text))
    rows += [(None, 0, "user", "A."), (None, None, None, None), (None, 0, "user", "A.")] * 2
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    # columns that clash with the operator's own
    frame = frame.selectExpr("*", "1 copies", "'x' fault", "2 earlier", "3 cost", "'y' audit")
    assert of(role_repair.repair(role_repair.damage(frame))) == brute(rows)


def test_all_short_inputs():
    """Every sequence of up to five kinds of turns, against the search."""
    machine = role_repair.Repair()
    kinds = [(b"user", b"a.", None), (b"assistant", b"b", "truncated"), (b"system", b"c.", None),
             (b"tool", b"d.", None), (b"user", b"", "blank")]
    for n in range(1, 6):
        for turns in itertools.product(kinds, repeat=n):
            conv = role_repair._Conversation(1, machine)
            for k, (role, text, fault) in enumerate(turns):
                conv.add(k, role, text, fault)
            cost, audit, done = cheapest([((r.decode(), t.decode()), f) for r, t, f in turns])
            digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest()
            assert conv.result()[-3:] == (cost, audit, digest)


def test_long_conversation(spark):
    """One conversation of 30,000 rows, longer than a settled part of an audit."""
    rows = [(7, k, random.Random(k).choice(["user", "assistant"]), f"text {k}.") for k in range(30_000)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = of(role_repair.repair(role_repair.damage(frame)))[7]
    kept = damaged(rows)[7]
    audit, cost = found[6], found[5]
    prices = {"K": 0, "R": 3, "D": 4, "I": 3}
    undeleted = sum(e in "KR" and k[2][-1] != "." for e, k in zip(audit.replace("I", ""), kept))
    assert len(audit.replace("I", "")) == len(kept)
    assert cost == sum(prices[e] for e in audit) + 3 * undeleted


def test_empty_and_dropped(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, extra int"
    none = spark.createDataFrame([], schema)
    assert of(role_repair.repair(role_repair.damage(none))) == {}
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(gone, 0, "user", "A.", 1)], schema)
    empty = hashlib.sha256().hexdigest()
    assert of(role_repair.repair(role_repair.damage(one))) == {gone: (0, 0, 0, 0, 0, 0, "", empty)}
