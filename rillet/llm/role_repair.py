"""Conversation structure repair by a generalised LR parse of the turns' roles.

The parse tables come from the role grammar: LR(0) item sets, reduced as soon as an item
is complete. A graph-structured stack runs over a conversation's turns; every step keeps,
deletes or reroles the turn, after any useful inserts, each with its weight. Stacks that
share their lower part share its nodes, and equal stack tops at one turn are merged by the
least (cost, audit). That is exact here: below equal tops the role grammar accepts the same
rests, and two audits of one turn and cost are never prefixes of each other, so that the
lesser stays the lesser whatever follows. Steps depend on a turn by its kind alone, so they
are made once per (relative costs of the tops, kind) and looked up after that.

One exchange brings a conversation's rows together; earlier equal rows are found by a
window over (conversation, role, text) and rows are then sorted by turn, both of which
spill. A task streams its rows and holds, whatever the length of a conversation, one hash
state and one audit per stack top: the text itself is never held. A conversation passes
through one task because the SHA-256 of its repaired text is one sequential hash.

Defined cases: a null conversation id is a conversation of its own; null turns come first;
rows of one turn stand in the order of role, then text; repeated rows are duplicates; a
null role or text is one space; a role that begins with none of the grammar's initials
cannot be kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Role grammar: optional system turn, then pairs of user and assistant.
GRAMMAR = (("S", ""), ("S", "L"), ("S", "sL"), ("L", "ua"), ("L", "Lua"))
#: Roles that a rerole or an insert may give, by their symbol.
GIVEN = {"u": "user", "a": "assistant"}
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
#: Audit characters of a stack top that are joined into one string at a time.
SETTLE = 4096
BLANK = r"[\x20\x09-\x0D]"
RESULT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
          "cost bigint, audit string, repaired_sha256 string")


class Tables:
    """LR(0) tables of a grammar whose reductions need no look-ahead."""

    def __init__(self, rules=GRAMMAR):
        self.rules = (("'", rules[0][0]), *rules)
        self.heads = {h for h, _ in self.rules}
        self.symbols = sorted({c for _, body in self.rules for c in body} - self.heads)
        self.start = self._closure({(0, 0)})

    def _closure(self, items) -> frozenset:
        found, fresh = set(items), list(items)
        while fresh:
            rule, dot = fresh.pop()
            body = self.rules[rule][1]
            for k, (head, _) in enumerate(self.rules):
                if dot < len(body) and body[dot] == head and (k, 0) not in found:
                    found.add((k, 0))
                    fresh.append((k, 0))
        return frozenset(found)

    def goto(self, state: frozenset, symbol: str) -> frozenset | None:
        moved = {(r, d + 1) for r, d in state
                 if d < len(self.rules[r][1]) and self.rules[r][1][d] == symbol}
        return self._closure(moved) if moved else None

    def shift(self, node, symbol: str):
        """The stack after ``symbol``, with completed rules of the body reduced; None if
        the symbol does not fit. A node is (state, node below)."""
        state = self.goto(node[0], symbol)
        if state is None:
            return None
        node = (state, node)
        while len(node[0]) == 1:  # the only item is complete: reduce
            (rule, dot), = node[0]
            head, body = self.rules[rule]
            if dot < len(body):
                break
            for _ in body:
                node = node[1]
            node = (self.goto(node[0], head), node)
        return node

    def accepts(self, node) -> bool:
        """Whether the input may end here: reductions lead to the start rule's end."""
        for rule, dot in node[0]:
            head, body = self.rules[rule]
            if dot < len(body):
                continue
            if rule == 0:
                return True
            below = node
            for _ in body:
                below = below[1]
            state = self.goto(below[0], head)
            if state is not None and self.accepts((state, below)):
                return True
        return False


class Repair:
    """The stack tops of a conversation so far, and their steps."""

    def __init__(self, tables: Tables | None = None):
        self.tables = tables or Tables()
        self.root = (self.tables.start, None)
        self.steps: dict = {}
        self.ends: dict = {}

    @lru_cache(maxsize=None)
    def _inserts(self, node) -> list[tuple]:
        """(inserted symbols, node) reachable by the fewest inserts."""
        found, fresh = {node[0]: ("", node)}, [("", node)]
        for done, at in fresh:
            for symbol in GIVEN:
                to = self.tables.shift(at, symbol)
                if to and to[0] not in found:
                    found[to[0]] = (done + symbol, to)
                    fresh.append(found[to[0]])
        return list(found.values())

    def step(self, tops: tuple, kind: tuple) -> tuple[int, tuple]:
        """``tops``: (node, cost above the least) in the order of their audits. ``kind``:
        (initial, must go, truncated). Gives the cost that all tops share and per new top
        (node, cost above it, old top, inserted symbols, edit, symbol given)."""
        known = self.steps.get((tops, kind))
        if known:
            return known
        initial, must_go, cut = kind
        best: dict = {}
        for rank, (node, cost) in enumerate(tops):
            for put, at in self._inserts(node):
                now = cost + INSERT * len(put)
                moves = [("D", DELETE, at, "")]
                if not must_go:
                    late = TRUNCATED if cut else 0
                    moves += [("K", late, self.tables.shift(at, initial), "")]
                    moves += [("R", late + REROLE, self.tables.shift(at, c), c) for c in GIVEN]
                for edit, price, to, given in moves:
                    if to is None:
                        continue
                    audit = "I" * len(put) + edit
                    order = (now + price, rank, audit)
                    if to[0] not in best or order < best[to[0]][0]:
                        best[to[0]] = (order, to, rank, put, edit, given)
        # audits of different tops are ordered by their old tops, then by the new edits
        ranked = sorted(best.values(), key=lambda b: b[0][1:])
        least = min(b[0][0] for b in ranked)
        made = (least, tuple((to, order[0] - least, rank, put, edit, given)
                             for order, to, rank, put, edit, given in ranked))
        self.steps[tops, kind] = made
        return made

    def end(self, tops: tuple) -> tuple[int, int, str]:
        """(cost above the least, top, inserted symbols) of the cheapest end."""
        if tops not in self.ends:
            self.ends[tops] = min(
                ((cost + INSERT * len(put), rank, "I" * len(put), put)
                 for rank, (node, cost) in enumerate(tops)
                 for put, at in self._inserts(node) if self.tables.accepts(at)),
                key=lambda e: e[:3])
        cost, rank, _, put = self.ends[tops]
        return cost, rank, put


class _Audit:
    """An audit that grows at its end; settled parts are shared between stack tops."""

    __slots__ = ("settled", "recent")

    def __init__(self, settled=None, recent=""):
        self.settled, self.recent = settled, recent

    def plus(self, edits: str) -> _Audit:
        settled, recent = self.settled, self.recent + edits
        if len(recent) >= SETTLE:
            settled, recent = (settled, recent), ""
        return _Audit(settled, recent)

    def text(self) -> str:
        parts, at = [self.recent], self.settled
        while at:
            at, part = at[0], at[1]
            parts.append(part)
        return "".join(reversed(parts))


class _Text:
    """SHA-256 of repaired turns, newline-joined."""

    __slots__ = ("hash", "some")

    def __init__(self, state=None, some=False):
        self.hash, self.some = state or hashlib.sha256(), some

    def plus(self, turns: list[tuple[bytes, bytes]]) -> _Text:
        if not turns:
            return self
        made = _Text(self.hash.copy(), self.some)
        for role, text in turns:
            made.hash.update((b"\n" if made.some else b"") + role + b":")
            made.hash.update(text)
            made.some = True
        return made


class _Conversation:
    """One conversation while its rows stream by."""

    def __init__(self, conv_id, repair: Repair):
        self.conv_id, self.repair = conv_id, repair
        self.tops = ((repair.root, 0),)
        self.audits, self.texts = [_Audit()], [_Text()]
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.cost = self.illegal = self.turns = 0
        self.first = self.last = self.before = None

    def add(self, turn, role: bytes, text: bytes, fault) -> None:
        initial = role.decode("utf-8", "replace")[:1]
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if fault:
            self.counts[fault] += 1
        known = initial if initial in self.repair.tables.symbols else ""
        kind = known, fault in ("blank", "duplicate"), fault == "truncated"
        shared, made = self.repair.step(self.tops, kind)
        audits, texts = [], []
        for _, _, rank, put, edit, given in made:
            audits.append(self.audits[rank].plus("I" * len(put) + edit))
            turns = [(GIVEN[c].encode(), b"") for c in put]
            if edit != "D":
                turns.append((GIVEN[given].encode() if given else role, text))
            texts.append(self.texts[rank].plus(turns))
        self.cost += shared
        self.tops = tuple((node, cost) for node, cost, *_ in made)
        self.audits, self.texts = audits, texts

    def result(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        if self.before is None:  # no row is left
            cost, audit, digest = 0, "", hashlib.sha256().hexdigest()
        else:
            more, rank, put = self.repair.end(self.tops)
            cost = self.cost + more
            audit = self.audits[rank].text() + "I" * len(put)
            text = self.texts[rank].plus([(GIVEN[c].encode(), b"") for c in put])
            digest = text.hash.hexdigest()
        return (self.conv_id, gaps, *self.counts.values(), self.illegal, cost, audit, digest)


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of (conversation, turn, role, text) to one row a conversation."""
    repair, open_, done, kind = Repair(), None, [], None
    names = ["conv_id", *[f.split()[0] for f in RESULT.split(", ")]]

    def flush():
        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        rows = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*done), types)], names)
        done.clear()
        return rows

    for batch in batches:
        kind = batch.schema.field(0).type
        ids, turns, roles, copies, faults = (batch.column(k).to_pylist() for k in (0, 1, 2, 4, 5))
        texts = batch.column(3)
        for k, (conv_id, turn, role, n, fault) in enumerate(zip(ids, turns, roles, copies, faults)):
            if open_ is None or conv_id != open_.conv_id:
                if open_ is not None:
                    done.append(open_.result())
                    if len(done) >= 4096:
                        yield flush()
                open_ = _Conversation(conv_id, repair)
            for copy in range(n):
                again = "duplicate" if copy and fault != "blank" else fault
                open_.add(turn, role, texts[k].as_py(), again)
    if open_ is not None:
        done.append(open_.result())
    if done:
        yield flush()


def repair(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns(conv_id, turn, role, text, copies)``: a row that
    stands ``copies`` times (0: it is gone, its conversation stays) at its turn."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    gone = F.col("copies") == 0
    rows = turns.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"),
        F.when(~gone, F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(~gone, F.coalesce("text", F.lit(" "))).alias("text"), "copies")
    rows = rows.repartition("conv_id")
    earlier = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("turn"))
    last = F.regexp_extract("text", f"([^\\x20\\x09-\\x0D]){BLANK}*\\z", 1)
    fault = (F.when(last == "", "blank").when(F.col("earlier") > 1, "duplicate")
             .when(~last.isin(".", "!", "?"), "truncated"))
    rows = rows.withColumn("earlier", earlier).withColumn("fault", fault)
    rows = rows.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    as_bytes = [F.col(c).cast("binary").alias(c) for c in ("role", "text")]
    return rows.select("conv_id", "turn", *as_bytes, "copies", "fault").mapInArrow(
        _repair, f"conv_id {kind}, {RESULT}")


def damage(turns: DataFrame) -> DataFrame:
    """The contract's damage by the checksum of ``conv_id:turn`` as (conv_id, turn, role,
    text, copies): 0 drops the row, 1 empties its text, 2 takes its stops out, 3 repeats it,
    4 makes it the user's."""
    def of(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    way = F.crc32(F.concat(of("conv_id"), F.lit(":"), of("turn"))) % 20
    text = (F.when(way == 1, "").when(way == 2, F.regexp_replace(of("text"), "[.!?]", ""))
            .otherwise(of("text")))
    return turns.select(
        "conv_id", "turn", F.when(way == 4, "user").otherwise(of("role")).alias("role"),
        text.alias("text"),
        F.when(way == 0, 0).when(way == 3, 2).otherwise(1).alias("copies"))
