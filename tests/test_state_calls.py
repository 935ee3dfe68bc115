"""Keyed state takes a few calls a bucket and batch, however many rows and keys come."""

from pyspark.sql import Row

from rillet.streaming import state

DAY = 86_400_000


class Calls:
    """A state handle in memory that counts what a processor asks of it."""

    def __init__(self):
        self.n, self.lists, self.timers = 0, {}, set()

    def _state(self, name, schema):
        owner, rows = self, self.lists.setdefault(name, [])

        class Kept:
            def appendValue(self, value):
                self.appendList([value])

            def appendList(self, values):
                owner.n += 1
                rows.extend(Row(*v) for v in values)

            def put(self, values):
                self.clear()
                self.appendList(values)

            def update(self, value):
                self.put([value])

            def clear(self):
                owner.n += 1
                rows.clear()

            def exists(self):
                owner.n += 1
                return bool(rows)

            def get(self):
                owner.n += 1
                return iter(list(rows))
        return Kept()

    getListState = getValueState = _state

    def registerTimer(self, at):
        self.n += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.n += 1
        self.timers.discard(at)


class At:
    def __init__(self, at):
        self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: at


def test_rollup_calls():
    handle, job = Calls(), state.Rollup()
    job.init(handle)
    rows = [Row(k=f"u{n % 50}", ts=n, tie=n, event="x" if n % 3 else "y", value=1.0) for n in range(5000)]
    assert not list(job.handleInputRows((0,), iter(rows), At(0)))
    out = list(job.handleExpiredTimer((0,), At(4000), At(0)))
    out += job.handleExpiredTimer((0,), At(9000), At(0))
    assert handle.n < 30
    last = {(r.k, r.start_time): r.n_rows for r in out}  # a later form of a run has more rows
    assert sum(last.values()) == 5000 and not handle.lists["waiting"]


def test_midnight_calls():
    handle, job = Calls(), state.MidnightExpiry("UTC")
    job.init(handle)
    rows = [Row(mid=f"m{n % 40}", seen=n * DAY // 100 + 1) for n in range(2000)]
    out = list(job.handleInputRows((0,), iter(rows), At(0)))
    assert handle.n < 30
    assert len(out) == len({(r.mid, r.seen // DAY) for r in rows})
    for at in sorted(handle.timers):
        list(job.handleExpiredTimer((0,), At(at), At(at)))
    assert not handle.lists["until"]
