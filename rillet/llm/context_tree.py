"""Context-tree weighting over bytes, in numpy.

A byte is eight binary decisions, the first its highest bit. Each decision (bit level and
the bits before it) has its own context tree over the preceding bytes, the latest first,
of depth 0 to ``DEPTH``. A node estimates with Krichevsky-Trofimov; the weighted
probability of a node is half its own estimate and half the product of its children's.
Once the counts are final, a node's posterior weight of stopping there is fixed, and a
bit's probability mixes the estimates of all depths along its context by these weights.

A key is the context's bytes, the latest in the highest place, then the byte itself.
"""

from __future__ import annotations

import numpy as np

DEPTH = 5
#: Depths below TOP have at most 257 contexts and are held by every task.
TOP = 2
END = b"\n"
_HALF = np.log(0.5)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma(x) for x > 0: Stirling's series after a shift by 8."""
    y = x + 8
    inv = 1 / y
    series = inv * (1 / 12 - inv * inv * (1 / 360 - inv * inv / 1260))
    down = np.log(x * (x + 1) * (x + 2) * (x + 3)) + np.log((x + 4) * (x + 5) * (x + 6) * (x + 7))
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - down


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of these counts."""
    return (log_gamma(zeros + 0.5) + log_gamma(ones + 0.5)
            - log_gamma(zeros + ones + 1.0) - np.log(np.pi))


def keys_of(bodies: list[bytes], depth: int = DEPTH) -> np.ndarray:
    """Key of every byte of the bodies; a body's context before its start is END bytes.
    ``depth`` is at most 6, so that a key and its context lie within eight bytes."""
    pad = END * depth
    raw = END * 7 + pad.join(bodies)
    # the eight bytes up to each byte as one number: the byte itself is its highest place
    n = len(raw) - 7
    keys = np.ndarray(n, "<u8", raw, strides=(1,)).astype(np.uint64)
    keys <<= np.uint64(8)
    keys >>= np.uint64(8 * (8 - depth))
    keys <<= np.uint64(8)
    keys |= np.frombuffer(raw, np.uint8, offset=7)
    if len(bodies) > 1:  # drop what belongs to the pads
        ends = np.cumsum([len(b) for b in bodies[:-1]]) + depth * np.arange(len(bodies) - 1)
        inside = np.ones(n, bool)
        inside[(ends[:, None] + np.arange(depth)).ravel()] = False
        keys = keys[inside]
    return keys


def counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts, starts)


def _weighted(zeros, ones, below):
    """(ln of the weighted probability, weight of the own estimate)."""
    own = _HALF + log_kt(zeros, ones)
    both = np.logaddexp(own, _HALF + below)
    return both, np.exp(own - both)


def _levels(keys: np.ndarray, counts: np.ndarray, bit: int, depth: int):
    """The trees of one bit level from ``depth`` to TOP: for each depth (node ids, zeros,
    ones, ln weighted, own weight, place of each node's parent)."""
    ids = keys >> np.uint64(8 - bit)
    starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    place = np.cumsum(np.concatenate([[0], ids[1:] != ids[:-1]]))
    one = (keys >> np.uint64(7 - bit)) & np.uint64(1)
    zeros = np.add.reduceat(counts * (one == 0), starts).astype(float)
    ones = np.add.reduceat(counts * (one == 1), starts).astype(float)
    ids, logs = ids[starts], log_kt(zeros, ones)
    out = [(ids, zeros, ones, logs, np.ones(len(ids)), place)]
    low = np.uint64((1 << bit) - 1)
    for _ in range(depth - TOP):
        up = ((ids >> np.uint64(bit + 8)) << np.uint64(bit)) | (ids & low)
        ids, place = np.unique(up, return_inverse=True)
        below = np.bincount(place, logs, len(ids))
        zeros = np.bincount(place, zeros, len(ids))
        ones = np.bincount(place, ones, len(ids))
        logs, weight = _weighted(zeros, ones, below)
        out.append((ids, zeros, ones, logs, weight, place))
    return out


def top_sums(keys: np.ndarray, counts: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, ...]:
    """(context byte * 256 + decision, zeros, ones, ln of the children's product) of the
    depth-1 nodes above these keys. Keys must be distinct and ordered."""
    parts = []
    for bit in range(8):
        ids, zeros, ones, logs, _, _ = _levels(keys, counts, bit, depth)[-1]
        node = (ids & np.uint64((1 << bit) - 1)) | np.uint64(1 << bit)
        up = (ids >> np.uint64(bit + 8 * (TOP - 1))) * np.uint64(256) + node
        found, place = np.unique(up, return_inverse=True)
        parts.append((found.astype(np.int64), *(np.bincount(place, v, len(found))
                                                for v in (zeros, ones, logs))))
    return tuple(np.concatenate(x) for x in zip(*parts))


def top_tables(ids, zeros, ones, below) -> tuple[np.ndarray, ...]:
    """(weight, probability of a one) of depth 1 by id, and of depth 0 by decision."""
    full = [np.zeros(65536) for _ in range(3)]
    for array, values in zip(full, (zeros, ones, below)):
        array[np.asarray(ids, np.int64)] = values
    zeros, ones, below = full
    logs, weight1 = _weighted(zeros, ones, below)
    kt1 = (ones + 0.5) / (zeros + ones + 1)
    zeros, ones, below = (x.reshape(256, 256).sum(axis=0) for x in (zeros, ones, logs))
    _, weight0 = _weighted(zeros, ones, below)
    return weight1, kt1, weight0, (ones + 0.5) / (zeros + ones + 1)


def log10_probability(keys: np.ndarray, counts: np.ndarray, tops, depth: int = DEPTH) -> np.ndarray:
    """log10 probability of each key's byte after its context. Keys must be distinct and
    ordered, and hold every counted key of their first TOP context bytes."""
    weight1, kt1, weight0, kt0 = tops
    total = np.zeros(len(keys))
    first = keys >> np.uint64(8 * depth)
    for bit in range(8):
        levels = _levels(keys, counts, bit, depth)
        _, zeros, ones, _, _, at = levels[0]
        p = ((ones + 0.5) / (zeros + ones + 1))[at]
        for _, zeros, ones, _, weight, place in levels[1:]:
            at = place[at]
            p = weight[at] * ((ones + 0.5) / (zeros + ones + 1))[at] + (1 - weight[at]) * p
        node = ((keys & np.uint64(255)) >> np.uint64(8 - bit)) | np.uint64(1 << bit)
        up = (first * np.uint64(256) + node).astype(np.int64)
        p = weight1[up] * kt1[up] + (1 - weight1[up]) * p
        node = node.astype(np.int64)
        p = weight0[node] * kt0[node] + (1 - weight0[node]) * p
        one = (keys >> np.uint64(7 - bit)) & np.uint64(1) == 1
        total += np.log10(np.where(one, p, 1 - p))
    return total
