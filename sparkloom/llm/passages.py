"""Candidate search that the substring operators share.

A window of the wanted length can only repeat if the anchor in it repeats: the smallest hash
of its k-grams, the leftmost if several are equal. Equal windows have equal anchors at equal
places, so windows whose anchor occurs once are done. The others travel as segments - runs of
neighbouring windows with one anchor - to the bucket of their anchor, where the operators
compare their contents; equal segments travel once from a block, and are one in a bucket.

An anchor that occurs over ``hot`` times would make too large a group, so it grows: the windows
of a run are split into those that hold a longer anchor which goes on to the right of the old
one, and those that hold one which begins further to the left; windows are equal only if their
grown anchors are. Those that occur once drop out; others that are still hot grow once more,
to whole windows. Then a group holds equal windows, at most one of a block, and in its bucket
they are one. Each growth is one more round of the exchange, and there is none without hot
anchors. Longer anchors make smaller groups and change no result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from .common import Scratch, mix64
from .exchange import Block, route, whole

#: Over so many occurrences, an anchor grows.
HOT = 100_000
#: Places that are hashed at once; every place takes some 64-bit numbers for a while.
SLICE = 1 << 20


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    out, have = x, 1
    while 2 * have <= width:
        out, have = np.minimum(out[:-have], out[have:]), 2 * have
    if have < width:
        rest = width - have
        out = np.minimum(out[: len(out) - rest], out[rest:])
    return out


def gram_hashes(x: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive values, by doubling; k is any positive number."""
    if len(x) < k:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        power = np.uint64(0x9E3779B97F4A7C15)
        out, have, bits = None, 0, k
        part, size = x.astype(np.uint64), 1
        while bits:
            if bits & 1:
                if out is None:
                    out, have = part, size
                else:
                    n = len(x) - have - size + 1
                    out = out[:n] * power + part[have : have + n]
                    have += size
            bits >>= 1
            if bits:
                n = len(part) - size
                part = part[:n] * power + part[size : size + n]
                power, size = power * power, 2 * size
        return mix64(out[: len(x) - k + 1] + np.uint64(k))


def anchors_of(grams: np.ndarray, width: int) -> np.ndarray:
    """For every ``width`` consecutive grams, the place of the smallest, the leftmost of equals."""
    if len(grams) < width:
        return np.zeros(0, np.int64)
    low = np.uint64((1 << 24) - 1)
    key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    return (sliding_min(key, width) & low).astype(np.int64)


@dataclass
class Runs:
    """Runs of ``count`` neighbouring windows from ``first`` of document ``of``, with one anchor at ``place``."""

    key: np.ndarray
    place: np.ndarray
    first: np.ndarray
    count: np.ndarray
    of: np.ndarray

    def take(self, rows: np.ndarray) -> Runs:
        return Runs(self.key[rows], self.place[rows], self.first[rows], self.count[rows], self.of[rows])

    def __add__(self, other: Runs) -> Runs:
        return Runs(*(np.concatenate((getattr(self, k), getattr(other, k))) for k in ("key", "place", "first", "count", "of")))


NONE = Runs(np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(4)))


def _salted(h: np.ndarray, salt: int) -> np.ndarray:
    # mixed anew: as minima of their windows, the hashes themselves crowd at the low end
    return mix64(h ^ np.uint64(0xA5A5A5A55A5A5A5A + salt))


def windows(x: np.ndarray, bounds: np.ndarray, length: int, k: int, step: int = SLICE) -> Runs:
    """The windows of documents, which ``bounds`` (n+1 places) part, by anchor; ``x`` has a number
    for every place. Goes through the places ``step`` at a time, so that a document may be of any length."""
    step, out = min(step, (1 << 24) - 2 * length), [NONE]
    for lo in range(0, len(x) - length + 1, step):
        grams = gram_hashes(x[lo : lo + step + length - 1], k)
        at = anchors_of(grams, length - k + 1)
        start = np.arange(lo, lo + len(at))
        doc = np.searchsorted(bounds, start, side="right") - 1
        inside = start + length <= bounds[np.minimum(doc + 1, len(bounds) - 1)]
        at, start, doc = at[inside], start[inside], doc[inside]
        if len(at) == 0:
            continue
        run = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 0) | (np.diff(doc) != 0))))
        out.append(Runs(_salted(grams[at[run]], 0), lo + at[run], start[run], np.diff(np.concatenate((run, [len(at)]))), doc[run]))
    found = out[0]
    return Runs(*(np.concatenate([getattr(r, name) for r in out]) for name in ("key", "place", "first", "count", "of"))) if len(out) > 1 else found


def hashes_at(x: np.ndarray, places: np.ndarray, size: int, step: int = SLICE) -> np.ndarray:
    """The hash of the ``size`` values from each place."""
    out = np.zeros(len(places), np.uint64)
    for lo in range(0, len(x), step):
        rows = np.flatnonzero((places >= lo) & (places < lo + step))
        if len(rows):
            out[rows] = gram_hashes(x[lo : lo + step + size - 1], size)[places[rows] - lo]
    return out


def sizes(length: int, k: int) -> list[int]:
    """Lengths of the anchor as it grows."""
    middle = (length + k + 1) // 2
    return [k, middle, length] if k < middle < length else [k, length]


def grown(x: np.ndarray, runs: Runs, old: int, new: int, length: int) -> Runs:
    """The same windows by anchors of ``new`` values that hold the old ones of ``old``."""
    if len(runs.key) == 0:
        return NONE
    if new == length:
        at = np.repeat(runs.first, runs.count) + within(runs.count)
        return Runs(_salted(hashes_at(x, at, new), new), at, at, np.ones(len(at), np.int64), np.repeat(runs.of, runs.count))
    edge = np.clip(runs.place + new - length, runs.first, runs.first + runs.count)  # from here, windows reach to the right end
    right = Runs(runs.key, runs.place, edge, runs.first + runs.count - edge, runs.of)
    left = Runs(runs.key, runs.place + old - new, runs.first, edge - runs.first, runs.of)
    out = []
    for side, part in enumerate((right, left)):
        part = part.take(np.flatnonzero(part.count > 0))
        part.key = _salted(hashes_at(x, part.place, new), 2 * new + side)
        out.append(part)
    return out[0] + out[1]


def within(n: np.ndarray) -> np.ndarray:
    """0, 1, ... n-1 for each n."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _kinds(runs: Runs, flag: np.ndarray) -> np.ndarray:
    """Of each run's anchor: 0 if it occurs once, 1 if it repeats, 2 if it is hot."""
    return flag[np.unique(runs.key, return_inverse=True)[1]] if len(runs.key) else np.zeros(0, np.uint8)


def repeated(x: np.ndarray, bounds: np.ndarray, length: int, k: int, replies: list) -> tuple[Runs, Runs]:
    """Runs whose anchors repeat, after the rounds answered so far; and those whose anchors are
    asked about in the next round."""
    levels, done = sizes(length, k), NONE
    runs = windows(x, bounds, length, k)
    for level, reply in enumerate(replies):
        kind = _kinds(runs, whole(reply, [np.uint8])[0])
        last = level == len(levels) - 1
        done = done + runs.take(np.flatnonzero(kind >= 1 if last else kind == 1))
        runs = NONE if last else grown(x, runs.take(np.flatnonzero(kind == 2)), levels[level], levels[level + 1], length)
    return done, runs


def rounds(blocks: DataFrame, scratch: Scratch, places: Callable[[Block], tuple[np.ndarray, np.ndarray]], length: int, k: int, hot: int, buckets: int, by_document: bool) -> list[DataFrame]:
    """Finds out which anchors repeat, and grows hot ones; answers for ``repeated``.

    ``places`` gives the numbers and bounds of a block. With ``by_document`` an anchor counts
    once for a document of a block.
    """

    def emit(block: Block, replies: list):
        x, bounds = places(block)
        _, runs = repeated(x, bounds, length, k, replies)
        keys = runs.key
        if by_document and len(keys):
            ids = block.ids[runs.of]
            order = np.lexsort((ids, keys))
            keys, ids = keys[order], ids[order]
            keys = keys[np.concatenate(([True], (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])))]
        u, n = np.unique(keys, return_counts=True)
        return [(u, [n.astype(np.uint32)])]

    def combine(stream, group, values, size):
        n = np.bincount(group, values[0]) if len(group) else np.zeros(0)
        return [np.where(n > hot, 2, n > 1).astype(np.uint8)]

    backs: list[DataFrame] = []
    for _ in sizes(length, k):
        back, found = route(blocks, scratch, emit, combine, lambda stream, keys, out: [np.count_nonzero(out[0] == 2)], buckets, tuple(backs))
        backs.append(back)
        if not found or not found[0]:
            break
    return backs


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places lie in a window that begins at one of ``starts``."""
    change = np.zeros(n + length + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + length, -1)
    return np.cumsum(change[:n], dtype=np.int32) > 0


def spans_of(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of maximal runs of True in each part between bounds."""
    if len(mask) == 0:
        return np.zeros(len(bounds) - 1, np.int64)
    begin = mask.copy()
    begin[1:] &= ~mask[:-1]
    inner = bounds[1:-1][bounds[1:-1] < len(mask)]
    begin[inner] = mask[inner]
    sums = np.concatenate(([0], np.cumsum(begin)))
    return sums[bounds[1:]] - sums[bounds[:-1]]


#: Bytes of segments that a bucket's task works on at once, but for a single anchor's.
PART_BYTES = 1 << 20


def in_parts(key: np.ndarray, count: np.ndarray, size: np.ndarray, body: np.ndarray, decide, limit: int = PART_BYTES) -> np.ndarray:
    """A bucket's decisions, made for whole anchors at a time, so that the work's memory is bounded.

    ``decide(rows, body)`` answers for every window of some segments; a segment has ``count``
    windows and ``size`` bytes of ``body``. Returns the answers in the order of the segments.
    """
    out = np.zeros(int(count.sum(dtype=np.int64)), bool)
    if len(key) == 0:
        return out
    size = size.astype(np.int64)
    first, answer = np.cumsum(size) - size, np.cumsum(count, dtype=np.int64) - count
    order = np.argsort(key, kind="stable")
    total = np.cumsum(size[order])
    edge = np.flatnonzero(np.concatenate((key[order][1:] != key[order][:-1], [True]))) + 1
    at = 0
    while at < len(order):
        upto = np.searchsorted(total, (total[at - 1] if at else 0) + limit, side="right")
        end = edge[max(np.searchsorted(edge, upto, side="right") - 1, np.searchsorted(edge, at, side="right"))]
        rows = order[at:end]
        n = size[rows]
        found = decide(rows, body[np.repeat(first[rows], n) + within(n)])
        n = count[rows].astype(np.int64)
        out[np.repeat(answer[rows], n) + within(n)] = found
        at = int(end)
    return out


class Segments:
    """The distinct segments of one block or bucket: by key, place of the anchor, number of windows and content.

    ``order`` decides which of equal ones stands for all: the smallest.
    """

    def __init__(self):
        self.seen: dict[bytes, int] = {}
        self.order: list[tuple] = []

    def add(self, key: np.ndarray, before: list[int], count: list[int], contents: list[bytes], order: list[tuple]) -> np.ndarray:
        """Adds segments; returns the number of each among the distinct ones."""
        raw, out = np.ascontiguousarray(key).tobytes(), np.empty(len(contents), np.int64)
        for i, (b, n, c, o) in enumerate(zip(before, count, contents, order)):
            k = self.seen.setdefault(raw[8 * i : 8 * i + 8] + bytes((b, n)) + c, len(self.order))
            if k == len(self.order):
                self.order.append(o)
            elif o < self.order[k]:
                self.order[k] = o
            out[i] = k
        return out

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Key, place of the anchor, number of windows, size of each, and all contents."""
        head = np.frombuffer(b"".join(t[:10] for t in self.seen), np.uint8).reshape(-1, 10)
        size = np.fromiter((len(t) - 10 for t in self.seen), np.int64, len(self.seen))
        return np.ascontiguousarray(head[:, :8]).view(np.uint64).reshape(-1), head[:, 8].copy(), head[:, 9].copy(), size, np.frombuffer(b"".join(t[10:] for t in self.seen), np.uint8)
