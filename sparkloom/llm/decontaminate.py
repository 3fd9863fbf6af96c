"""Benchmark decontamination by SimHash windows and multi-index Hamming search.

Words are runs of letters and digits, lower-cased; shingles are SHINGLE words (repeats
count; of a shorter text, all its words are one shingle). For every length that a benchmark
item has, a window of that many words slides over each document (a shorter document is one
window). The windows' SimHash fingerprints are looked up in a multi-index of the items of that
length: the 64 bits are BLOCKS blocks, and an item within RADIUS bits agrees with the window in
some block up to RADIUS div BLOCKS bits, so that no fingerprint within the radius is lost.
Candidates are verified by the exact weighted Jaccard similarity of their shingles, weighted
by occurrences. At a similarity of 0.8 a fingerprint is outside the radius with a probability
of about one in a thousand (a test measures it).

Fingerprints are only made of windows in which at least as many shingles occur anywhere in
the benchmark as the similarity needs; any other window can't pass the verification.

One pass over the documents serves a benchmark of up to PART_BYTES of text, with any number of
items; its index takes a few times its text in a worker. Beyond that bound, which public
benchmarks together stay below, every further PART_BYTES is a pass.

Edge cases: null or empty texts, and items without a word, match nothing; equal items each
match; repeated rows each give rows; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, prepare, slices, table, text_arrays, word_bounds, word_hashes

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 19
BLOCKS, PART_BYTES = 8, 64 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[[b for b in range(128) if not chr(b).isalnum()]] = 32


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the normalised words of all texts, and n+1 bounds by text."""
    data, off = text_arrays(pc.utf8_lower(texts.fill_null("")))
    data = _FOLD[data]
    starts, ends, doc = word_bounds(data, off)
    return word_hashes(data, starts, ends), np.searchsorted(doc, np.arange(len(off)))


def shingles(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n consecutive words, regardless of document bounds."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = h[: len(h) - n + 1].copy()
        for k in range(1, n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - n + 1 + k]
        return mix64(out + np.uint64(n))


def simhash_rows(h: np.ndarray) -> np.ndarray:
    """SimHash of each row of shingle hashes."""
    ones = np.unpackbits(np.ascontiguousarray(h).view(np.uint8).reshape(h.shape[0], h.shape[1], 8), axis=2, bitorder="little").sum(axis=1, dtype=np.int32)
    return np.packbits(2 * ones > h.shape[1], axis=1, bitorder="little").view(np.uint64)[:, 0]


class MultiIndex:
    """Fingerprints in blocks of bits; every value of a block lists the items near it there."""

    def __init__(self, fps: np.ndarray, radius: int = RADIUS, blocks: int = BLOCKS):
        self.fps, self.radius, self.width = fps, radius, 64 // blocks
        values = np.arange(1 << self.width, dtype=np.uint64)
        self.lists = np.zeros((blocks, len(values), (len(fps) + 63) // 64), np.uint64)
        for b in range(blocks):
            near = np.bitwise_count(values[:, None] ^ self._value(fps, b)[None, :]) <= radius // blocks
            near = np.pad(near, ((0, 0), (0, -len(fps) % 64)))
            self.lists[b] = np.packbits(near, axis=1, bitorder="little").view(np.uint64)

    def _value(self, fp: np.ndarray, block: int) -> np.ndarray:
        return fp >> np.uint64(self.width * block) & np.uint64((1 << self.width) - 1)

    def near(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, item) of all pairs within the radius."""
        bits = np.zeros((len(fp), self.lists.shape[2]), np.uint64)
        for b in range(len(self.lists)):
            bits |= self.lists[b, self._value(fp, b).astype(np.int64)]
        row, item = np.nonzero(np.unpackbits(bits.view(np.uint8), axis=1, bitorder="little")[:, : len(self.fps)])
        close = np.bitwise_count(fp[row] ^ self.fps[item]) <= self.radius
        return row[close], item[close]


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: the sum of the smaller counts by that of the larger ones."""
    low = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return low / (sum(a.values()) + sum(b.values()) - low)


class Benchmark:
    """The items of one part, by length in words."""

    def __init__(self, item_ids: list[int], texts: list[str], shingle: int = SHINGLE, least: float = SIMILARITY, radius: int = RADIUS):
        self.shingle, self.least, self.ids = shingle, least, item_ids
        h, at = words_of(pa.array(texts, pa.string()))
        self.shingles: list[np.ndarray] = []  # of each item
        by_length: dict[int, list[int]] = {}
        for i in range(len(item_ids)):
            own = h[at[i] : at[i + 1]]
            self.shingles.append(shingles(own, min(shingle, len(own))) if len(own) else own)
            if len(own):
                by_length.setdefault(len(own), []).append(i)
        self.items = {n: np.array(own) for n, own in sorted(by_length.items())}
        self.index = {n: MultiIndex(simhash_rows(np.stack([self.shingles[i] for i in own])), radius) for n, own in by_length.items()}
        self.known = {k: np.unique(np.concatenate([self.shingles[i] for n, own in by_length.items() if min(shingle, n) == k for i in own])) for k in {min(shingle, n) for n in by_length}}

    def matches(self, texts: pa.Array) -> list[tuple[int, int, float, int]]:
        """(text, item id, similarity, first word) of the best window of each matching pair."""
        best: dict[tuple[int, int], tuple[float, int]] = {}
        if not self.items:
            return []
        h, at = words_of(texts)
        for k, known in self.known.items():
            s = shingles(h, k)
            place = np.minimum(np.searchsorted(known, s), len(known) - 1)
            hit = known[place] == s
            sums = np.concatenate(([0], np.cumsum(hit)))
            end = np.maximum(at[1:] - k + 1, at[:-1])  # a document's shingles, whole ones only
            lo, hi = np.minimum(at[:-1], len(s)), np.minimum(end, len(s))
            for d in np.flatnonzero(sums[hi] > sums[lo]):
                mine, seen = s[lo[d] : hi[d]], sums[lo[d] : hi[d] + 1]
                for n, items in self.items.items():
                    if min(self.shingle, n) != k:
                        continue
                    want = n - k + 1
                    size = min(want, len(mine))
                    # of W and V shingles, m common ones give m / (W + V - m)
                    need = self.least / (1 + self.least) * (want + size) - 1e-9
                    if seen[-1] - seen[0] < need:
                        continue
                    start = np.flatnonzero(seen[size:] - seen[: len(seen) - size] >= need)
                    for part in np.array_split(start, max(1, len(start) * size // 200_000)):
                        if len(part) == 0:
                            continue
                        found = mine[part[:, None] + np.arange(size)]
                        row, item = self.index[n].near(simhash_rows(found))
                        for r, i in zip(row.tolist(), items[item].tolist()):
                            score = similarity(Counter(found[r].tolist()), Counter(self.shingles[i].tolist()))
                            if score >= self.least and score > best.get((int(d), i), (0.0, 0))[0]:
                                best[int(d), i] = score, int(part[r])
        return [(d, self.ids[i], score, start) for (d, i), (score, start) in sorted(best.items())]


def benchmark_parts(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items, a bounded part at a time."""
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    r = items.agg(F.coalesce(F.sum(F.octet_length("text") + F.lit(8)), F.lit(0)).alias("b")).first()
    parts = -(-r.b // PART_BYTES) * 2 if r.b > PART_BYTES else 1
    mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for k in range(parts):
        yield sorted(((x.item_id, x.text) for x in items.where(mine == k).collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))


_BUILT: dict[str, Benchmark] = {}


def _built(key: str, sent, parameters: dict) -> Benchmark:
    """The part's index, made once in a worker and kept until another part comes."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Benchmark([i for i, _ in sent.value], [t for _, t in sent.value], **parameters)
    return _BUILT[key]


def contaminated(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """(doc_id, item_id, similarity, first_word) of every pair at or above the similarity."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for items in benchmark_parts(benchmark):
        sent = spark.sparkContext.broadcast(items)

        def run(batches, sent=sent, key=uuid.uuid4().hex):
            for b in batches:
                for part in slices(b):
                    found = _built(key, sent, parameters).matches(part.column(1))
                    if found:
                        d, i, s, w = zip(*found)
                        yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(d)), pa.array(i, pa.int64()), pa.array(s, pa.float64()), pa.array(w, pa.int64())], ["doc_id", "item_id", "similarity", "first_word"])

        one = docs.mapInArrow(run, "doc_id long, item_id long, similarity double, first_word long")
        out = one if out is None else out.unionAll(one)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; no shuffle."""
    spark = docs.sparkSession
    prepare(spark)
    for items in benchmark_parts(benchmark):
        sent = spark.sparkContext.broadcast(items)

        def run(batches, sent=sent, key=uuid.uuid4().hex):
            for b in batches:
                for part in slices(b):
                    text = part.column(part.schema.get_field_index("text"))
                    bad = {d for d, *_ in _built(key, sent, parameters).matches(text)}
                    yield part.take(pa.array([i for i in range(part.num_rows) if i not in bad], pa.int64()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
