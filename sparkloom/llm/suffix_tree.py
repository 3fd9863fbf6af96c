"""Substring dedup over words by prefix-partitioned suffix trees.

A window of WINDOW words is removed where its words also start in a document with a smaller
id. Suffixes are split by prefix into groups of memory size: the prefix is the words at a
suffix's anchor (K words, chosen in each window as passages.py says), many rare prefixes
sharing a bucket, and it grows where it is too frequent, up to the whole window. In each
group the suffixes are sorted, which with their common prefixes is the group's subtree: the
internal node at depth WINDOW - j above a suffix, split by the j words to its left, holds
exactly the occurrences of one window. The smallest document of each goes back as a bit.

Suffixes of repeated prefixes only are sent: a prefix seen in one document has no repeat.
Words of a group are numbered by a hash and then compared byte by byte with the first word of
their number; should a hash join different words, they are numbered by content instead.

Edge cases: a null text has no words; a null doc_id counts as the smallest id; rows that
repeat a doc_id are the same document, so they remove nothing from each other; documents of
fewer words than a window keep all; a text may be of any length that a row can have (a task
holds it a few times); an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, real_id, table, word_bounds, word_hashes
from .exchange import MESSAGES, Block, answer, by_bucket, dec, enc, gather, n_buckets, pack, rows_of, whole
from .passages import HOT, Segments, covered, in_parts, repeated, rounds, within

WINDOW, K = 13, 5
#: Bytes of text whose words are found at once, but for a longer word.
SLICE_BYTES = 1 << 20


def word_places(data: np.ndarray, off: np.ndarray, step: int = SLICE_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of a block, and the n+1 bounds of its documents' words.

    Goes through the bytes in slices that end between words, so that a document may be of any length.
    """
    starts, ends, hashes, lo = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while lo < len(data):
        hi = min(lo + step, len(data))
        while hi < len(data):
            tail = data[max(lo, hi - step) : hi]
            blank = np.flatnonzero((tail == 32) | ((tail >= 9) & (tail <= 13)))
            if len(blank):
                hi = hi - len(tail) + int(blank[-1]) + 1
                break
            hi = min(hi + step, len(data))
        inner = off[(off > lo) & (off < hi)] - lo
        part = data[lo:hi]
        a, b, _ = word_bounds(part, np.concatenate(([0], inner, [hi - lo])))
        starts.append(a + lo)
        ends.append(b + lo)
        hashes.append(word_hashes(part, a, b))
        lo = hi
    start = np.concatenate(starts)
    return start, np.concatenate(ends), np.concatenate(hashes), np.searchsorted(start, off)


class Words:
    """The words of a block."""

    def __init__(self, block: Block, step: int = SLICE_BYTES):
        self.block = block
        self.starts, self.ends, self.hash, self.bounds = word_places(block.data, block.off, step)

    def text(self, i: int, n: int) -> bytes:
        """n words from word i, one space between them."""
        return b" ".join(self.block.data[self.starts[i] : self.ends[i + n - 1]].tobytes().split())


def _places(block: Block) -> tuple[np.ndarray, np.ndarray]:
    words = Words(block)
    return words.hash, words.bounds


class Candidates:
    """What a block asks about: its distinct segments at repeated anchors."""

    def __init__(self, words: Words, replies: list, window: int, k: int):
        ids = words.block.ids
        runs, _ = repeated(words.hash, words.bounds, window, k, replies)
        runs = runs.take(np.lexsort((runs.first, ids[runs.of], runs.key)))
        self.count, self.first, before = runs.count, runs.first, runs.place - runs.first
        texts = [words.text(i, n + window - 1) for n, i in zip(self.count.tolist(), self.first.tolist())]
        found, self.doc = Segments(), ids[runs.of]
        self.which = found.add(runs.key, before.tolist(), self.count.tolist(), texts, list(range(len(texts))))
        self.lead = np.array(found.order, np.int64)
        self.key, self.before, self.body, self.id = runs.key[self.lead], before[self.lead], [texts[i] for i in found.order], self.doc[self.lead]

    def messages(self, n: int) -> list[tuple[int, bytes]]:
        out = []
        of, cut = by_bucket(self.key, n)
        for k, a, b in zip(of.tolist(), cut.tolist(), cut[1:].tolist()):
            body = self.body[a:b]
            out.append((k, enc([self.key[a:b], self.before[a:b].astype(np.uint8), self.count[self.lead[a:b]].astype(np.uint8), self.id[a:b], np.fromiter(map(len, body), np.uint32, len(body)), np.frombuffer(b"".join(body), np.uint8)])))
        return out

    def gone(self, bits: np.ndarray) -> np.ndarray:
        """Starts of the windows that go."""
        base = np.concatenate(([0], np.cumsum(self.count[self.lead])))[:-1]
        out = np.repeat(self.doc > self.id[self.which], self.count) if len(self.count) else np.zeros(0, bool)
        if len(out):
            out |= bits[np.repeat(base[self.which], self.count) + within(self.count)].astype(bool)
        return (np.repeat(self.first, self.count) + within(self.count))[out]


def numbered(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for every word, equal exactly for equal words."""
    _, first, word = np.unique(word_hashes(body, starts, ends), return_index=True, return_inverse=True)
    size, like = ends - starts, first[word]
    if np.array_equal(size, size[like]) and np.array_equal(body[np.repeat(starts, size) + within(size)], body[np.repeat(starts[like], size) + within(size)]):
        return word
    seen: dict[bytes, int] = {}
    raw = body.tobytes()
    return np.fromiter((seen.setdefault(raw[a:b], len(seen)) for a, b in zip(starts.tolist(), ends.tolist())), np.int64, len(starts))


def subtrees(key: np.ndarray, before: np.ndarray, count: np.ndarray, doc: np.ndarray, size: np.ndarray, body: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For every window of every segment, in order: whether a smaller document has it.

    Suffixes start at the segments' anchors and are sorted by prefix ``key``, then word by
    word; nodes of the subtrees are runs of them with a common prefix.
    """
    n = len(key)
    if n == 0:
        return np.zeros(0, bool)
    off = np.concatenate(([0], np.cumsum(size.astype(np.int64))))
    starts, ends, _ = word_bounds(body, off)
    word = numbered(body, starts, ends)
    words = count.astype(np.int64) + window - 1
    first = np.concatenate(([0], np.cumsum(words)))[:-1]
    anchor, after = first + before, words - before
    column = lambda j: np.where(j < after, word[np.minimum(anchor + j, len(word) - 1)], -1)
    forward = [column(j) for j in range(window)]
    order = np.lexsort((*reversed(forward), key))
    depth = np.zeros(n, np.int64)  # words that a suffix shares with the one above it
    same = np.concatenate(([False], key[order][1:] == key[order][:-1]))
    for f in forward:
        f = f[order]
        same = same & np.concatenate(([False], (f[1:] == f[:-1]) & (f[1:] >= 0)))
        depth += same
    most = int(before.max())
    out = np.zeros((n, most + 1), bool)
    left = np.zeros(n, np.int64)
    for j in range(most + 1):
        if j:
            # the words to the left, one more each time
            reach = before >= j
            w = np.where(reach, word[np.maximum(anchor - j, 0)], -1)
            _, left = np.unique(left * (len(word) + 2) + w + 1, return_inverse=True)
        rows = np.flatnonzero((before[order] >= j) & (before[order].astype(np.int64) - count[order] < j))
        if len(rows) == 0:
            continue
        node = np.cumsum(depth < window - j)[rows]
        who = order[rows]
        group = np.lexsort((doc[who], left[who], node))
        g, l, d = node[group], left[who][group], doc[who][group]
        new = np.concatenate(([True], (g[1:] != g[:-1]) | (l[1:] != l[:-1])))
        out[who[group], j] = d > d[np.flatnonzero(new)][np.cumsum(new) - 1]
    # windows of a segment start j = before, before - 1, ... words left of its anchor
    row = np.repeat(np.arange(n), count)
    return out[row, before[row].astype(np.int64) - within(count.astype(np.int64))]


def _reply(window: int):
    def reply(blocks: list[int], messages: list[bytes]) -> list[bytes]:
        found, mine, docs, counts = Segments(), [], [], []
        for message in messages:
            key, before, count, ids, size, body = dec(message)
            raw, end = body.tobytes(), np.cumsum(size, dtype=np.int64).tolist()
            mine.append(found.add(key, before.tolist(), count.tolist(), [raw[e - n : e] for n, e in zip(size.tolist(), end)], ids.tolist()))
            docs.append(ids)
            counts.append(count.astype(np.int64))
        key, before, count, size, body = found.arrays()
        doc = np.array(found.order, np.int64)
        bits = in_parts(key, count, size, body, lambda rows, part: subtrees(key[rows], before[rows], count[rows], doc[rows], size[rows], part, window=window))
        base = np.cumsum(count, dtype=np.int64) - count
        return [enc([(np.repeat(own > doc[which], n) | bits[np.repeat(base[which], n) + within(n)]).astype(np.uint8)]) for which, own, n in zip(mine, docs, counts)]

    return reply


def dedup_words(docs: DataFrame, scratch: Scratch, window: int = WINDOW, k: int = K, hot: int = HOT) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row; kept are the words left, one space between."""
    blocks = pack(docs, scratch)
    n = n_buckets(blocks.count())
    flags = rounds(blocks, scratch, _places, window, k, hot, n, True)

    def ask(number, block, replies):
        yield from rows_of(number, Candidates(Words(block), replies, window, k).messages(4 * n))

    told = answer(gather(blocks, flags, scratch, ask, MESSAGES), scratch, _reply(window))

    def result(_, block, replies):
        words = Words(block)
        mask = covered(Candidates(words, replies[:-1], window, k).gone(whole(replies[-1], [np.uint8])[0]), window, len(words.starts))
        sums = np.concatenate(([0], np.cumsum(mask)))
        kept = []
        for a, b in zip(words.bounds, words.bounds[1:]):
            left = block.data[words.starts[a] : words.ends[b - 1]].tobytes().split() if b > a else []
            if sums[b] > sums[a]:
                left = [left[i] for i in np.flatnonzero(~mask[a:b])]
            kept.append(b" ".join(left))
        yield pa.RecordBatch.from_arrays([pa.array(block.ids), pa.array(np.diff(words.bounds)), pa.array(sums[words.bounds[1:]] - sums[words.bounds[:-1]]), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    out = gather(blocks, [*flags, told], scratch, result, "doc_id long, n_words long, n_removed long, kept string")
    return out.withColumn("doc_id", real_id("doc_id"))


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_words(table(spark, sf_dir, "documents"), Scratch(spark, "op9"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


#: Brute force over all windows.
ORACLE = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
p as (select doc_id, w, unnest(range(1, len(w) - 11)) as i from d where len(w) >= 13),
g as (select doc_id, i, array_to_string(w[i:i + 12], ' ') as k from p),
m as (select k, min(doc_id) as first from g group by k having count(distinct doc_id) > 1),
r as (select distinct g.doc_id, g.i + o.o as j from g join m using (k), (select unnest(range(0, 13)) as o) o where g.doc_id > m.first),
x as (select doc_id, list(j) as gone from r group by doc_id),
y as (select d.doc_id, len(d.w) as n_words, coalesce(len(x.gone), 0) as n_removed, d.w, x.gone from d left join x using (doc_id))
select doc_id, n_words::bigint as n_words, n_removed::bigint as n_removed,
  sha256(case when gone is null then array_to_string(w, ' ')
         else coalesce(array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: not list_contains(gone, i)), lambda i: w[i]), ' '), '') end) as kept_sha256
from y
"""
