"""Suffix-array dedup over bytes by column-wise multi-document construction.

A byte is removed where a LENGTH-byte string covers it that also starts earlier: in a
document with a smaller id, or earlier in the same one.

Segments of text whose anchors repeat (passages.py) meet in buckets and are aligned at their
anchors. There the collection's suffix order, Burrows-Wheeler column and common prefixes are
built column by column, as for a set of short documents: every round inserts one symbol of
each segment before its suffix so far, which is a stable sort by that symbol inside the old
order, and updates the common prefixes of neighbours - one more where the symbols agree, with
the minimum over what stood between them. Only the suffixes of the present column are kept,
as equal windows stand at equal columns. Where a neighbour shares LENGTH symbols, the windows
that begin in this column are equal, and all but the earliest go. The columns of symbols are an
external file, written once and read in the order of the rounds, both sequentially; a round
holds a few numbers for each segment. The file is the task's own spill in the folder that Spark
gives its worker for that (SPARK_LOCAL_DIRS): it is gone when the columns are read, and a task
that runs again writes its own.

Edge cases: a null text is empty; texts of under LENGTH bytes keep all; strings are judged on
the input, overlaps count; a null doc_id counts as the smallest; rows that repeat a doc_id
are documents one after another, in the order of a hash of their texts, so that reruns agree;
a text may be of any length that a row can have (a task holds it a few times); an empty table
gives none; extra columns are ignored.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, real_id, table
from .exchange import MESSAGES, Block, answer, by_bucket, dec, enc, gather, n_buckets, pack, rows_of, whole
from .passages import HOT, Segments, covered, in_parts, repeated, rounds, spans_of, within

LENGTH, K = 100, 32


def _places(block: Block) -> tuple[np.ndarray, np.ndarray]:
    return block.data, block.off


class Candidates:
    """A block's distinct segments at repeated anchors.

    Occurrences are ordered by document and place, so the first of a text is the earliest.
    """

    def __init__(self, block: Block, replies: list, length: int, k: int):
        self.length = length
        runs, _ = repeated(block.data, block.off, length, k, replies)
        runs = runs.take(np.lexsort((runs.first, runs.of, block.ties[runs.of], block.ids[runs.of], runs.key)))
        self.count, self.first, before = runs.count, runs.first, runs.place - runs.first
        raw, found = block.data.tobytes(), Segments()
        texts = [raw[i : i + n + length - 1] for n, i in zip(self.count.tolist(), self.first.tolist())]
        self.which = found.add(runs.key, before.tolist(), self.count.tolist(), texts, list(range(len(texts))))
        self.lead = np.array(found.order, np.int64)
        self.key, self.before, self.body = runs.key[self.lead], before[self.lead], [texts[i] for i in found.order]
        of = runs.of[self.lead]
        self.id, self.tie, self.at = block.ids[of], block.ties[of], runs.place[self.lead] - block.off[of]

    def messages(self, n: int) -> list[tuple[int, bytes]]:
        out = []
        of, cut = by_bucket(self.key, n)
        for k, a, b in zip(of.tolist(), cut.tolist(), cut[1:].tolist()):
            out.append((k, enc([self.key[a:b], self.before[a:b].astype(np.uint8), self.count[self.lead[a:b]].astype(np.uint8), self.id[a:b], self.tie[a:b], self.at[a:b].astype(np.int64), np.frombuffer(b"".join(self.body[a:b]), np.uint8)])))
        return out

    def gone(self, bits: np.ndarray) -> np.ndarray:
        """Starts of the windows that an earlier one equals."""
        per = self.count[self.lead]
        base = np.concatenate(([0], np.cumsum(per)))[:-1]
        earliest = np.zeros(len(self.which), bool)
        earliest[self.lead] = True
        out = np.repeat(~earliest, self.count)
        if len(out):
            out |= bits[np.repeat(base[self.which], self.count) + within(self.count)].astype(bool)
        return (np.repeat(self.first, self.count) + within(self.count))[out]


def spill_folder() -> str | None:
    """Where Spark lets a worker of this executor write what is only its own."""
    return next((d for d in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if d and os.path.isdir(d)), None)


def columns(before: np.ndarray, size: np.ndarray, body: np.ndarray, left: int, right: int):
    """The symbols (byte + 1, 0 outside) of all segments in each column, from the last to the first."""
    n, first = len(before), np.concatenate(([0], np.cumsum(size)))[:-1]
    offset = before.astype(np.int64) - left
    with tempfile.TemporaryFile(dir=spill_folder()) as file:
        for c in range(left + right - 1, -1, -1):
            place = offset + c
            inside = (place >= 0) & (place < size)
            file.write(np.where(inside, body[np.where(inside, first + place, 0)].astype(np.uint16) + 1, 0).astype(np.uint16).tobytes())
        file.seek(0)
        for c in range(left + right - 1, -1, -1):
            yield c, np.frombuffer(file.read(2 * n), np.uint16)


def collection(group: np.ndarray, before: np.ndarray, size: np.ndarray, body: np.ndarray, length: int, left: int):
    """Inserts a column of symbols per round; yields (column, order, common prefixes).

    ``group`` numbers the anchors in order; suffixes of different groups share nothing.
    """
    n = len(group)
    right = int((size - before).max())
    order = np.argsort(group, kind="stable")
    grouped = group[order]
    edge = np.concatenate(([True], grouped[1:] != grouped[:-1]))
    begin = np.flatnonzero(edge)[np.cumsum(edge) - 1]  # place at which each place's group begins
    shared = np.zeros(n, np.int16)
    for c, symbol in columns(before, size, body, left, right):
        s = symbol[order]
        falls = ~edge & (s < np.concatenate(([0], s[:-1])))
        if falls.any():
            # only groups whose order changes are sorted anew
            moved = np.zeros(n, bool)
            moved[begin[falls]] = True
            rows = np.flatnonzero(moved[begin])
            old = rows[np.lexsort((s[rows], begin[rows]))]
            a, b = old[:-1], old[1:]
            agree = (s[a] == s[b]) & (begin[a] == begin[b])
            new = np.zeros(len(rows), np.int16)
            if agree.any():
                # the least common prefix between the two old places, which lie in one group
                cut = np.empty(2 * int(agree.sum()), np.int64)
                cut[0::2], cut[1::2] = a[agree] + 1, b[agree] + 1
                padded = np.concatenate((shared, [0]))
                new[1:][agree] = np.minimum.reduceat(padded, cut)[0::2] + 1
            same = ~edge & (s == np.concatenate(([0], s[:-1])))
            shared = np.where(same, shared + 1, 0).astype(np.int16)
            shared[rows] = new
            order[rows] = order[old]
            s = s.copy()
            s[rows] = s[old]
        else:
            same = ~edge & (s == np.concatenate(([0], s[:-1])))
            shared = np.where(same, shared + 1, 0).astype(np.int16)
        shared[s == 0] = 0
        np.minimum(shared, length, out=shared)
        yield c, order, shared


def decide(key: np.ndarray, before: np.ndarray, count: np.ndarray, rank: np.ndarray, body: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For every window of every segment, in order: whether one of a lower ``rank`` equals it."""
    n = len(key)
    if n == 0:
        return np.zeros(0, bool)
    size = count.astype(np.int64) + length - 1
    before = before.astype(np.int64)
    _, group = np.unique(key, return_inverse=True)
    left = int(before.max())
    out = np.zeros((n, left + 1), bool)
    for c, order, shared in collection(group, before, size, body, length, left):
        j = left - c  # symbols from this column to the anchor
        if j < 0:
            continue
        here = (before >= j) & (before - count < j)
        if not here.any():
            continue
        new = shared < length
        start = np.flatnonzero(new)
        least = np.minimum.reduceat(rank[order], start)[np.cumsum(new) - 1]
        out[order, j] = (rank[order] != least) & here[order]
    row = np.repeat(np.arange(n), count)
    return out[row, before[row] - within(count.astype(np.int64))]


def _reply(length: int):
    def reply(blocks: list[int], messages: list[bytes]) -> list[bytes]:
        found, mine, order, counts = Segments(), [], [], []
        for block, message in zip(blocks, messages):
            key, before, count, ids, ties, at, body = dec(message)
            raw, end = body.tobytes(), np.cumsum(count.astype(np.int64) + length - 1)
            own = [(i, t, block, a) for i, t, a in zip(ids.tolist(), ties.tolist(), at.tolist())]
            mine.append(found.add(key, before.tolist(), count.tolist(), [raw[e - n - length + 1 : e] for n, e in zip(count.tolist(), end.tolist())], own))
            order.append(own)
            counts.append(count.astype(np.int64))
        key, before, count, size, body = found.arrays()
        rank = np.empty(len(key), np.int64)
        rank[np.lexsort([np.array(x) for x in zip(*((a, b, t, i) for i, t, b, a in found.order))])] = np.arange(len(key))
        bits = in_parts(key, count, size, body, lambda rows, part: decide(key[rows], before[rows], count[rows], rank[rows], part, length=length))
        base, out = np.cumsum(count, dtype=np.int64) - count, []
        for which, own, n in zip(mine, order, counts):
            lead = np.fromiter((found.order[k] == o for k, o in zip(which.tolist(), own)), bool, len(own))
            out.append(enc([(~np.repeat(lead, n) | bits[np.repeat(base[which], n) + within(n)]).astype(np.uint8)]))
        return out

    return reply


def dedup_bytes(docs: DataFrame, scratch: Scratch, length: int = LENGTH, k: int = K, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row; kept are the bytes left."""
    if not k < length <= 255:
        raise ValueError("the anchor must be shorter than the string, and this at most 255 bytes")
    blocks = pack(docs, scratch)
    n = n_buckets(blocks.count())
    flags = rounds(blocks, scratch, _places, length, k, hot, n, False)

    def ask(number, block, replies):
        yield from rows_of(number, Candidates(block, replies, length, k).messages(4 * n))

    told = answer(gather(blocks, flags, scratch, ask, MESSAGES), scratch, _reply(length))

    def result(_, block, replies):
        found = Candidates(block, replies[:-1], length, k)
        mask = covered(found.gone(whole(replies[-1], [np.uint8])[0]), length, len(block.data))
        gone = np.diff(np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))[block.off])
        size = np.diff(block.off)
        left = block.data[~mask].tobytes()
        ends = np.concatenate(([0], np.cumsum(size - gone))).tolist()
        kept = [left[a:b] for a, b in zip(ends, ends[1:])]
        cols = [pa.array(block.ids), pa.array(size), pa.array(gone), pa.array(spans_of(mask, block.off)), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    out = gather(blocks, [*flags, told], scratch, result, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumn("doc_id", real_id("doc_id"))


def op8_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_bytes(table(spark, sf_dir, "documents"), Scratch(spark, "op8"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: Brute force over all strings, as lower-case hex. For tables without repeated or null ids.
ORACLE = r"""
with d as (select doc_id, lower(hex(encode(coalesce(text, '')))) as x from documents),
p as (select doc_id, unnest(range(0, greatest(0, strlen(x) // 2 - 99))) as i, x from d),
g as (select doc_id, i, md5(substr(x, 2 * i + 1, 200)) as k from p),
f as (select doc_id, i, row_number() over (partition by k order by doc_id, i) > 1 as gone from g),
s as (select doc_id, i as a, i + 100 as b from f where gone),
t as (select *, max(b) over (partition by doc_id order by a rows between unbounded preceding and 1 preceding) as seen from s),
u as (select *, sum(case when seen is null or a > seen then 1 else 0 end) over (partition by doc_id order by a) as span from t),
v as (select doc_id, span, min(a) as a, max(b) as b from u group by all),
w as (select doc_id, count(*) as n_spans, sum(b - a) as n_removed, list(struct_pack(a := a, b := b) order by a) as l from v group by doc_id),
k as (select d.doc_id, strlen(x) // 2 as n, coalesce(n_spans, 0) as n_spans, coalesce(n_removed, 0) as n_removed,
        case when l is null then x else array_to_string(list_transform(range(1, len(l) + 2), lambda j: substr(x, case when j = 1 then 1 else 2 * l[j - 1].b + 1 end,
          (case when j > len(l) then strlen(x) // 2 else l[j].a end - case when j = 1 then 0 else l[j - 1].b end) * 2)), '') end as y
      from d left join w using (doc_id))
select doc_id, n::bigint as n_bytes, n_removed::bigint as n_removed, n_spans::bigint as n_spans, sha256(unhex(y)) as kept_sha256 from k
"""
