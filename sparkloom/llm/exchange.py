"""Blocks of documents, and a packed exchange of sorted keys between them.

Operators that need a figure from the whole corpus for each of very many keys (n-grams,
repeated passages) work in three steps:

- ``pack`` writes the documents as blocks of about BLOCK_BYTES of text, one compressed row each,
  in buckets of the block's number, so that blocks don't move when answers come to them;
- ``route`` sends every block's distinct sorted keys, with values, to buckets of the key range,
  combines them there, and sends back per key what the block needs, in the block's own order;
- ``gather`` brings each block together with what came back, and runs a function on it.

Keys are distinct per block, so a key that fills the corpus costs one entry a block, and
buckets are ranges of hashes, so they are even. There are about as many buckets as blocks, so
that neither a block nor a bucket grows with the corpus: what a task holds is bounded at any
size. A block sends a bucket at most one message and at most one entry a key, so the bytes
sent are in proportion to the text; the messages' own overhead grows with the square of the
number of blocks until each holds one entry, which larger blocks put off. Messages hold
differences of sorted keys, compressed. A block is one row; a document longer than a block
has one of its own, and operators go through blocks in slices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import NULL_ID, Scratch, groups, ids, slices, text_arrays

#: Text of a block. Operators work on slices of it.
BLOCK_BYTES = 8 << 20


def enc(arrays: list[np.ndarray]) -> bytes:
    """Arrays of integers as one compressed message; increasing 64-bit keys shrink well."""
    parts = [np.array([len(arrays)], np.int64).tobytes()]
    for a in arrays:
        a = np.ascontiguousarray(a)
        kind, width = a.dtype.kind, a.dtype.itemsize
        delta = width == 8 and kind == "u" and len(a) > 1
        if delta:
            a = np.concatenate((a[:1], np.diff(a)))
        if width > 1:
            a = a.view(np.uint8).reshape(-1, width).T
        parts += [np.array([ord(kind), width, delta, a.size], np.int64).tobytes(), np.ascontiguousarray(a).tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def dec(message: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(message)
    (n,), at, out = np.frombuffer(raw, np.int64, 1), 8, []
    for _ in range(n):
        kind, width, delta, size = np.frombuffer(raw, np.int64, 4, at)
        a = np.frombuffer(raw, np.uint8, size, at + 32)
        if width > 1:
            a = np.ascontiguousarray(a.reshape(width, -1).T).reshape(-1)
        a = a.view(f"{chr(kind)}{width}")
        out.append(np.cumsum(a, dtype=np.uint64) if delta else a)
        at += 32 + int(size)
    return out


class Block:
    """Documents of a block: ids, a small flag and a number (of the text) each, and their UTF-8 bytes."""

    def __init__(self, message: bytes):
        self.ids, self.flags, self.ties, size, self.data = dec(message)
        self.off = np.concatenate(([0], np.cumsum(size.astype(np.int64))))


EMPTY = Block(enc([np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(0, np.uint32), np.zeros(0, np.uint32), np.zeros(0, np.uint8)]))


def pack(docs: DataFrame, scratch: Scratch, flag: Column | None = None, apart: Column | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Writes blocks (block, cls, blob). Rows with different ``apart`` are in different blocks."""
    docs = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.col("text").cast("string").alias("text"),
        (F.lit(0) if flag is None else flag).cast("int").alias("flag"), (F.lit(0) if apart is None else apart).cast("int").alias("cls"), (F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF))).alias("tie"),
    )

    def run(batches):
        from pyspark import TaskContext

        base, n = TaskContext.get().partitionId() << 32, 0
        held: dict[int, list] = {}

        def full(cls: int, least: int):
            nonlocal n
            got = held.get(cls)
            if got and sum(len(x[4]) for x in got) >= least:
                cols = [np.concatenate([x[k] for x in got]) for k in range(5)]
                held[cls] = []
                n += 1
                yield pa.RecordBatch.from_arrays([pa.array([base + n]), pa.array([cls], pa.int32()), pa.array([enc(cols)], pa.binary())], ["block", "cls", "blob"])

        for b in batches:
            for part in slices(b, limit=block_bytes // 2):
                key, flags, cls, tie = ids(part.column(0)), part.column(2).fill_null(0).to_numpy(), part.column(3).fill_null(0).to_numpy(), part.column(4).to_numpy()
                data, off = text_arrays(part.column(1))
                size = np.diff(off)
                for c in np.unique(cls).tolist():
                    rows = cls == c
                    own = data if rows.all() else data[np.repeat(rows, size)]
                    held.setdefault(c, []).append((key[rows], flags[rows].astype(np.uint8), tie[rows].astype(np.uint32), size[rows].astype(np.uint32), own.copy()))
                    yield from full(c, block_bytes)
        for c in list(held):
            if held[c]:
                yield from full(c, 0)

    return scratch.save_by(docs.mapInArrow(run, "block long, cls int, blob binary"), "block", "blocks")


def n_buckets(blocks: int) -> int:
    """A power of two, at least the number of blocks."""
    return 1 << max(5, (max(1, blocks) - 1).bit_length())


#: A block's keys and values of one kind; keys are distinct and increasing.
Stream = tuple[np.ndarray, list[np.ndarray]]


def rows_of(block: int, rows: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    """A block's messages (bucket, message) as one batch."""
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([block] * len(rows)), pa.array([k for k, _ in rows], pa.int64()), pa.array([m for _, m in rows], pa.binary())], ["block", "bucket", "message"])


MESSAGES = "block long, bucket long, message binary"


def by_bucket(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that sorted keys fall into, and the bounds of their keys."""
    of = keys >> np.uint64(64 - (n.bit_length() - 1))
    begin = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else np.zeros(0, np.int64)
    return of[begin].astype(np.int64), np.concatenate((begin, [len(keys)]))


def route(blocks: DataFrame, scratch: Scratch, emit: Callable[[Block, list], list[Stream]], combine: Callable[[int, np.ndarray, list[np.ndarray], np.ndarray], list[np.ndarray]], totals: Callable[[int, np.ndarray, list[np.ndarray]], list[int]] | None = None, buckets: int | None = None, backs: tuple[DataFrame, ...] = ()) -> tuple[DataFrame, list[int]]:
    """Sends keys to buckets and what ``combine`` makes of them back.

    ``emit(block, replies)`` gets what earlier rounds, ``backs``, answered the block.
    ``combine(stream, group, values, size)`` gets, for all entries of a bucket, the number of
    their distinct key, and returns arrays with one entry per distinct key. The result
    (block, bucket, message) holds for every block these arrays at its own keys, and the sums
    over the buckets of ``totals(stream, keys, arrays)`` if it is given.
    """
    n = buckets or n_buckets(blocks.count())

    def send(number, block, replies):
        streams = emit(block, replies)
        found: dict[int, dict[int, tuple[int, int]]] = {}
        for i, (keys, _) in enumerate(streams):
            of, cut = by_bucket(keys, n)
            for k, a, b in zip(of.tolist(), cut.tolist(), cut[1:].tolist()):
                found.setdefault(k, {})[i] = (a, b)
        yield from rows_of(number, [(k, enc([x[slice(*at.get(i, (0, 0)))] for i, (keys, values) in enumerate(streams) for x in (keys, *values)])) for k, at in sorted(found.items())])

    def reduce(batches):
        for t, bounds in groups(batches, ["bucket"]):
            for lo, hi in zip(bounds, bounds[1:]):
                g = t.slice(lo, hi - lo)
                parts = [dec(m) for m in g.column("message").to_pylist()]
                back: list[list[np.ndarray]] = [[] for _ in parts]
                sums: list[list[int]] = []
                at, stream = 0, 0
                while at < len(parts[0]):
                    width = widths[stream]
                    size = np.array([len(p[at]) for p in parts])
                    keys = np.concatenate([p[at] for p in parts])
                    order = np.argsort(keys, kind="stable")
                    s = keys[order]
                    new = np.concatenate(([True], s[1:] != s[:-1])) if len(s) else np.zeros(0, bool)
                    group = np.empty(len(s), np.int64)
                    group[order] = np.cumsum(new) - 1
                    out = combine(stream, group, [np.concatenate([p[at + 1 + k] for p in parts]) for k in range(width)], size)
                    if totals is not None:
                        sums.append(totals(stream, s[new], out))
                    ends = np.cumsum(size)
                    for k, (e, m) in enumerate(zip(ends, size)):
                        back[k] += [a[group[e - m : e]] for a in out]
                    at, stream = at + 1 + width, stream + 1
                col = [pa.array(x) for x in (g.column("block").to_pylist(), [int(g.column("bucket")[0].as_py())] * len(parts))]
                yield pa.RecordBatch.from_arrays([col[0], col[1], pa.array([enc(x) for x in back], pa.binary()), pa.array([None] * len(parts), pa.string())], ["block", "bucket", "message", "sums"])
                if sums:
                    yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([int(g.column("bucket")[0].as_py())]), pa.array([b""], pa.binary()), pa.array([",".join(str(int(x)) for y in sums for x in y)])], ["block", "bucket", "message", "sums"])

    # how many values each stream has, from an empty block
    widths = [len(values) for _, values in emit(EMPTY, [{} for _ in backs])]
    sent = gather(blocks, list(backs), scratch, send, MESSAGES)
    parts = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    back = sent.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(reduce, "block long, bucket long, message binary, sums string")
    back = scratch.save(back, "routed")
    found: list[int] = []
    if totals is not None:
        figures = F.split("sums", ",").cast("array<long>")
        rows = back.where("sums is not null").select(F.posexplode(figures)).groupBy("pos").agg(F.sum("col").alias("v")).orderBy("pos").collect()
        found = [r.v for r in rows]
    return back.where("sums is null").select("block", "bucket", "message"), found


def answer(messages: DataFrame, scratch: Scratch, reply: Callable[[list[int], list[bytes]], list[bytes]]) -> DataFrame:
    """Answers rows (block, bucket, message): ``reply`` gets the blocks and messages of a bucket."""

    def run(batches):
        for t, bounds in groups(batches, ["bucket"]):
            for lo, hi in zip(bounds, bounds[1:]):
                g = t.slice(lo, hi - lo)
                out = reply(g.column("block").to_pylist(), g.column("message").to_pylist())
                yield pa.RecordBatch.from_arrays([g.column("block").combine_chunks(), g.column("bucket").combine_chunks(), pa.array(out, pa.binary())], ["block", "bucket", "message"])

    n = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    return messages.repartition(n, "bucket").sortWithinPartitions("bucket", "block").mapInArrow(run, MESSAGES)


def gather(blocks: DataFrame, backs: list[DataFrame], scratch: Scratch, run: Callable[[int, Block, list[dict[int, list[np.ndarray]]]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Runs ``run(block id, block, replies)`` on every block; replies are, for each of ``backs``,
    the decoded messages by bucket. Without any, blocks stay where they are."""
    if not backs:

        def alone(batches):
            for b in batches:
                for number, blob in zip(b.column(0).to_pylist(), b.column(1)):
                    yield from run(number, Block(blob.as_py()), [])

        return blocks.select("block", "blob").mapInArrow(alone, schema)
    answers, sources = None, len(backs)
    for k, back in enumerate(backs):
        one = back.select("block", F.lit(k).alias("src"), "bucket", "message")
        answers = one if answers is None else answers.unionAll(one)
    names = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    kinds = to_arrow_schema(names)

    def together(mine: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        if len(mine):
            order = told.sort_by([("src", "ascending"), ("bucket", "ascending")])
            replies: list[dict[int, list[np.ndarray]]] = [{} for _ in range(sources)]
            for src, bucket, message in zip(order.column("src").to_pylist(), order.column("bucket").to_pylist(), order.column("message")):
                replies[src][bucket] = dec(message.as_py())
            out = list(run(mine.column("block")[0].as_py(), Block(mine.column("blob")[0].as_py()), replies))
        return pa.concat_tables([kinds.empty_table(), *(pa.Table.from_batches([b]).cast(kinds) for b in out)])

    return blocks.select("block", "blob").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(together, names)


def whole(reply: dict[int, list[np.ndarray]], kinds: list) -> list[np.ndarray]:
    """A block's arrays in key order, put together from its buckets."""
    found = [reply[k] for k in sorted(reply)]
    return [np.concatenate([f[k] for f in found]) if found else np.zeros(0, kind) for k, kind in enumerate(kinds)]
