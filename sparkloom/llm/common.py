"""Shared plumbing of the llm operators: scratch tables, Arrow/numpy text helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows an Arrow batch holds at most; texts average a few KB, so a batch stays near 5 MB.
ARROW_ROWS = 1000
#: Bytes of text that numpy code handles at once; 64-bit temporaries take eight times as much.
SLICE_BYTES = 2 << 20

#: ASCII white space as the contracts define it: \x20 and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Session settings that the operators rely on; safe to call repeatedly."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    made = tempfile.mkdtemp(prefix="sparkloom-")
    spark.conf.set("spark.checkpoint.dir", f"file://{made}")
    return f"file://{made}"


class Scratch:
    """Tables of one operator run in the shared folder. Writing one cuts the lineage.

    Results read them, so they stay until ``scope`` ends, or else until the driver does.
    """

    def __init__(self, spark: SparkSession, name: str):
        prepare(spark)
        self.spark, self.root, self.n = spark, f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}", 0
        self.paths: dict[int, tuple[DataFrame, str]] = {}
        _ROOTS.append(self)

    def _path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def _folder(self, path: str):
        found = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), found

    def _written(self, df: DataFrame, path: str) -> DataFrame:
        if self.n == 1:
            files, root = self._folder(self.root)
            files.deleteOnExit(root)
        self.paths[id(df)] = (df, path)
        return df

    def save(self, df: DataFrame, name: str = "t") -> DataFrame:
        path = self._path(name)
        df.write.parquet(path)
        return self._written(self.spark.read.schema(df.schema).parquet(path), path)

    def save_by(self, df: DataFrame, key: str, name: str = "t") -> DataFrame:
        """A table in buckets of ``key``: grouping it by that key moves nothing."""
        path, n = self._path(name), int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        table = f"sparkloom_{name}_{uuid.uuid4().hex[:12]}"
        df.write.format("parquet").option("path", path).bucketBy(n, key).saveAsTable(table)
        return self._written(self.spark.table(table), path)

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that nothing will read again."""
        for df in tables:
            files, path = self._folder(self.paths.pop(id(df))[1])
            files.delete(path, True)

    def close(self) -> None:
        """Deletes all tables."""
        files, root = self._folder(self.root)
        files.delete(root, True)
        self.paths.clear()


_ROOTS: list[Scratch] = []


@contextmanager
def scope() -> Iterator[None]:
    """Deletes, at its end, what operators called in it wrote; their results must be stored by then."""
    before = len(_ROOTS)
    try:
        yield
    finally:
        for made in _ROOTS[before:]:
            made.close()
        del _ROOTS[before:]


def text_arrays(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n+1 offsets into them; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    offsets = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that no piece but a single long row has over ``limit`` bytes of text."""
    if batch.num_rows == 0:
        return
    _, off = text_arrays(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Maps A-Z to a-z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document number of every word; words never cross documents."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~_SPACE[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    cut = off[1:-1]
    cut = cut[cut < n]
    before[cut] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cut[cut > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


_MUL = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        m = 1 << max(10, (n - 1).bit_length())
        with np.errstate(over="ignore"):
            steps = np.full(m, _MUL)
            steps[0] = 1
            _POWERS = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over its bytes, mixed with its length."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    size = ends - starts
    pos = np.arange(len(data)) - np.repeat(np.concatenate((starts, [len(data)])), np.diff(np.concatenate(([0], starts[1:], [len(data)], [len(data)]))))
    np.maximum(pos, 0, out=pos)
    with np.errstate(over="ignore"):
        term = (data.astype(np.uint64) + np.uint64(1)) * _powers(int(size.max()) + 1)[np.minimum(pos, size.max())]
        term[_SPACE[data]] = 0
        return mix64(np.add.reduceat(term, starts) + size.astype(np.uint64) * _MUL)


def ids(col: pa.Array) -> np.ndarray:
    """An integer id column; a null id counts as the smallest possible one."""
    return col.cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False)


#: Stands for a null doc_id inside operators, so that a null id is the smallest.
NULL_ID = -(1 << 63)


def real_id(c: str) -> Column:
    """Turns the stand-in of a null id back into null."""
    return F.when(F.col(c) != F.lit(NULL_ID), F.col(c))


def connected_components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """Smallest id reachable from each id, by alternating large-star and small-star steps.

    ``edges`` has two columns a, b of one type. Returns (id, component) for ids that
    occur in an edge between two different ids. Each round's edges are a written table;
    joins are on plain columns of written tables, so that adaptive execution can split hubs.
    Rounds go on until the edges stay as they are; they grow with the logarithm of the ids.
    """
    e = scratch.save(edges.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        old = e
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = scratch.save(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m")), "low")
        large = both.where("b > a").join(low, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = scratch.save(large, "large")
        least = scratch.save(large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m"), "least")
        small = large.join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionAll(least.select(F.col("k").alias("a"), F.col("m").alias("b"))).distinct()
        e = scratch.save(small, "edges")
        scratch.drop(old, low, large, least)
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def tiles(scratch: Scratch, rows: DataFrame, keys: list[str], by: str, chunk: int) -> DataFrame:
    """Deals the rows of each key over tiles of at most about ``chunk`` homes by ``chunk`` visitors.

    Rows have a boolean ``home``; every row is a visitor, and homes meet all visitors of
    their key. Returns the rows sorted by key and tile within partitions, with ``_tile``,
    ``home`` and ``visitor``: in exactly one tile a given home and visitor stand together.
    Keys of one tile, by far the most, aren't multiplied.
    """
    rows = scratch.save(rows, "dealt")
    n = rows.groupBy(*keys).agg(F.count_if("home").alias("_h"), F.count("*").alias("_v")).where((F.col("_h") > 0) & (F.greatest("_h", "_v") > chunk))
    n = scratch.save(n.select(*(F.col(k).alias(f"_{k}") for k in keys), F.ceil(F.col("_h") / chunk).cast("int").alias("_nh"), F.ceil(F.col("_v") / chunk).cast("int").alias("_nv")), "hot")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    rows = rows.join(n, same[0] if len(same) == 1 else F.expr(" and ".join(f"{k} <=> _{k}" for k in keys)), "left").drop(*(f"_{k}" for k in keys))
    rows = rows.withColumn("_nh", F.coalesce("_nh", F.lit(1))).withColumn("_nv", F.coalesce("_nv", F.lit(1)))
    rows = rows.withColumn("_hi", F.pmod(F.xxhash64(by), F.col("_nh")).cast("int")).withColumn("_vj", F.pmod(F.xxhash64(by), F.col("_nv")).cast("int"))
    visit = F.transform(F.sequence(F.lit(0), F.col("_nh") - 1), lambda i: F.struct((i * F.col("_nv") + F.col("_vj")).alias("t"), (F.col("home") & (i == F.col("_hi"))).alias("h"), F.lit(True).alias("v")))
    house = F.transform(F.filter(F.sequence(F.lit(0), F.col("_nv") - 1), lambda j: F.col("home") & (j != F.col("_vj"))), lambda j: F.struct((F.col("_hi") * F.col("_nv") + j).alias("t"), F.lit(True).alias("h"), F.lit(False).alias("v")))
    rows = rows.withColumn("_at", F.explode(F.concat(visit, house)))
    rest = [c for c in rows.columns if c not in ("home", "_nh", "_nv", "_hi", "_vj", "_at")]
    rows = rows.select(*rest, F.col("_at.t").alias("_tile"), F.col("_at.h").alias("home"), F.col("_at.v").alias("visitor"))
    return rows.repartition(int(scratch.spark.conf.get("spark.sql.shuffle.partitions")), *keys, "_tile").sortWithinPartitions(*keys, "_tile")


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """From batches sorted by ``keys``: tables of whole groups, with the groups' bounds."""
    rest: list[pa.RecordBatch] = []
    for b in batches:
        if b.num_rows == 0:
            continue
        cols = [b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
        same = bool(rest) and all(rest[-1].column(rest[-1].schema.get_field_index(k))[-1] == b.column(b.schema.get_field_index(k))[0] for k in keys)
        first = int(new[0]) if len(new) else b.num_rows
        if rest and same:
            rest.append(b.slice(0, first))
            if len(new):
                t = pa.Table.from_batches(rest)
                yield t, np.array([0, t.num_rows])
                rest = []
        elif rest:
            t = pa.Table.from_batches(rest)
            yield t, np.array([0, t.num_rows])
            rest = []
        at = first if same else 0
        if len(new):
            if new[-1] > at:
                inner = np.concatenate(([at], new[new > at])) - at
                yield pa.Table.from_batches([b.slice(at, int(new[-1]) - at)]), inner
            rest = [b.slice(int(new[-1]))]
        elif not same:
            rest = [b]
    if rest:
        t = pa.Table.from_batches(rest)
        yield t, np.array([0, t.num_rows])


def forest(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of links between places 0..n-1, those that join trees; and the labels afterwards."""
    outa, outb = [], []
    while len(a):
        la, lb = label[a], label[b]
        keep = la != lb
        if not keep.any():
            break
        a, b, la, lb = a[keep], b[keep], la[keep], lb[keep]
        hi, lo = np.maximum(la, lb), np.minimum(la, lb)
        order = np.lexsort((lo, hi))
        first = order[np.concatenate(([True], hi[order][1:] != hi[order][:-1]))]
        outa.append(a[first])
        outb.append(b[first])
        parent = np.arange(n)
        parent[hi[first]] = lo[first]
        while not np.array_equal(up := parent[parent], parent):
            parent = up
        label = parent[label]
    z = np.zeros(0, np.int64)
    return (np.concatenate(outa) if outa else z), (np.concatenate(outb) if outb else z), label
