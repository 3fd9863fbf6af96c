"""Embedding near-duplicates by lattice hashing.

In each of TABLES tables, a unit vector is projected on eight random orthonormal directions,
scaled by SCALE times the root of its length and decoded to its nearest point of the E8
lattice: its home cell. A projection of a random unit vector shrinks with that root, so cells
are equally fine at any length. It also visits the PROBES - 1 lattice points next to it. A
pair is met where one's home is among the cells that the other visits; then its cosine is
computed exactly in double precision. With the defaults a pair at cosine 0.98 is met with a
probability over 0.999, and two random vectors with one of about 0.001 (tests measure both at
64, 384 and 768 components); a larger SCALE with more tables makes smaller cells.

Equal vectors with equal labels are one class before the search (classes are found by 128
bits of hash of the vector and by the label), so copies cost nothing. Classes have numbers of
their own: vec_id plays no part in the search, so it may repeat or be null. A cell with over
CHUNK homes or visitors is dealt over tiles. A pair is counted only at the first place at
which it is met, so that n_links needs no list of pairs, and only a spanning forest of a
tile's links is reported.

Edge cases: a null label, or a null, empty or zero vector, or one with a null or non-finite
component, links with nothing; vectors of different length don't link; rows that repeat a
vec_id are separate vectors, whatever their vectors; a null vec_id counts as the smallest; an
empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import NULL_ID, Scratch, connected_components, forest, groups, mix64, real_id, table, tiles

COSINE = 0.98
TABLES, PROBES, SCALE, SEED = 3, 8, 1.0, 7
CHUNK = 1000


def _shortest() -> np.ndarray:
    """The 240 shortest non-zero points of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


SHORTEST = _shortest()


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    f = np.round(x)
    odd = np.flatnonzero(f.sum(axis=1).astype(np.int64) & 1)
    gap = x[odd] - f[odd]
    k = np.abs(gap).argmax(axis=1)
    f[odd, k] += np.where(gap[np.arange(len(odd)), k] >= 0, 1, -1)
    return f


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row: E8 is D8 and D8 shifted by one half."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


def _cell_id(points: np.ndarray, salt: int) -> np.ndarray:
    h = np.full(points.shape[:-1], salt, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(8):
            h = mix64(h * np.uint64(31) + (2 * points[..., k]).astype(np.int64).view(np.uint64))
    return h


def cells(unit: np.ndarray, n_tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, seed: int = SEED) -> np.ndarray:
    """Cell ids of each row, tables by probes; the first of a table's probes is the home."""
    n, dim = unit.shape
    out = np.empty((n, n_tables, probes), np.uint64)
    rng = np.random.default_rng([seed, dim])
    for t in range(n_tables):
        basis = np.linalg.qr(rng.normal(size=(max(dim, 8), 8)))[0][:dim]
        p = scale * np.sqrt(dim) * (unit @ basis)
        home = nearest_e8(p)
        near = np.argsort((home - p) @ SHORTEST.T, axis=1, kind="stable")[:, : probes - 1]
        out[:, t] = _cell_id(np.concatenate((home[:, None], home[:, None] + SHORTEST[near]), axis=1), t + 1)
    return out


def unit_rows(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def near_vectors(rows: DataFrame, scratch: Scratch, cosine: float = COSINE, n_tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, chunk: int = CHUNK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding, label)."""
    kind = rows.schema["embedding"].dataType.elementType
    width = np.float32 if isinstance(kind, T.FloatType) else np.float64
    e = F.col("embedding") if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col("embedding").cast("array<double>")
    valid = F.coalesce(F.col("label").isNotNull() & F.forall(e, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) != float("inf")), F.lit(False))) & F.exists(e, lambda v: v != 0), F.lit(False))
    base = rows.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NULL_ID)).alias("vec_id"), F.col("label").alias("label"), e.alias("embedding"), valid.alias("valid"))
    base = base.withColumn("h1", F.xxhash64(F.lit(1), "embedding")).withColumn("h2", F.xxhash64(F.lit(2), "embedding"))
    classes = base.where("valid").groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"), F.any_value("embedding").alias("embedding"))
    classes = scratch.save(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    numbered = T.StructType([T.StructField("label", classes.schema["label"].dataType)])

    def visit(batches):
        for b in batches:
            col = b.column(2)
            dims = np.diff(np.asarray(col.offsets))
            flat = col.flatten().to_numpy(zero_copy_only=False)
            starts = np.asarray(col.offsets)[:-1] - np.asarray(col.offsets)[0]
            for dim in np.unique(dims):
                for at in np.array_split(np.flatnonzero(dims == dim), max(1, (dims == dim).sum() // 500)):
                    raw = flat[starts[at][:, None] + np.arange(dim)].astype(width)
                    sig = cells(unit_rows(raw), n_tables, probes, scale)
                    n, take = len(at), np.repeat(at, n_tables * probes)
                    pick = pa.array(take)
                    sent = pa.array([v.tobytes() for v in raw], pa.binary()).take(pa.array(np.repeat(np.arange(n), n_tables * probes)))
                    sigs = pa.array([v.tobytes() for v in sig], pa.binary()).take(pa.array(np.repeat(np.arange(n), n_tables * probes)))
                    tab = np.tile(np.repeat(np.arange(n_tables, dtype=np.int32), probes), n)
                    home = np.tile(np.arange(probes) == 0, n * n_tables)
                    yield pa.RecordBatch.from_arrays([b.column(3).take(pick), pa.array(np.full(len(take), dim, np.int32)), pa.array(tab), pa.array(sig.reshape(-1).view(np.int64)), pa.array(home), b.column(0).take(pick), b.column(1).take(pick), sent, sigs], ["label", "dim", "tab", "cell", "home", "cls", "copies", "v", "sig"])

    for name, of in (("dim", "integer"), ("tab", "integer"), ("cell", "long"), ("home", "boolean"), ("cls", "long"), ("copies", "long"), ("v", "binary"), ("sig", "binary")):
        numbered = numbered.add(name, of)
    met = classes.select("cls", "copies", "embedding", "label").mapInArrow(visit, numbered)
    keys = ["label", "dim", "tab", "cell"]
    met = tiles(scratch, met, keys, "cls", chunk)

    def compare(batches):
        for t, bounds in groups(batches, [*keys, "_tile"]):
            for lo, hi in zip(bounds, bounds[1:]):
                if hi - lo < 2:
                    continue
                g = t.slice(lo, hi - lo)
                home, visitor = np.flatnonzero(g.column("home").to_numpy()), np.flatnonzero(g.column("visitor").to_numpy())
                if not len(home) or not len(visitor):
                    continue
                unit = unit_rows(np.frombuffer(b"".join(g.column("v").to_pylist()), width).reshape(len(g), -1))
                sig = np.frombuffer(b"".join(g.column("sig").to_pylist()), np.uint64).reshape(len(g), n_tables, probes)
                cls, copies, tab = g.column("cls").to_numpy(), g.column("copies").to_numpy(), int(g.column("tab")[0].as_py())
                count, label, ea, eb = np.zeros(len(g), np.int64), np.arange(len(g)), [], []
                for i in range(0, len(home), 500):
                    a, b = np.nonzero(unit[home[i : i + 500]] @ unit[visitor].T >= cosine - 1e-9)
                    a, b = home[i + a], visitor[b]
                    near = cls[a] != cls[b]
                    a, b = a[near], b[near]
                    exact = np.einsum("ij,ij->i", unit[a], unit[b]) >= cosine
                    a, b = a[exact], b[exact]
                    first = np.ones(len(a), bool)  # is this the first place at which the two meet?
                    for s in range(tab):
                        first &= ~((sig[a, s, :1] == sig[b, s]).any(axis=1) | (sig[b, s, :1] == sig[a, s]).any(axis=1))
                    first &= (cls[a] < cls[b]) | ~(sig[b, tab, :1] == sig[a, tab]).any(axis=1)
                    a, b = a[first], b[first]
                    np.add.at(count, a, copies[b])
                    np.add.at(count, b, copies[a])
                    fa, fb, label = forest(len(g), a, b, label)
                    ea.append(fa)
                    eb.append(fb)
                linked = np.flatnonzero(count)
                if len(linked):
                    fa, fb = np.concatenate(ea), np.concatenate(eb)
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((cls[linked], cls[fa]))), pa.array([None] * len(linked) + cls[fb].tolist(), pa.int64()), pa.array(np.concatenate((count[linked], np.zeros(len(fa), np.int64))))], ["a", "b", "n"])

    found = scratch.save(met.mapInArrow(compare, "a long, b long, n long"), "found")
    comp = connected_components(scratch, found.where("b is not null").select("a", "b"))
    counts = found.where("b is null").groupBy(F.col("a").alias("id2")).agg(F.sum("n").alias("n"))
    members = scratch.save(classes.select("label", "h1", "h2", "cls", "low", "copies").join(comp, F.col("cls") == F.col("id"), "left").join(counts, F.col("cls") == F.col("id2"), "left").withColumn("c", F.coalesce("component", "cls")), "members")
    least = members.groupBy(F.col("c").alias("c2")).agg(F.min("low").alias("component_id"))
    done = members.join(least, F.col("c") == F.col("c2")).select(F.col("label").alias("of"), F.col("h1").alias("g1"), F.col("h2").alias("g2"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    done = scratch.save(done, "done")
    scratch.drop(classes, found, members)
    whole = F.col("valid")
    out = base.select("vec_id", F.when(whole, F.col("label")).alias("label"), F.when(whole, F.col("h1")).alias("h1"), F.when(whole, F.col("h2")).alias("h2"))
    out = out.join(done, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")) & (F.col("label") == F.col("of")), "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.select(real_id("vec_id").alias("vec_id"), "n_links", real_id("component_id").alias("component_id"), (F.col("vec_id") == F.col("component_id")).alias("kept"))


def op3_lattice_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), Scratch(spark, "op3"))


#: Brute force: the same rows, for tables whose vectors have one length.
ORACLE = """
with recursive v as (
  select vec_id, label, embedding::double[] as e, row_number() over () as r from embeddings),
p as (select a.vec_id as x, b.vec_id as y from v a join v b on a.label = b.label and a.r <> b.r
      where list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= 0.98),
reach(x, y) as (select x, y from p union select reach.x, p.y from reach join p on reach.y = p.x)
select vec_id, (select count(*) from p where p.x = vec_id) as n_links,
  least(vec_id, (select min(y) from reach where reach.x = vec_id)) as component_id,
  vec_id = least(vec_id, coalesce((select min(y) from reach where reach.x = vec_id), vec_id)) as kept
from embeddings
"""
