"""The SimHash operator for texts of a given similarity: anchor covering, then verification.

Words are as in op5 (A-Z lower-cased, ASCII white space between); a text's set holds the 64-bit
hashes of its SHINGLE-word shingles (of a shorter text, all its words are one shingle). Two
texts are linked if the Jaccard similarity of their sets is at least 4/5.

At that similarity the sets' cosine is at least 8/9, and a SimHash bit differs with a
probability of 0.151: about 10 of 64 bits, so that no search within a few bits finds such
pairs, and one within enough of them meets a fixed share of all texts. So the fingerprint is
wide, BITS bits: the shingles are added with hashed signs in BITS places, and the signs of the
sums' Walsh-Hadamard transform are the bits. It is cut into blocks of CODE and some free bits.
The anchors of a block are the words of the binary Hamming code of length CODE, which covers its
bits with radius 1, with every value of the free bits; the threshold in a block is 0, so a
fingerprint goes to the one anchor within the radius, in every block. Similar texts share the
anchor of a block with a probability that ``layout`` computes; it makes as many blocks as leave
a similarity of exactly 4/5 unmet with a probability of at most MISSED, and as many free bits as
leave an anchor about HOMES texts, so that comparisons don't grow with the square of the table.
More similar pairs are missed by far more rarely; tests measure both.

Texts at one anchor are compared by CHECK bits of the fingerprint, within RADIUS, and the anchor
reports a spanning forest of the near pairs, the nearest first: never more pairs than texts.
These are verified: first by bitmaps, in which every shingle of a set flips one of BITS bits
(similar sets differ in at most a ninth of their sizes' sum, so their bitmaps in no more bits),
then by the whole sets. Texts that the forests connect are a neighbourhood. Where the verified
links leave one in several components, its sets meet in tiles of bounded size, and the task
compares those of different components in the same way and reports a forest of the links. So
near copies by the thousand cost their number in rows, and no pair that is near is left out.

Texts of one set are one class, known by a 64-bit hash of the set. Edge cases: null and empty
texts and texts without words have the empty set and are one class; repeated rows of an id
and class leave one; a null doc_id counts as the smallest; an empty table gives none.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, NULL_ID, Scratch, connected_components, forest, groups, prepare, slices, text_arrays, tiles, word_bounds, word_hashes
from .decontaminate import shingles

SHINGLE = 5
#: Rows of an anchor, and whole sets, that a tile has on a side.
CHUNK, SETS, BITS = 2000, 500, 1024
CODE, HOMES, MISSED = 15, 64, 0.01
CHECK, RADIUS, LEAST = 128, 32, 4
#: The probability that a bit differs between sets at a similarity of exactly 4/5.
DIFFERS = math.acos(8 / 9) / math.pi


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> list[np.ndarray]:
    """The sorted shingle hashes of each text."""
    data, off = text_arrays(texts)
    data = LOWER[data]
    starts, ends, doc = word_bounds(data, off)
    h = word_hashes(data, starts, ends)
    at, s = np.searchsorted(doc, np.arange(len(off))).tolist(), shingles(h, shingle)
    return [np.unique(s[a : b - shingle + 1]) if b - a >= shingle else shingles(h[a:b], b - a) if b > a else s[:0] for a, b in zip(at, at[1:])]


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 5 * both >= 4 * (len(x) + len(y) - both)


def _class(s: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(s.tobytes(), 42) if len(s) else 0


def _with_sets(docs: DataFrame, keep: tuple[str, ...], add: dict, made, shingle: int) -> DataFrame:
    """(*keep, *add) of every row; ``made`` turns a list of sets into the added columns."""
    prepare(docs.sparkSession)
    schema = docs.select(*keep).schema
    for name, kind in add.items():
        schema = schema.add(name, kind)

    def run(batches):
        for b in batches:
            for part in slices(b, "_text"):
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made(shingle_sets(part.column(part.num_columns - 1), shingle))], names=schema.names)

    return docs.select(*keep, F.col("text").cast("string").alias("_text")).mapInArrow(run, schema)


def _classes(sets: list[np.ndarray]) -> pa.Array:
    return pa.array(np.array([_class(s) for s in sets], np.uint64).view(np.int64))


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.uint64), *rows]).view(np.int64)))


def bitmap(s: np.ndarray) -> bytes:
    return np.packbits(np.bincount((s % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1).tobytes()


def _hadamard(n: int) -> np.ndarray:
    h = np.ones((1, 1), np.float32)
    while len(h) < n:
        h = np.block([[h, h], [h, -h]])
    return h


_HALF = _hadamard(math.isqrt(BITS))


def wide_fingerprints(sets: list[np.ndarray]) -> np.ndarray:
    """BITS bits for each set, packed into bytes."""
    out, side = [np.zeros((0, BITS // 8), np.uint8)], len(_HALF)
    for lo in range(0, len(sets), 256):
        part = sets[lo : lo + 256]
        h = np.concatenate([np.zeros(0, np.uint64), *part])
        at = np.repeat(np.arange(len(part)), [len(s) for s in part]) * BITS + (h % np.uint64(BITS)).astype(np.int64)
        v = np.bincount(at, 1.0 - 2.0 * ((h >> np.uint64(40)) & np.uint64(1)).astype(np.float64), len(part) * BITS)
        v = _HALF @ v.astype(np.float32).reshape(len(part), side, side) @ _HALF
        out.append(np.packbits(v.reshape(len(part), BITS) > 0, axis=1))
    return np.concatenate(out)


def meets(free: int, differs: float = DIFFERS) -> float:
    """The probability that a block of CODE and ``free`` bits has the same anchor, if each bit differs
    with the given probability: the difference of two words at most 1 from one anchor is 0, both of
    their own steps, or one of them."""
    n, p, q = CODE, differs, 1 - differs
    same = q**n + n * p * q ** (n - 1) * 2 / (n + 1) + math.comb(n, 2) * p**2 * q ** (n - 2) * 2 / (n + 1)
    return same * q**free


def layout(classes: int, missed: float = MISSED, homes: int = HOMES) -> tuple[int, int]:
    """Blocks, and free bits of a block, for so many different sets."""
    free = max(0, math.ceil(math.log2(max(1, classes / homes))) - (CODE - CODE.bit_length()))
    return math.ceil(math.log(missed) / math.log(1 - meets(free))), free


def anchors(packed: np.ndarray, blocks: int, free: int) -> np.ndarray:
    """The anchor of every fingerprint in each block, with the block's number on top."""
    width, rng = CODE + free, np.random.default_rng(64)
    order = np.concatenate([rng.permutation(BITS) for _ in range(-(-blocks * width // BITS))])[: blocks * width]
    bits = np.unpackbits(packed, axis=1)[:, order].reshape(len(packed), blocks, width).astype(np.int64)
    word = bits @ (1 << np.arange(width))
    # the syndrome is the place of the bit that the nearest word of the code hasn't got
    check = np.arange(1, CODE + 1)[:, None] >> np.arange(CODE.bit_length()) & 1
    syndrome = (bits[:, :, :CODE] @ check & 1) @ (1 << np.arange(CODE.bit_length()))
    word ^= np.where(syndrome > 0, 1 << np.maximum(syndrome - 1, 0), 0)
    return word + (np.arange(blocks) << width)


def check_bits(packed: np.ndarray) -> np.ndarray:
    """CHECK of the bits, from places all over the transform, as 64-bit words."""
    order = np.random.default_rng(128).permutation(BITS)[:CHECK]
    return np.ascontiguousarray(np.packbits(np.unpackbits(packed, axis=1)[:, order], axis=1)).view(np.uint64)


def at_anchors(classes: DataFrame, blocks: int, free: int) -> DataFrame:
    """(key, cls, f1, f2) for every class and block; f1 and f2 are the CHECK bits."""

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                part = b.slice(lo, 200)
                packed = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint8).reshape(part.num_rows, BITS // 8)
                check = check_bits(packed).view(np.int64)
                cls = part.column(0).to_numpy()
                cols = [anchors(packed, blocks, free).reshape(-1), *(np.repeat(x, blocks) for x in (cls, check[:, 0], check[:, 1]))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["key", "cls", "f1", "f2"])

    return classes.select("cls", "wide").mapInArrow(run, "key long, cls long, f1 long, f2 long")


def near_forest(dealt: DataFrame) -> DataFrame:
    """Pairs (a, b) within RADIUS at each anchor, a spanning forest of them, the nearest first."""

    def run(batches):
        for t, bounds in groups(batches, ["key", "_tile"]):
            cls, home, visitor = (t.column(k).to_numpy() for k in ("cls", "home", "visitor"))
            f1, f2 = (t.column(k).to_numpy().view(np.uint64) for k in ("f1", "f2"))
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for lo, hi in zip(bounds.tolist(), bounds[1:].tolist()):
                if hi - lo < 2:
                    continue
                mine, other = lo + np.flatnonzero(home[lo:hi]), lo + np.flatnonzero(visitor[lo:hi])
                step, label = max(1, 1_000_000 // max(1, len(other))), np.arange(hi - lo)
                for k in range(0, len(mine), step):
                    x, y = mine[k : k + step, None], other[None, :]
                    apart = np.bitwise_count(f1[x] ^ f1[y]) + np.bitwise_count(f2[x] ^ f2[y])
                    i, j = np.nonzero((apart <= RADIUS) & (cls[x] < cls[y]))
                    apart = apart[i, j]
                    i, j = mine[k + i] - lo, other[j] - lo
                    for d in np.unique(apart):
                        fi, fj, label = forest(hi - lo, i[apart == d], j[apart == d], label)
                        a.append(cls[lo + fi])
                        b.append(cls[lo + fj])
            a, b = np.concatenate(a), np.concatenate(b)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def linked_in_tiles(dealt: DataFrame) -> DataFrame:
    """A forest of the links (a, b) between the sets of each neighbourhood that are of different components ``c``."""

    def run(batches):
        for t, bounds in groups(batches, ["g", "_tile"]):
            for lo, hi in zip(bounds.tolist(), bounds[1:].tolist()):
                part = t.slice(lo, hi - lo)
                cls, c, home, visitor = (part.column(k).to_numpy() for k in ("cls", "c", "home", "visitor"))
                sets = [np.frombuffer(v, np.uint64) for v in part.column("s").to_pylist()]
                size, label = np.array([len(v) for v in sets]), np.unique(c, return_inverse=True)[1]
                bits = np.frombuffer(b"".join(map(bitmap, sets)), np.uint64).reshape(len(sets), -1)
                mine, other = np.flatnonzero(home), np.flatnonzero(visitor)
                step, found = max(1, 100_000 // max(1, len(other))), []
                for k in range(0, len(mine), step):
                    x, y = mine[k : k + step], other
                    i, j = np.nonzero((label[x][:, None] != label[y][None, :]) & (cls[x][:, None] != cls[y][None, :]) & (5 * np.minimum(size[x][:, None], size[y][None, :]) >= 4 * np.maximum(size[x][:, None], size[y][None, :])))
                    i, j = x[i], y[j]
                    apart = np.zeros(len(i), np.int64)
                    for w in range(bits.shape[1]):
                        apart += np.bitwise_count(bits[i, w] ^ bits[j, w])
                    near = np.flatnonzero(9 * apart <= size[i] + size[j])
                    for n in near[np.argsort(apart[near], kind="stable")].tolist():
                        u, v = int(i[n]), int(j[n])
                        if label[u] != label[v] and similar(sets[u], sets[v]):
                            label[label == label[u]] = label[v]
                            found.append((int(cls[u]), int(cls[v])))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def sets_of(wanted: DataFrame, classes: DataFrame, docs: DataFrame, scratch: Scratch, shingle: int) -> DataFrame:
    """(cls, s) of the classes (w): their whole sets, from one text of each."""
    lows = scratch.save(classes.join(wanted, F.col("cls") == F.col("w"), "left_semi").select(F.col("low").alias("l")).distinct(), "lows")
    texts = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("_id"), "text").join(lows, F.col("_id") == F.col("l"), "left_semi")
    sets = _with_sets(texts, (), {"cls": "long", "s": "binary"}, lambda sets: [_classes(sets), pa.array([s.tobytes() for s in sets], pa.binary())], shingle)
    return scratch.save(sets.join(wanted, F.col("cls") == F.col("w"), "left_semi").dropDuplicates(["cls"]), "sets")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, scratch: Scratch, shingle: int = SHINGLE) -> DataFrame:
    """Of pairs (a, b) of classes, those whose sets are similar."""
    side = lambda x: classes.select(F.col("cls").alias(f"c{x}"), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"s{x}"))
    near = pairs.join(side("a"), F.col("a") == F.col("ca")).join(side("b"), F.col("b") == F.col("cb")).select("a", "b", "na", "nb", "sa", "sb")

    def sift(batches):
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint64).reshape(b.num_rows, -1) for k in (4, 5))
            size = b.column(2).to_numpy() + b.column(3).to_numpy()
            yield b.select(["a", "b"]).filter(pa.array(9 * np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) <= size))

    pairs = scratch.save(near.mapInArrow(sift, "a long, b long"), "sifted")
    wanted = scratch.save(pairs.select(F.col("a").alias("w")).unionAll(pairs.select(F.col("b").alias("w"))).distinct(), "wanted")
    sets = sets_of(wanted, classes, docs, scratch, shingle)
    rows = pairs.join(sets.select(F.col("cls").alias("ca"), F.col("s").alias("sa")), F.col("a") == F.col("ca")).join(sets.select(F.col("cls").alias("cb"), F.col("s").alias("sb")), F.col("b") == F.col("cb"))

    def run(batches):
        for b in batches:
            sets = zip(b.column(2).to_pylist(), b.column(3).to_pylist())
            yield b.select(["a", "b"]).filter(pa.array([similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in sets], pa.bool_()))

    links = scratch.save(rows.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long"), "links")
    scratch.drop(sets, wanted, pairs)
    return links


def components(docs: DataFrame, scratch: Scratch, shingle: int = SHINGLE, chunk: int = CHUNK, missed: float = MISSED) -> DataFrame:
    """(cls, low, c): each class's smallest doc_id, a null one as NULL_ID, and component."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = lambda sets: [_classes(sets), pa.array([len(s) for s in sets], pa.int64()), pa.array([bitmap(s) for s in sets], pa.binary()), pa.array([w.tobytes() for w in wide_fingerprints(sets)], pa.binary())]
    ids = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), "text")
    rows = scratch.save(_with_sets(ids, ("doc_id",), {"cls": "long", "n": "long", "bits": "binary", "wide": "binary"}, made, shingle), "fingerprints")
    classes = scratch.save(rows.groupBy("cls").agg(F.min("doc_id").alias("low"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("wide").alias("wide")), "classes")
    scratch.drop(rows)
    blocks, free = layout(classes.count(), missed)
    # a set of under LEAST shingles is similar to itself only
    spread = at_anchors(classes.where(F.col("n") >= LEAST), blocks, free).withColumn("home", F.lit(True))
    near = scratch.save(near_forest(tiles(scratch, spread, ["key"], "cls", chunk)).distinct(), "near")
    links = verified(near, classes, docs, scratch, shingle)
    around = connected_components(scratch, near).select(F.col("id").alias("cls"), F.col("component").alias("g"))
    around = around.join(connected_components(scratch, links), F.col("cls") == F.col("id"), "left").select("cls", "g", F.coalesce("component", "cls").alias("c"))
    around = scratch.save(around, "around")
    mixed = around.groupBy(F.col("g").alias("mixed")).agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("mixed")
    rest = scratch.save(around.join(mixed, F.col("g") == F.col("mixed"), "left_semi"), "rest")
    if rest.limit(1).count():
        sets = sets_of(rest.select(F.col("cls").alias("w")), classes, docs, scratch, shingle)
        met = rest.join(sets.select(F.col("cls").alias("of"), "s"), F.col("cls") == F.col("of")).select("g", "cls", "c", "s", F.lit(True).alias("home"))
        links = links.unionAll(scratch.save(linked_in_tiles(tiles(scratch, met, ["g"], "cls", min(chunk, SETS))), "more"))
    comp = connected_components(scratch, links)
    of = classes.join(comp, F.col("cls") == F.col("id"), "left").select("cls", "low", F.coalesce("component", "cls").alias("c"))
    return scratch.save(of, "members")


def one_of_each(docs: DataFrame, scratch: Scratch, shingle: int = SHINGLE, chunk: int = CHUNK, missed: float = MISSED) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component, the smallest doc_id.

    Of rows that repeat an id with the same set, one stays; so does one of each set that a
    smallest id repeated over different sets has.
    """
    of = components(docs, scratch, shingle, chunk, missed)
    least = scratch.save(of.groupBy("c").agg(F.min("low").alias("least")).withColumnRenamed("c", "c2"), "least")
    kept = of.join(least, (F.col("c") == F.col("c2")) & (F.col("low") == F.col("least"))).select(F.col("low").alias("k"), F.col("cls").alias("f"))
    kept = scratch.save(kept, "kept")
    whole = docs.select(F.struct(*docs.columns).alias("_row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("_id"), "text")
    whole = _with_sets(whole, ("_row", "_id"), {"cls": "long"}, lambda sets: [_classes(sets)], shingle)
    whole = whole.join(kept, (F.col("_id") == F.col("k")) & (F.col("cls") == F.col("f")), "left_semi").dropDuplicates(["_id", "cls"])
    return whole.select("_row.*")
