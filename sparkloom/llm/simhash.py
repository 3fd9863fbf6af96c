"""SimHash near-duplicates by anchor-point covering.

Fingerprint: A-Z lower-cased, words between ASCII white space, 3-word shingles (repeats
included) hashed with XXH64 (seed 42); a bit is 1 if set in over half of the hashes.

Search: two fingerprints that differ in at most DISTANCE = 3 of 64 bits differ in at most 1
bit of one 32-bit half. The anchors of a half are the words of a covering code: the binary
Hamming code of length 31, which covers its bits with radius 1, and the code of all words for
the bit beside it, 2^27 anchors in all. Each fingerprint has a home, its nearest anchor, and
is replicated to every anchor within radius + 1 of it: the home and 16 others. A partner's
home is always among them, so homes are compared with replicas per anchor, by the whole 64
bits, and no link is lost. For distances up to 5 or 7 the fingerprint has three or four
parts, with the code of length 15: 2^17 or 2^12 anchors, and so more comparisons.

Only distinct fingerprints are compared; an anchor with over CHUNK homes or replicas is dealt
over tiles of that many. Per tile, Python links homes to the replicas within 3 bits but
reports only a spanning forest of these links, so that dense groups don't grow with their
square. Components are found by distributed star
contraction.

Edge cases: null and empty texts and texts without words have fingerprint zero, which
links like any other; repeated rows each give a row; a null doc_id counts as the smallest
(component_id is then null); extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, Scratch, connected_components, forest, groups, prepare, real_id, table, text_arrays, tiles

SHINGLE, SEED, DISTANCE = 3, 42, 3
CHUNK = 2000


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of one text given as UTF-8."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
    ends = (ends - 1)[shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(starts))
    if len(h) < 2000:
        ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        octets = h.view(np.uint8).reshape(-1, 8)
        ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(*keep, fp) for every row: fp is the fingerprint as a signed 64-bit number."""
    prepare(docs.sparkSession)
    schema = docs.select(*keep).schema.add("fp", "long")

    def run(batches):
        for b in batches:
            data, off = text_arrays(b.column(b.num_columns - 1))
            raw, cuts = data.tobytes(), off.tolist()
            fp = np.fromiter((fingerprint(raw[x:y], shingle) for x, y in zip(cuts, cuts[1:])), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp.view(np.int64))], names=schema.names)

    return docs.select(*keep, F.col("text").cast("string").alias("_text")).mapInArrow(run, schema)


def _checks(n: int) -> list[int]:
    """Bits of an n-bit word whose position (1 to n) has bit k set: the checks of the Hamming code."""
    return [sum(1 << (p - 1) for p in range(1, n + 1) if p >> k & 1) for k in range(n.bit_length())]


def layout(distance: int) -> list[tuple[int, int, int]]:
    """(first bit, bits, bits of the Hamming code) of each part of the fingerprint."""
    if not 0 <= distance <= 7:
        raise ValueError("distances from 0 to 7")
    parts = max(2, distance // 2 + 1)  # one part differs by distance div parts = 1 bit at most
    cuts = [64 * k // parts for k in range(parts + 1)]
    return [(a, b - a, 31 if b - a > 31 else 15) for a, b in zip(cuts, cuts[1:])]


def anchors(fp: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Homes and replicas: (fp, part, anchor, home)."""
    out = None
    for part, (first, bits, n) in enumerate(layout(distance)):
        at = fp.select("fp", F.expr(f"shiftrightunsigned(fp, {first}) & {(1 << bits) - 1}L").alias("x"))
        check = lambda k, mask: F.shiftleft(F.bit_count(F.col("x").bitwiseAND(F.lit(mask))) % 2, k)
        at = at.withColumn("s", sum((check(k, m) for k, m in enumerate(_checks(n))), F.lit(0)).cast("int"))
        bit = lambda p: f"if(({p}) = 0, 0L, shiftleft(1L, ({p}) - 1))"
        at = at.withColumn("h", F.expr(f"x ^ {bit('s')}"))
        near = F.expr(f"if(s = 0, array(), transform(filter(sequence(1, {n}), p -> p < (p ^ s) and p != s), p -> x ^ {bit('p')} ^ {bit('p ^ s')}))")
        beside = F.array(*(F.expr(f"h ^ {1 << k}L") for k in range(n, bits)))
        at = at.select("fp", F.lit(part).alias("part"), F.explode(F.concat(F.array("h"), near, beside)).alias("anchor"), "h").select("fp", "part", "anchor", (F.col("anchor") == F.col("h")).alias("home"))
        out = at if out is None else out.unionAll(at)
    return out


def links(fp: DataFrame, scratch: Scratch, distance: int = DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough for the components of all links."""
    at = tiles(scratch, anchors(fp, distance), ["part", "anchor"], "fp", chunk)

    def run(batches):
        for t, bounds in groups(batches, ["part", "anchor", "_tile"]):
            x, home = t.column("fp").to_numpy().view(np.uint64), t.column("home").to_numpy()
            size = np.diff(bounds)
            two = bounds[np.flatnonzero(size == 2)]  # by far the most frequent of those that can link
            near = (home[two] | home[two + 1]) & (np.bitwise_count(x[two] ^ x[two + 1]) <= distance)
            found = [(x[two[near]], x[two[near] + 1])]
            for k in np.flatnonzero(size > 2):
                y = x[bounds[k] : bounds[k + 1]]
                at_home, label = np.flatnonzero(home[bounds[k] : bounds[k + 1]]), np.arange(len(y))
                step = max(1, 2_000_000 // len(y))
                for i in range(0, len(at_home), step):
                    rows = at_home[i : i + step]
                    a, b = np.nonzero(np.bitwise_count(y[rows][:, None] ^ y[None, :]) <= distance)
                    a, b, label = forest(len(y), rows[a], b, label)
                    found.append((y[a], y[b]))
            a, b = (np.concatenate([f[k] for f in found]).view(np.int64) for k in (0, 1))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return at.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, scratch: Scratch, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable by links."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fps = scratch.save(fingerprints(docs, shingle), "fingerprints")
    distinct = scratch.save(fps.groupBy("fp").agg(F.min(F.coalesce("doc_id", F.lit(NULL_ID))).alias("low"), F.count("*").alias("n")), "distinct")
    comp = connected_components(scratch, links(distinct.select("fp"), scratch, distance))
    of = distinct.join(comp, F.col("fp") == F.col("id"), "left").select("fp", "low", F.coalesce("component", "fp").alias("c"))
    of = scratch.save(of, "members")
    least = scratch.save(of.groupBy("c").agg(F.min("low").alias("component_id")).withColumnRenamed("c", "c2"), "least")
    of = scratch.save(of.join(least, F.col("c") == F.col("c2")).select(F.col("fp").alias("f"), "component_id"), "classes")
    return fps.join(of, F.col("fp") == F.col("f")).select("doc_id", "fp", real_id("component_id").alias("component_id"))


def one_of_each(docs: DataFrame, scratch: Scratch, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component, the smallest doc_id.

    Of rows that repeat an id with the same fingerprint, one stays.
    """
    found = near_duplicates(docs, scratch, shingle, distance)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("k"), F.col("fp").alias("f")).distinct()
    kept = scratch.save(kept, "kept")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("_id"), "text")
    rows = fingerprints(rows, shingle, ("_row", "_id"))
    rows = rows.join(kept, (F.col("_id") == F.col("k")) & (F.col("fp") == F.col("f")), "left_semi").dropDuplicates(["_id", "fp"])
    return rows.select("_row.*")


def op5_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark, "op5"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
