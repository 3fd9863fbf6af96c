"""Near-duplicate and substring operators against brute force."""

import hashlib
import itertools
import math

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sparkloom.llm import exchange, lattice, passages, simhash, suffix_array, suffix_tree
from sparkloom.llm.common import Scratch, connected_components

from .fixtures import SCHEMA, documents, frame


def components(n, links):
    label = list(range(n))

    def top(a):
        while label[a] != a:
            a = label[a]
        return a

    for a, b in links:
        a, b = top(a), top(b)
        label[max(a, b)] = min(a, b)
    return [top(a) for a in range(n)]


def test_connected_components(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 180)] + [(300, 300), (400, 390)]
    got = {r.id: r.component for r in connected_components(Scratch(spark, "t"), spark.createDataFrame(links, "a long, b long")).collect()}
    want = {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 180), 100), 400: 390, 390: 390}
    assert got == want


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark):
    rows = documents()
    out = simhash.near_duplicates(frame(spark, rows).withColumn("fp", F.lit("clash")), Scratch(spark, "t")).collect()
    fps = [plain_fingerprint(r[1]) for r in rows]
    of = components(len(rows), [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if (fps[a] ^ fps[b]).bit_count() <= 3])
    low = {}
    for r, c in zip(rows, of):
        low[c] = min(low.get(c, math.inf), -math.inf if r[0] is None else r[0])
    want = sorted((-1 if r[0] is None else r[0], f, None if low[c] == -math.inf else low[c]) for r, f, c in zip(rows, fps, of))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.fp % 2**64, r.component_id) for r in out) == want


@pytest.mark.parametrize("distance,chunk", [(3, 2000), (3, 4), (5, 2000), (7, 2000), (7, 6)])
def test_anchors_lose_no_link(spark, distance, chunk):
    rng = np.random.default_rng(distance)
    x = {int(b) ^ sum(1 << int(p) for p in rng.choice(64, rng.integers(0, 10), replace=False)) for b in rng.integers(0, 2**63, 12) for _ in range(25)}
    x = sorted(x)
    signed = np.array(x, np.uint64).view(np.int64).tolist()
    got = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), Scratch(spark, "t"), distance, chunk).collect()
    at = {v: k for k, v in enumerate(signed)}
    assert all((x[at[r.a]] ^ x[at[r.b]]).bit_count() <= distance for r in got)
    assert components(len(x), [(at[r.a], at[r.b]) for r in got]) == components(len(x), [(a, b) for a, b in itertools.combinations(range(len(x)), 2) if (x[a] ^ x[b]).bit_count() <= distance])


def test_one_of_each(spark):
    rows = documents()
    kept = simhash.one_of_each(frame(spark, rows).withColumn("_id", F.lit(1)), Scratch(spark, "t"))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "_id"]
    got = [r.text for r in kept.collect()]
    long = {r[1] for r in rows if r[1] and len(r[1].split()) > 60}
    assert all(got.count(t) <= 1 for t in long) and len({plain_fingerprint(t) for t in got}) == len(got)
    assert simhash.one_of_each(frame(spark, []), Scratch(spark, "t")).count() == 0


def vectors():
    rng = np.random.default_rng(5)
    out = []
    for label in (1, 2, None):
        for _ in range(30):
            v = rng.normal(size=16)
            for k in range(int(rng.integers(1, 6))):
                out.append(((v + (0.0 if k == 1 else 0.04) * rng.normal(size=16)).astype(np.float32).tolist(), label))
    out += [out[3], out[3], (None, 1), ([], 1), ([0.0] * 16, 1), ([1.0, None] * 8, 1), ([float("nan")] * 16, 1), ([float("inf")] * 16, 1), ([1.0] * 8, 1), ([2.0] * 8, 1)]
    rows = [(i * 7 % 1009, *v) for i, v in enumerate(out)]
    # ids that repeat, or are null, over different vectors
    near = lambda k: ([1.0, 0.0, 0.01 * k, *[0.0] * 13], 2)
    return rows + [(5000, *near(0)), (5000, *near(1)), (5001, *near(2)), (5002, *near(9)), (5002, [0.0, 1.0, *[0.0] * 14], 2), (None, *near(3)), (None, [0.0, 0.0, 0.0, 1.0, *[0.0] * 12], 2), (None, *near(0))]


def number(i):
    return -math.inf if i is None else i


@pytest.mark.parametrize("chunk", [1000, 3])
def test_lattice(spark, chunk):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("low", F.lit("clash")).withColumn("cls", F.lit("clash"))
    key = lambda r: (number(r[0]), r[1], number(r[2]))
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in lattice.near_vectors(df, Scratch(spark, "t"), chunk=chunk).collect()), key=key)
    good = lambda e, label: e and label is not None and all(x is not None and math.isfinite(x) for x in e) and any(e)
    unit = [np.array(e, np.float64) / np.linalg.norm(np.array(e, np.float64)) if good(e, label) else None for _, e, label in rows]
    links = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and float(unit[a] @ unit[b]) >= 0.98]
    of, n = components(len(rows), links), [0] * len(rows)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    low = {}
    for r, c in zip(rows, of):
        low[c] = min(low.get(c, math.inf), number(r[0]))
    want = sorted(((r[0], k, None if low[c] == -math.inf else low[c], number(r[0]) == low[c]) for r, c, k in zip(rows, of, n)), key=key)
    assert len(links) > 50 and got == want


def test_labels_of_any_kind(spark):
    rows = [(1, [1.0, 0.0], "a"), (2, [1.0, 0.01], "a"), (3, [1.0, 0.0], "b"), (4, [1.0, 0.0], None)]
    out = lattice.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string"), Scratch(spark, "t"))
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out.collect()) == [(1, 1, 1), (2, 1, 1), (3, 0, 3), (4, 0, 4)]


@pytest.mark.parametrize("dim", [64, 384, 768])
def test_lattice_recall_at_the_threshold(dim):
    rng = np.random.default_rng(0)
    a = rng.normal(size=(3000, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (b * a).sum(axis=1, keepdims=True) * a
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    x, y = lattice.cells(a), lattice.cells(b)
    meet = lambda x, y: ((x[:, :, :1] == y).any(axis=2) | (y[:, :, :1] == x).any(axis=2)).any(axis=1).mean()
    assert meet(x, y) > 0.998
    assert np.mean([meet(x, np.roll(x, k, axis=0)) for k in range(1, 20)]) < 0.004


def test_nearest_points():
    p = np.random.default_rng(0).normal(size=(500, 8)) * 2
    near = lattice.nearest_e8(p)
    assert np.all(((near[:, None] + lattice.SHORTEST - p[:, None]) ** 2).sum(axis=2) >= ((near - p) ** 2).sum(axis=1)[:, None] - 1e-9)


def test_empty_tables(spark):
    assert lattice.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), Scratch(spark, "t")).count() == 0
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(docs, Scratch(spark, "t")).count() == 0
    assert suffix_array.dedup_bytes(docs, Scratch(spark, "t")).count() == 0
    assert suffix_tree.dedup_words(docs, Scratch(spark, "t")).count() == 0


def low_first(rows):
    """Rows of one id are copies here, so their order doesn't show."""
    return sorted(rows, key=lambda r: -math.inf if r[0] is None else r[0])


KEY = lambda r: (r[0] is not None, r)


@pytest.mark.parametrize("hot", [10**6, 40, 2])
def test_bytes(spark, hot):
    rows = documents() + [(300, "x" + "ab" * 200, "", "", 1), (301, "ab" * 90 + "y", "", "", 1), (302, "é" * 60 + "z", "", "", 1)]
    out = suffix_array.dedup_bytes(frame(spark, rows).withColumn("block", F.lit(1)), Scratch(spark, "t"), hot=hot).collect()
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in out]
    assert sorted(got, key=KEY) == sorted(plain_bytes(rows), key=KEY)


def test_rows_of_one_id_are_ordered(spark):
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abcdefgh"), 150)) for _ in range(3)]
    rows = [(7, a + b, "en", "s", 1) for a, b in itertools.permutations(texts, 2)] + [(7, texts[0] + texts[1], "en", "s", 1), (None, texts[2], "en", "s", 1)]
    runs = [sorted((r.n_removed, bytes(r.kept)) for r in suffix_array.dedup_bytes(frame(spark, rows[::step]).repartition(n), Scratch(spark, "t")).collect()) for step, n in ((1, 1), (-1, 3), (1, 4))]
    assert runs[0] == runs[1] == runs[2] and sum(n for n, _ in runs[0]) > 1000


@pytest.mark.parametrize("hot", [10**6, 20, 2])
def test_words(spark, hot):
    rows = documents()
    out = suffix_tree.dedup_words(frame(spark, rows).withColumn("kept", F.lit(1)), Scratch(spark, "t"), hot=hot).collect()
    first, want = {}, []
    for i, text, *_ in low_first(rows):
        w = (text or "").encode().split()
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    for i, text, *_ in rows:
        w = (text or "").encode().split()
        gone = {j for k in range(len(w) - 12) for j in range(k, k + 13) if (f := first[tuple(w[k : k + 13])]) != i and (f is None or f < i)}
        want.append((i, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    key = lambda r: (r[0] is not None, r)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out), key=key) == sorted(want, key=key)
    assert sum(r.n_removed for r in out) > 100


def test_columns_are_read_from_a_file():
    rng = np.random.default_rng(2)
    size, before = rng.integers(100, 160, 50), rng.integers(0, 60, 50)
    body, first = rng.integers(0, 255, size.sum()).astype(np.uint8), np.cumsum(size) - size
    for c, symbols in suffix_array.columns(before, size, body, 60, 160):
        at = [c - 60 + b for b in before]
        assert symbols.tolist() == [int(body[f + i]) + 1 if 0 <= i < n else 0 for f, i, n in zip(first, at, size)]


def plain_bytes(rows):
    seen, want = set(), []
    for i, text, *_ in low_first(rows):
        x = (text or "").encode()
        gone = np.zeros(len(x), bool)
        for k in range(len(x) - 99):
            if x[k : k + 100] in seen:
                gone[k : k + 100] = True
            seen.add(x[k : k + 100])
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(x) else 0
        want.append((i, len(x), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(x, np.uint8)[~gone].tobytes()).hexdigest()))
    return want



def test_long_documents_in_slices():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 3, 4000)
    bounds = np.array([0, 0, 1500, 1520, 4000])
    whole = passages.windows(x, bounds, 40, 7)
    flat = lambda r: [(int(p), int(f) + j, int(o), int(k)) for p, f, n, o, k in zip(r.place, r.first, r.count, r.of, r.key) for j in range(int(n))]
    assert all(flat(passages.windows(x, bounds, 40, 7, step)) == flat(whole) for step in (64, 100, 999)) and len(flat(whole)) == 1461 + 2441
    assert all((passages.hashes_at(x, whole.place, 7, step) == passages.hashes_at(x, whole.place, 7)).all() for step in (64, 999))
    raw = np.frombuffer(b"one two  three\nfour fivefive sixsixsix " * 40 + b"x" * 300 + b" end", np.uint8)
    off = np.array([0, 10, 10, 50, 200, len(raw)])
    want = suffix_tree.word_places(raw, off)
    assert all(all((a == b).all() for a, b in zip(suffix_tree.word_places(raw, off, step), want)) for step in (7, 30, 101))
    text = raw.tobytes()
    assert [text[a:b] for a, b in zip(want[0].tolist(), want[1].tolist())] == [w for a, b in itertools.pairwise(off.tolist()) for w in text[a:b].split()]


def test_a_text_over_many_slices(spark, monkeypatch):
    rows = documents()
    monkeypatch.setattr(passages.windows, "__defaults__", (150,))
    monkeypatch.setattr(passages.hashes_at, "__defaults__", (150,))
    blocks = suffix_array.pack(frame(spark, rows).coalesce(1), Scratch(spark, "t")).collect()
    block = suffix_array.Block(bytes(blocks[0].blob))
    small = suffix_array.repeated(block.data, block.off, 100, 32, [])[1]
    monkeypatch.undo()
    big = suffix_array.repeated(block.data, block.off, 100, 32, [])[1]
    every = lambda r: {(int(p), int(f) + j, int(k)) for p, f, n, k in zip(r.place, r.first, r.count, r.key) for j in range(int(n))}
    assert every(small) == every(big) and len(small.key) > len(big.key)


def test_grown_anchors_keep_all_windows():
    rng = np.random.default_rng(5)
    x, bounds = rng.integers(0, 4, 3000), np.array([0, 1000, 3000])
    for length, k in ((100, 32), (13, 5), (10, 9)):
        runs, old = passages.windows(x, bounds, length, k), k
        want = sorted((int(f) + j, int(o)) for f, n, o in zip(runs.first, runs.count, runs.of) for j in range(int(n)))
        for new in passages.sizes(length, k)[1:]:
            runs, old = passages.grown(x, runs, old, new, length), new
            assert sorted((int(f) + j, int(o)) for f, n, o in zip(runs.first, runs.count, runs.of) for j in range(int(n))) == want
            assert (runs.place >= runs.first + runs.count - 1).all() and (runs.place + new <= runs.first + length).all()


def test_words_of_one_hash_are_told_apart(monkeypatch):
    body = np.frombuffer(b"aa bb aa ccc bb", np.uint8)
    starts, ends = np.array([0, 3, 6, 9, 13]), np.array([2, 5, 8, 12, 15])
    same = lambda n: [[a == b for a in n] for b in n]
    want = same([0, 1, 0, 2, 1])
    assert same(suffix_tree.numbered(body, starts, ends).tolist()) == want
    monkeypatch.setattr(suffix_tree, "word_hashes", lambda *_: np.zeros(5, np.uint64))
    assert same(suffix_tree.numbered(body, starts, ends).tolist()) == want


def test_buckets_stay_as_large_as_blocks_grow(spark):
    """Sixteen times the blocks: a bucket gets no more, and a block sends no more bytes a key."""
    rng = np.random.default_rng(8)

    def most(n):
        docs = spark.createDataFrame([(i, bytes(rng.integers(97, 123, 2000).astype(np.uint8)).decode()) for i in range(n)], "doc_id long, text string")
        scratch = Scratch(spark, "t")
        blocks = exchange.pack(docs.repartition(4), scratch, block_bytes=20_000)
        count = blocks.count()
        emit = lambda block, _: [(np.unique(passages.windows(block.data, block.off, 100, 32).key), [])]
        back, _ = exchange.route(blocks, scratch, emit, lambda stream, group, values, size: [np.bincount(group).astype(np.uint8) if len(group) else np.zeros(0, np.uint8)])
        entries = [(r.bucket, r.block, len(exchange.dec(bytes(r.message))[0])) for r in back.collect()]
        by = {k: sum(n for b, _, n in entries if b == k) for k in {b for b, *_ in entries}}
        return count, max(by.values()), sum(n for *_, n in entries) / count

    few, many = most(320), most(5120)
    assert many[0] >= 12 * few[0] and many[1] <= 1.7 * few[1] and many[2] == pytest.approx(few[2], rel=0.1)
