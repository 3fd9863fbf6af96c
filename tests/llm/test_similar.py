"""The pipeline's near duplicates against brute force on five-word similarity."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import similar
from sparkloom.llm.common import Scratch

from .fixtures import documents, frame, words
from .test_dedup import components


def shingle_set(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def linked(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def wanted(rows):
    """Ids that stay: of each component of pairs with similarity 0.8 or more, the smallest."""
    sets = [shingle_set(r[1]) for r in rows]
    of, low = components(len(rows), [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if linked(sets[a], sets[b])]), {}
    number = lambda r: -math.inf if r[0] is None else r[0]
    for r, c in zip(rows, of):
        low[c] = min(low.get(c, math.inf), number(r))
    return sorted({(number(r), s) for r, c, s in zip(rows, of, sets) if low[c] == number(r)}, key=lambda x: (x[0], sorted(x[1])))


def changed(rng, text, share):
    return " ".join("x%d" % rng.randint(0, 10**6) if rng.random() < share else w for w in text.split())


def near(seed=21):
    """Copies with a similarity on both sides of 0.8, chains of copies, and a line that all share."""
    rng, out = random.Random(seed), []
    line = words(rng, 30, 3000)
    for _ in range(40):
        text = words(rng, rng.choice([7, 20, 80, 300]), 3000) + (" " + line if rng.random() < 0.5 else "")
        out.append(text)
        for _ in range(3):
            text = changed(rng, text, rng.choice([0.005, 0.02, 0.03]))
            out.append(text)
    rng.shuffle(out)
    return [(i, t, "en", "s", 1) for i, t in enumerate(out)]


@pytest.mark.parametrize("chunk", [2000, 3])
def test_similar_documents(spark, chunk):
    rows = near() + [(None if r[0] is None else r[0] + 1000, *r[1:]) for r in documents()]
    got = similar.one_of_each(frame(spark, rows).withColumn("cls", F.lit(1)), Scratch(spark, "t"), chunk=chunk, missed=1e-5)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "cls"]
    got = sorted(((-math.inf if r.doc_id is None else r.doc_id, shingle_set(r.text)) for r in got.collect()), key=lambda x: (x[0], sorted(x[1])))
    want = wanted(rows)
    assert got == want and 0.2 * len(rows) < len(want) < 0.8 * len(rows)
    assert similar.one_of_each(frame(spark, []), Scratch(spark, "t")).count() == 0


def test_stage_drops_pairs_over_seven_bits(spark):
    import corpus_pipeline as P
    from sparkloom.llm.simhash import fingerprint

    rng, rows = random.Random(5), []
    while len(rows) < 40:
        a = words(rng, 150, 3000)
        b = changed(rng, a, 0.02)
        if linked(shingle_set(a), shingle_set(b)) and (fingerprint(a.encode(), 5) ^ fingerprint(b.encode(), 5)).bit_count() > 7:
            rows += [(len(rows), a, "en", "s", 1), (len(rows) + 1, b, "en", "s", 1)]
    assert sorted(r.doc_id for r in P.near_dedup(spark, frame(spark, rows), "").collect()) == list(range(0, 40, 2))


def sets_at(i, d, n, seed=1):
    """n pairs of sets with i common shingles and d of their own each."""
    rng = np.random.default_rng(seed)
    new = lambda k: rng.integers(0, 2**63, k, dtype=np.uint64)
    both = [(new(i), new(d), new(d)) for _ in range(n)]
    return [np.concatenate((c, a)) for c, a, _ in both], [np.concatenate((c, b)) for c, _, b in both]


@pytest.mark.parametrize("classes", [1000, 256_000, 15_000_000])
def test_recall_of_the_anchors(classes):
    """At a similarity of exactly 0.8, and a little over; and how many other texts are at an anchor."""
    blocks, free = similar.layout(classes)
    for i, d, least in ((16, 2, 0.97), (80, 10, 0.97), (800, 100, 0.97), (90, 6, 0.999)):
        x, y = (similar.wide_fingerprints(s) for s in sets_at(i, d, 300))
        a, b = similar.anchors(x, blocks, free), similar.anchors(y, blocks, free)
        near = np.bitwise_count(similar.check_bits(x) ^ similar.check_bits(y)).sum(axis=1) <= similar.RADIUS
        assert ((a == b).any(axis=1) & near).mean() >= least
        assert (a == b).mean() >= 0.9 * similar.meets(free)
    assert classes / 2 ** (11 + free) <= max(similar.HOMES, classes / 2**11 if free == 0 else 0)
    x = similar.wide_fingerprints(sets_at(100, 0, 2000)[0])
    a = similar.anchors(x, 25, 0)
    assert np.mean([(a == np.roll(a, k, axis=0)).mean() for k in range(1, 20)]) == pytest.approx(2**-11, rel=0.2)


def test_anchors_cover_all_words():
    packed = np.packbits(np.random.default_rng(0).random((500, similar.BITS)) < 0.5, axis=1)
    width, order = similar.CODE + 2, np.random.default_rng(64).permutation(similar.BITS)
    got = similar.anchors(packed, 1, 2)[:, 0]
    bits = np.unpackbits(packed, axis=1)[:, order[:width]]
    off = bits ^ (got[:, None] >> np.arange(width) & 1)
    assert (off.sum(axis=1) <= 1).all() and not off[:, similar.CODE :].any() and len(set((got & (1 << similar.CODE) - 1).tolist())) <= 2**11
    words = got[:, None] >> np.arange(similar.CODE) & 1
    assert all(np.bitwise_xor.reduce([p + 1 for p in np.flatnonzero(w)], initial=0) == 0 for w in words)


def test_recall_of_the_stage(spark):
    """Of pairs of a similarity from 0.8 to 0.9, all but a few are found; of others, none."""
    import corpus_pipeline as P

    rng, rows, pairs = random.Random(6), [], []
    while len(pairs) < 150:
        a = words(rng, rng.choice([60, 150, 400]), 3000)
        b = changed(rng, a, 0.02)
        x, y = shingle_set(a), shingle_set(b)
        share = len(x & y) / len(x | y)
        if 0.7 <= share < 0.9:
            pairs.append((len(rows), share))
            rows += [(len(rows), a, "en", "s", 1), (len(rows) + 1, b, "en", "s", 1)]
    left = {r.doc_id for r in P.near_dedup(spark, frame(spark, rows), "").collect()}
    near = [i for i, share in pairs if share >= 0.8]
    assert len(near) > 40 and sum(i + 1 not in left for i in near) >= 0.97 * len(near)
    assert all(i + 1 in left for i, share in pairs if share < 0.8) and all(i in left for i, _ in pairs)


def test_a_dense_group_of_near_copies(spark):
    """Hundreds of different near copies: few of their pairs are verified, and one stays."""
    rng = random.Random(7)
    text = words(rng, 300, 3000).split()
    rows = [(i, " ".join([*text[: i % 290], f"v{i}", *text[i % 290 + 1 :]]), "en", "s", 1) for i in range(400)] + [(1000, words(rng, 300, 3000), "en", "s", 1)]
    assert sorted(r.doc_id for r in similar.one_of_each(frame(spark, rows), Scratch(spark, "t")).collect()) == [0, 1000]
