"""What SQL can't express, against plain versions: the field's spans, language models, the pipeline."""

import collections
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import decontaminate, langid, mixing, ngram, pii
from sparkloom.llm.common import Scratch

from .fixtures import documents, frame, save, words
from .test_models import fold, private, spoken
from .test_similar import near, wanted


def segmentations(n):
    """All ways to cut n words into segments of up to MAX_WORDS with types: (start, length, type)."""

    def rest(i):
        if i == n:
            yield ()
        for m in range(1, min(pii.MAX_WORDS, n - i) + 1):
            for tail in rest(i + m):
                for y in range(len(pii.TYPES)) if m == 1 else range(1, len(pii.TYPES)):
                    yield ((i, m, y), *tail)

    return list(rest(0))


def value(field, slots, seg):
    out, last = 0.0, 0
    for i, m, y in seg:
        out += float(field.w[slots[i, m - 1], y].sum()) + float(field.a[last, y])
        last = y
    return out


def random_field(seed, scale=1.0):
    rng, field = np.random.default_rng(seed), pii.Field()
    field.w[:], field.a[:] = scale * rng.normal(size=field.w.shape), scale * rng.normal(size=field.a.shape)
    field.w[0] = 0
    return field


def test_spans_against_all_segmentations():
    rng = random.Random(1)
    for seed in range(12):
        field = random_field(seed)
        text = " ".join(rng.choice(["12", "me@x.yy", "4111", "abc", "10.0.0.1", "+1", "x"]) for _ in range(rng.randint(1, 5))) + " 7"
        taken = pii.base_spans(text)
        (run,) = pii.regions(text)
        slots = pii.lattice(text, run)
        free = pii._free(run, taken)
        allowed = [s for s in segmentations(len(run)) if all(y == 0 or free[i, m - 1] for i, m, y in s)]
        best = max(allowed, key=lambda s: value(field, slots, s))
        want = [(*pii.trimmed(text, run[i][0], run[i + m - 1][1]), pii.TYPES[y]) for i, m, y in best if y]
        assert pii.added_spans([text], [taken], field)[0] == [s for s in want if s[0] < s[1]], text


def test_training_against_all_segmentations():
    """Three steps of training, with expectations summed over every segmentation."""
    rng, texts = random.Random(2), ["a 12 x", "4111 1111", "t = 9q"]
    words_of = [[m.span() for m in re.finditer(r"\S+", t)] for t in texts]
    slots = [pii.lattice(t, w) for t, w in zip(texts, words_of)]
    gold = [[(0, 1, 0), (1, 1, 5), (2, 1, 0)], [(0, 2, 3)], [(0, 1, 0), (1, 1, 0), (2, 1, 5)]]
    plain = pii.Field()
    w, a = plain.w.astype(np.float64), plain.a.astype(np.float64)
    sum_w, sum_a = np.full_like(w, 1e-6), np.full_like(a, 1e-6)
    for _ in range(3):
        field = pii.Field()
        field.w, field.a = w.astype(np.float32), a.astype(np.float32)
        gw, ga = -0.02 * w, -0.02 * a

        def add(x, seg, by, gw=gw, ga=ga):
            last = 0
            for i, m, y in seg:
                np.add.at(gw, (x[i, m - 1], y), by)
                ga[last, y] += by
                last = y

        for x, g in zip(slots, gold):
            every = segmentations(len(x))
            p = np.exp([value(field, x, s) for s in every])
            add(x, g, 1.0)
            for s, q in zip(every, p / p.sum()):
                add(x, s, -q)
        gw[0] = 0
        sum_w += gw**2
        sum_a += ga**2
        w, a = w + 0.3 * gw / np.sqrt(sum_w), a + 0.3 * ga / np.sqrt(sum_a)
    field = pii.Field()
    pad = lambda v: np.concatenate((v, np.zeros((pii.WINDOW - len(v), *v.shape[1:]), v.dtype)))
    size = np.array([len(x) for x in slots])
    free = np.stack([pad(pii._free(r, [])) for r in words_of])
    marks = np.zeros((3, pii.WINDOW, 2), np.int8)
    for k, g in enumerate(gold):
        for i, m, y in g:
            marks[k, i] = m, y
    field.fit(np.stack([pad(x) for x in slots]), size, free, marks, steps=3)
    assert np.allclose(field.w, w, atol=2e-3) and np.allclose(field.a, a, atol=2e-3) and rng is not None


def test_regions_against_all_words():
    def plain(t):
        spans = [m.span() for m in pii._WORDS.finditer(t)]
        hit = [any(a <= x < b for x in pii.triggers(t)) for a, b in spans]
        keep = [any(hit[max(0, i - 3) : i + 4]) for i in range(len(spans))]
        runs = [[i for i, _ in g] for k, g in itertools.groupby(enumerate(keep), key=lambda x: x[1]) if k]
        return [([spans[i] for i in r], [n for n, i in enumerate(r) if hit[i]]) for r in runs]

    rng = random.Random(0)
    for _ in range(5000):
        t = "".join(rng.choice(["a", "b", " ", " ", "\n", "1", "@", "  ", "password = abcdefghijklmnopqrst ", "token:", " xx ", " y ", " z "]) for _ in range(rng.randint(0, 30)))
        assert pii.areas(t) == plain(t), t


def test_long_secrets_are_found(spark):
    rng = random.Random(5)
    letters = lambda n: "".join(rng.choice("abcdefghijkmnpqrstuvwxyzABCDEFGH") for _ in range(n))
    rows = private() + [(1000 + i, f'{words(rng, 5)} password = "{letters(rng.choice([20, 90, 200]))}" {words(rng, 5)}', "en", "s", 1) for i in range(200)]
    secret = letters(90) + "7"
    rows += [(5000, f'x password = "{secret}" y', "en", "s", 1), (5001, f'x password = "{letters(91)}" y', "en", "s", 1), (5002, f"{words(rng, 60)} {letters(300)} {words(rng, 60)}", "en", "s", 1)]
    docs = frame(spark, rows)
    got = {r.doc_id: r.spans for r in pii.find(docs, pii.fit(docs)).collect()}
    assert "secret:14:105" in got[5000] and "secret:14:105" in got[5001] and got[5002] == ""
    assert sum("secret" in got[1000 + i] for i in range(200)) >= 190


def test_many_spans_take_linear_time():
    import time

    took = []
    for n in (4000, 16000):
        text = "a@b.cc 10.0.0.1 " * n
        base = pii.base_spans(text)
        began = time.time()
        pii.added_spans([text], [base], pii.Field())
        took.append(time.time() - began)
    assert took[1] < 12 * took[0] + 0.5


def plain_features(text):
    raw = (text or "").lower().encode()
    folded = re.sub(rb" +", b" ", bytes(32 if c < 128 and not chr(c).isalpha() else c for c in raw) + b" ")
    counts, x = collections.Counter(), list(folded)
    for k in range(1, 5):
        for i in range(len(x) - k + 1):
            h = 0
            for j in range(k):
                h = (h * 0x01000193 + x[i + j] + j + 1) % 2**32
            counts[(((h ^ h >> 15) * 0x2C1B3C6D % 2**32) >> 16) % langid.DIMENSIONS] += 1
    v = np.zeros(langid.DIMENSIONS)
    for slot, n in counts.items():
        v[slot] = math.sqrt(n)
    return v / (np.linalg.norm(v) or 1)


def plain_svm(x, y):
    """Plain gradient descent on the same objective: margins by hinge loss squared, both classes alike."""
    x = np.concatenate((x, np.ones((len(x), 1))), axis=1)
    cost = 10.0 / len(y) * np.where(y > 0, len(y) / 2 / (y > 0).sum(), len(y) / 2 / (y < 0).sum())
    w, rate = np.zeros(x.shape[1]), 1 / (1e-3 + 2 * np.linalg.eigvalsh((x * cost[:, None]) @ x.T).max())
    for _ in range(2500):
        gap = np.maximum(0, 1 - y * (x @ w))
        w -= rate * (1e-3 * w - 2 * x.T @ (cost * y * gap))
    return w


def test_languages_against_plain_svms(spark):
    rows = spoken(200)
    x = np.stack([plain_features(t) for _, t, *_ in rows])
    assert np.allclose(langid.features(langid.pa.array([t for _, t, *_ in rows])), x, atol=1e-5)
    train = [k for k, r in enumerate(rows) if fold(r[0], 4) != 2]
    lang = np.array([r[2] for r in rows])
    of = np.array([langid.family(v) for v in lang])
    score = lambda yes, some: np.concatenate((x, np.ones((len(x), 1))), axis=1) @ plain_svm(x[some], np.where(yes[some], 1.0, -1.0))
    families = sorted(set(of))
    best = np.array(families)[np.argmax([score(of == f, train) for f in families], axis=0)]
    want = []
    votes = {f: {v: np.zeros(len(x)) for v in sorted(set(lang[of == f]))} for f in families}
    for f in families:
        for a, b in itertools.combinations(votes[f], 2):
            p = score(lang == a, [k for k in train if lang[k] in (a, b)])
            votes[f][a] += p
            votes[f][b] -= p
    for k, f in enumerate(best):
        want.append(max(votes[f], key=lambda v: votes[f][v][k]))
    got = {r.doc_id: r.lang_pred for r in langid.identify(frame(spark, rows), ("doc_id",)).collect()}
    assert sum(got[r[0]] == w for r, w in zip(rows, want)) >= 0.99 * len(rows)


def test_every_language_is_learned_in_tasks(spark, monkeypatch):
    """Many languages over several tasks, the same as in one process."""
    rng, rows = random.Random(9), []
    for k in range(30):
        parts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in range(6)]
        rows += [(100 * k + i, " ".join(rng.choice(parts) for _ in range(30)), f"l{k:02d}" if k > 2 else ("en", "de", "fr")[k], "s", 1) for i in range(10)]
    docs = frame(spark, rows)
    model = langid.fit(docs)
    alone = langid.Model.of(langid.features(langid.pa.array([t for _, t, *_ in rows])), [r[2] for r in rows])
    assert len(model.languages) == 30 and model.jobs == alone.jobs and len(model.jobs) == 3 + 1 + 27 * 26 // 2
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, model, ("doc_id",)).collect()}
    assert sum(got[r[0]] == r[2] for r in rows) >= 0.97 * len(rows)
    few = langid.fit(docs, sample_rows=60)  # the least number of rows of each stays
    assert len(few.languages) == 30


def test_scores_against_plain_interpolation(spark):
    rng = random.Random(13)
    rows = [r for r in documents() if not r[1] or len(r[1]) < 3000] + [(i, words(rng, 40, 80), "en", "s", 1) for i in range(400, 800)]
    texts = [["<s>", *(r[1] or "").encode().lower().split(), None] for r in rows]
    part = ["test" if fold(r[0], 7) == 2 else "fold" if fold(r[0], 7) == 3 else "train" for r in rows]
    count = lambda kinds, n: collections.Counter(tuple(t[i - n + 1 : i + 1]) for t, p in zip(texts, part) if p in kinds for i in range(1, len(t)))
    begins = lambda kinds: sum(p in kinds for p in part)

    def estimates(kinds, skip=()):
        one, two, n = count(kinds, 1), count(kinds, 2), sum(count(kinds, 1).values())
        context = lambda w: begins(kinds) if w == "<s>" else one[(w,)]
        return lambda a, b: (context(a), two[(a, b)] / context(a) if context(a) else 0.0, one[(b,)] / n)

    v = len(count(("train", "fold"), 1))
    inner, held = estimates(("train",)), {}
    exact = collections.defaultdict(collections.Counter)
    for t, p in zip(texts, part):
        if p == "fold":
            for a, b in itertools.pairwise(t):
                c, f2, f1 = inner(a, b)
                k = int(ngram.bucket(np.array([float(c)]))[0])
                (c2, l2), (c1, l1) = (tuple(int(x[0]) for x in ngram.cells(np.array([f]))) for f in (f2, f1))
                cell = held.setdefault((k, c2, c1), [0, 0, 0])
                held[k, c2, c1] = [cell[0] + 1, cell[1] + l2, cell[2] + l1]
                exact[k][f2, f1] += 1
    weights = ngram.learn([(k, 10 ** (l2 / n / 1e6) if c2 else 0.0, 10 ** (l1 / n / 1e6) if c1 else 0.0, n) for (k, c2, c1), (n, l2, l1) in sorted(held.items())], 1 / (v + 1))
    for k, table in exact.items():  # plain EM on the estimates themselves
        w = np.array([0.4, 0.5, 0.1]) if k else np.array([0, 0.9, 0.1])
        for _ in range(200):
            new = np.full(3, 1e-3)
            for (f2, f1), n in table.items():
                share = w * (f2, f1, 1 / (v + 1))
                new += n * share / share.sum()
            w = new / new.sum()
        if k:
            assert np.allclose(w, weights[k], atol=0.005), (k, w, weights[k])
    outer = estimates(("train", "fold"))
    want = []
    for t in texts:
        total = 0.0
        for a, b in itertools.pairwise(t):
            c, f2, f1 = outer(a, b)
            total += math.log10(weights[int(ngram.bucket(np.array([float(c)]))[0])] @ (f2, f1, 1 / (v + 1)))
        want.append(total)
    got = ngram.score(frame(spark, rows), Scratch(spark, "t")).collect()
    key = lambda i: (i is not None, i or 0)
    assert sorted((key(r.doc_id), round(r.score, 5)) for r in got) == sorted((key(r[0]), round(s, 5)) for r, s in zip(rows, want))


def test_scores_without_training_text(spark):
    i = next(i for i in range(100) if fold(i, 7) == 2)
    (row,) = ngram.score(frame(spark, [(i, "two words", "en", "s", 1)]), Scratch(spark, "t")).collect()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (True, 3, 0, 0, 0.0, 0.0)


def contaminated(rows, items):
    norm = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = set()
    for k, (_, text, *_) in enumerate(rows):
        w = norm(text)
        for _, t in items:
            v = norm(t)
            n = min(5, len(v))
            if not v or len(w) < n:
                continue
            sh = lambda x: [tuple(x[j : j + n]) for j in range(len(x) - n + 1)]  # noqa: B023, E731
            a, b = sh(w), collections.Counter(sh(v))
            size = min(len(a), len(v) - n + 1)
            if any(decontaminate.similarity(collections.Counter(a[j : j + size]), b) >= 0.8 for j in range(len(a) - size + 1)):
                out.add(k)
    return out


def test_pipeline_against_its_stages(spark, tmp_path):
    """Rows that repeat, null ids and sources, ties, texts of all kinds, and extra columns of any name."""
    import corpus_pipeline as P

    rng = random.Random(17)
    items = [(k, words(rng, rng.choice([13, 30, 60]), 3000)) for k in range(8)] + [(8, None), (9, "")]
    rows = near() + [(None if r[0] is None else r[0] + 1000, *r[1:]) for r in documents()] + [(i + 5000, *r[1:]) for i, r in enumerate(private(80))]
    rows += [(6000 + k, words(rng, 20, 3000) + " " + t.upper() + " " + words(rng, 20, 3000), "en", None, 1) for k, t in items[:8]]
    rows += [(7000, words(rng, 9000, 3000) + " 10.1.2.3", "en", "s", 1), (None, "me@x.org wrote this text without an id", None, None, None)]
    extra = frame(spark, rows).withColumn("extra", F.lit(7)).withColumn("_row", F.lit("clash")).withColumn("taken", F.lit(1)).withColumn("cls", F.lit("x")).withColumn("spans", F.lit("y"))
    sf = save(spark, tmp_path, documents=extra, benchmark=spark.createDataFrame(items, "item_id long, text string"))
    left = [r for r in rows if re.search(r"[^\W\d_]", r[1] or "")]
    kept = {(i, s) for i, s in wanted(left)}
    from .test_similar import shingle_set

    once, after = set(), []
    for r in left:  # of rows that repeat an id and a set, one stays
        k = (-math.inf if r[0] is None else r[0], shingle_set(r[1]))
        if k in kept and k not in once:
            once.add(k)
            after.append(r)
    bad = contaminated(after, items)
    after = [r for k, r in enumerate(after) if k not in bad]
    docs = frame(spark, [(*r[:4], k) for k, r in enumerate(after)])
    found = {r.n_chars: [(int(a), int(b), k) for k, a, b in (x.split(":") for x in r.spans.split(",") if x)] for r in pii.find(docs, pii.fit(docs), ("n_chars",)).collect()}
    clean = [(r[0], pii.redacted(r[1], found[k]), *r[2:]) for k, r in enumerate(after)]
    con = duckdb.connect()
    con.register("d0", frame(spark, clean).toPandas())
    con.execute("create view documents as select doc_id::bigint as doc_id, text, source from d0")
    mixed = {(i, n): t for i, n, t in con.execute(f"select doc_id, size, taken from ({mixing.ORACLE})").fetchall()}
    got = P.run(spark, sf).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.text, r.taken, r.n_chars, r.extra, r._row, r.cls, r.spans) for r in got) == sorted((-1 if r[0] is None else r[0], r[1], mixed[r[0], len(r[1].encode().split())], None if r[4] is None else len(r[1]), 7, "clash", "x", "y") for r in clean)
    assert len(left) < len(rows) and 100 < len(clean) < len(left) - 30 and bad and any("[EMAIL]" in r[1] for r in clean)


@pytest.mark.parametrize("doc", [(1, None), (2, ""), (3, "word"), (None, "no id here"), (4, "x" * 200_000), (5, "w " * 50_000)])
def test_pipeline_of_one_document(spark, tmp_path, doc):
    import corpus_pipeline as P

    sf = save(spark, tmp_path, documents=frame(spark, [(*doc, None, None, None)]), benchmark=spark.createDataFrame([], "item_id long, text string"))
    got = P.run(spark, sf).collect()
    assert [(r.doc_id, r.text) for r in got] == ([doc] if doc[1] else []) and zlib.crc32(b"") == 0
