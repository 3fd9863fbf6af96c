"""Language ID, personal data, decontamination, scoring, mixing, token counts and the pipeline."""

import collections
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import decontaminate, langid, mixing, ngram, pii, tokencount
from sparkloom.llm.common import Scratch

from ..conftest import same_rows
from .fixtures import documents, frame, save, words


def fold(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def plain_spans(t):
    out = [(*m.span(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(*m.span(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append((*m.span(), "card"))
    out += [(*m.span(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2]), s[1]))


def test_base_spans_are_the_patterns():
    rng = random.Random(3)
    for _ in range(5000):
        t = "".join(rng.choice("ab19.@-+ (0é%_\n") for _ in range(rng.randint(0, 40))) + "".join(rng.choice("0123456789 .-+") for _ in range(rng.choice([0, 0, 30])))
        assert pii.base_spans(t) == plain_spans(t), t
    assert pii.base_spans("4111 1111 1111 1111 me@x.org 10.0.0.255 +1 (415) 555-0100 x 256.1.1.1") == [(0, 19, "card"), (20, 28, "email"), (29, 39, "ip"), (40, 57, "phone")]


def test_base_spans_are_linear():
    assert pii.base_spans("a" * 300_000 + "@") == [] and pii.base_spans("1" * 300_000) == [] and len(pii.base_spans("x@y.zz " * 20_000)) == 20_000


def private(n=300):
    rng = random.Random(4)
    kinds = (lambda: f"u{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com", lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4)), lambda: "4111111111111111", lambda: f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}", lambda: 'token = "%040x"' % rng.getrandbits(160), lambda: str(rng.randint(1, 999)))
    return [(i, words(rng, 8) + " " + rng.choice(kinds)() + " " + words(rng, 6), "en", "s", 1) for i in range(n)]


def test_private_data(spark):
    rows = private() + [(r[0] if r[0] is None else r[0] + 1000, *r[1:]) for r in documents()]
    rows.append((5000, "pay 84127813050 4111111111111111 now", "en", "s", 1))
    docs = frame(spark, rows).withColumn("spans", F.lit("clash"))
    field = pii.fit(docs)
    got = collections.defaultdict(list)
    for r in pii.find(docs, field).collect():
        got[r.doc_id].append(r)
    for i, text, *_ in rows:
        base = plain_spans(text or "")
        for r in got[i]:
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == s[2] for s in base) for k in pii.KINDS]
            assert {f"{k}:{a}:{b}" for a, b, k in base} <= set(r.spans.split(","))
    assert sum(len(x) for x in got.values()) == len(rows)
    secrets = [i for i, t, *_ in rows if t and "token =" in t]
    assert sum("secret:" in got[i][0].spans for i in secrets) >= 0.95 * len(secrets)
    assert all("secret" not in got[i][0].spans for i, t, *_ in rows if t and not re.search("[0-9@]", t))
    assert "card:16:32" in got[5000][0].spans
    clean = {r.doc_id: r.text for r in pii.find(docs, field, ("doc_id",), redact=True).collect()}
    assert all(clean[i] == t for i, t, *_ in rows if not t) and "[EMAIL]" in " ".join(x or "" for x in clean.values())
    assert pii.find(frame(spark, []), pii.fit(frame(spark, []))).count() == 0


def test_entities_at_every_place_of_a_run(spark):
    field = pii.fit(frame(spark, private()))
    field.w[:] = 0
    field.a[:] = 0
    digits = lambda n, d: [pii.zlib.crc32(x.encode()) % (pii.SLOTS - 1) + 1 for x in (f"n{n}", f"d{d}")]
    field.w[digits(4, 16)[0], 3], field.w[digits(4, 16)[1], 3] = 4, 4  # four words of sixteen digits are a card
    field.w[:, 0] = 1e-3
    for k in range(40):
        text = "12 " * k + "x1 4111 1111 1111 1111 x2 " + "12 " * (40 - k)
        a = text.index("4111")
        assert (a, a + 19, "card") in pii.added_spans([text], [[]], field)[0], k
    text = "a" * 100 + "1 b " + "2" + "c" * 100 + " " + "d" * 300
    assert [text[a:b] for a, b in pii.regions(text)[0]][:3] == text.split()[:3]


def test_regions_are_linear():
    assert sum(map(len, pii.regions("1" + "x" * 300_000 + " 12" * 100_000))) == 100_001


def test_redaction_of_overlapping_spans():
    assert pii.redacted("abcdef", [(1, 3, "ip"), (2, 4, "card"), (5, 6, "email")]) == "a[IP]e[EMAIL]"


def spoken(n=240):
    rng, out = random.Random(6), []
    parts = {"en": ["the", "and", "ing", "th", "wh"], "de": ["sch", "ung", "der", "ich", "ß"], "fr": ["eau", "oui", "è", "ch", "tre"], "es": ["ción", "ñ", "que", "os", "ll"]}
    for i in range(n):
        lang = list(parts)[i % 4]
        out.append((i, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(30)), lang, lang, 1))
    return out


def test_language(spark):
    rows = spoken() + [(900, None, "en", "s", 0), (901, "123 ...", "en", "s", 0), (902, "", "en", "s", 0), (903, "the thing and the", None, "s", 0), (None, "the thing", "en", "s", 0)]
    docs = frame(spark, rows).withColumn("held_out", langid.held_out()).withColumn("score", F.lit("clash"))
    out = langid.identify(docs, ("doc_id", "held_out")).collect()
    got = {r.doc_id: r for r in out}
    assert len(out) == len(rows) and all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in out)
    assert [got[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "en"]
    held = [(i, lang) for i, _, lang, *_ in rows[:240] if fold(i, 4) == 2]
    assert sum(got[i].lang_pred == lang for i, lang in held) >= 0.98 * len(held)
    swapped = docs.withColumn("lang", F.when(langid.held_out(), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("z"))
    assert {r.doc_id: r.lang_pred for r in langid.identify(swapped, ("doc_id",)).collect()} == {i: r.lang_pred for i, r in got.items()}
    one = frame(spark, [(1, "abc", "en", "s", 1), (2, "def", "en", "s", 1)])
    assert {r.lang_pred for r in langid.identify(one, ("doc_id",)).collect()} == {"en"}
    assert [r.lang_pred for r in langid.identify(frame(spark, [(1, "abc", None, "s", 1)]), ("doc_id",)).collect()] == ["und"]
    assert langid.identify(frame(spark, []), ("doc_id",)).count() == 0


def test_decontamination(spark):
    rng = random.Random(8)
    items = [(k, words(rng, rng.choice([3, 8, 20, 45, 90]), 3000)) for k in range(30)] + [(30, None), (31, ""), (32, "!?")]
    rows = documents() + [(1000 + k, words(rng, 30, 3000) + "\n" + t.upper().replace(" ", ",  ", 2) + " " + words(rng, 30, 3000), "en", "s", 1) for k, t in items[:30]]
    rows += [(2000 + k, " ".join(w if j != len(t.split()) // 2 else "changed" for j, w in enumerate(t.split())) + " " + words(rng, 9, 3000), "en", "s", 1) for k, t in items[:30]]
    docs, bench = frame(spark, rows).withColumn("item_id", F.lit(1)), spark.createDataFrame(items, "item_id long, text string")
    norm = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    want = {}
    for i, text, *_ in rows:
        w = norm(text)
        for k, t in items:
            v = norm(t)
            n = min(5, len(v))
            if not v or len(w) < n:
                continue
            sh = lambda x: [tuple(x[j : j + n]) for j in range(len(x) - n + 1)]
            a, b = sh(w), collections.Counter(sh(v))
            size = min(len(a), len(v) - n + 1)
            best = max(decontaminate.similarity(collections.Counter(a[j : j + size]), b) for j in range(len(a) - size + 1))
            if best >= 0.8:
                want[i, k] = best
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(docs, bench).collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in want) and len(want) > 30
    left = sorted(r.doc_id for r in decontaminate.clean(docs, bench).where("doc_id is not null").collect())
    bad = {i for i, _ in want}
    assert left == sorted(r[0] for r in rows if r[0] is not None and r[0] not in bad)
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(rows) and decontaminate.contaminated(frame(spark, []), bench).count() == 0


def test_benchmark_in_parts(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PART_BYTES", 400)
    rng = random.Random(9)
    items = [(k, words(rng, 20, 3000)) for k in range(20)]
    docs = frame(spark, [(k, t, "en", "s", 1) for k, t in items])
    got = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(k, k) for k in range(20)]


def test_one_pass_for_many_items(spark):
    rng = random.Random(10)
    items = [(k, words(rng, rng.choice([6, 13, 30]), 3000)) for k in range(3000)]
    docs = frame(spark, [(k, words(rng, 20, 3000) + " " + t, "en", "s", 1) for k, t in items[::10]])
    out = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in out.collect()} >= {(k, k) for k, _ in items[::10]}
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_items_within_the_radius_at_the_similarity():
    """Windows with changed words, at a similarity of 0.8 or a little over."""
    rng, found, n = np.random.default_rng(12), 0, 0
    while n < 3000:
        size = int(rng.integers(30, 120))
        item = rng.integers(0, 2**63, size, dtype=np.uint64)
        window = item.copy()
        window[rng.choice(size, max(1, size // 48), replace=False)] = rng.integers(0, 2**63, max(1, size // 48), dtype=np.uint64)
        a, b = decontaminate.shingles(item, 5), decontaminate.shingles(window, 5)
        if 0.8 <= decontaminate.similarity(collections.Counter(a.tolist()), collections.Counter(b.tolist())) < 0.86:
            n += 1
            fa, fb = decontaminate.simhash_rows(np.stack((a, b)))
            found += int(np.bitwise_count(fa ^ fb)) <= decontaminate.RADIUS
    assert found >= 0.997 * n


def test_multi_index_finds_all_in_the_radius():
    rng = np.random.default_rng(1)
    items = rng.integers(0, 2**63, 100, dtype=np.uint64)
    near = items ^ np.array([sum(1 << int(b) for b in rng.choice(64, 19, replace=False)) for _ in items], np.uint64)
    row, item = decontaminate.MultiIndex(items).near(near)
    assert {(k, k) for k in range(100)} <= set(zip(row.tolist(), item.tolist()))


def test_ngram_scores(spark):
    rows = [r for r in documents()] + [(i, words(random.Random(i), 50, 60), "en", "s", 1) for i in range(400, 600)]
    out = ngram.score(frame(spark, rows).withColumn("score", F.lit(1)), Scratch(spark, "t")).collect()
    tokens = [[*(r[1] or "").encode().lower().split(), None] for r in rows]
    seen = collections.Counter(w for r, t in zip(rows, tokens) if fold(r[0], 7) != 2 for w in t)
    n, v = sum(seen.values()), len(seen)
    want = sorted((repr(r[0]), fold(r[0], 7) == 2, len(t), sum(seen[w] > 0 for w in t), n, round(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in t), 6)) for r, t in zip(rows, tokens))
    assert sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    held = [r for r in out if r.held_out and r.n_tokens > 20]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) and all(r.score < 0 for r in out)
    assert ngram.score(frame(spark, []), Scratch(spark, "t")).count() == 0


def test_mixture_weights_are_learned():
    truth, rng = (0.7, 0.2, 0.1), np.random.default_rng(0)
    table = []
    for f2, f1 in ((1e-3, 1e-5), (0, 1e-4), (0.1, 1e-6)):
        table.append((5, f2, f1, 1000 * (truth[0] * f2 + truth[1] * f1 + truth[2] * 1e-5)))
    w = ngram.learn(table, 1e-5)
    assert np.allclose(w.sum(axis=1), 1) and w[0, 0] == 0 and (w[4] == w[5]).all() and rng is not None


def mixed(spark, rows):
    con = duckdb.connect()
    data = frame(spark, rows).toPandas()
    con.register("documents", data)
    con.execute("create table d as select doc_id::bigint as doc_id, text, source from documents")
    con.unregister("documents")
    con.execute("create view documents as select * from d")
    return con.execute(mixing.ORACLE).df()


def test_mixing(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, rng.randint(0, 80)) or None, "en", rng.choice(["a", "a", "a", "b", "c", None]), 1) for i in range(300)]
    out = mixing.mix(frame(spark, rows).withColumn("size", F.lit("clash")), Scratch(spark, "t")).toPandas()
    same_rows(out.drop(columns="source"), mixed(spark, rows))
    for _, g in out.groupby(out.source.fillna("")):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 1 and (g.taken <= 2 * g["size"]).all()
    total = out["size"].sum()
    assert abs(out.taken.sum() - 1.5 * total) <= 4
    spread = [r.position for r in mixing.mix(frame(spark, rows), Scratch(spark, "t")).collect()]
    assert [p for p in spread if p is not None] == sorted(p for p in spread if p is not None)
    nothing = mixing.mix(frame(spark, [(1, None, "en", "a", 1), (2, "", "en", None, 1)]), Scratch(spark, "t")).collect()
    assert [r.taken for r in nothing] == [0, 0] and mixing.mix(frame(spark, []), Scratch(spark, "t")).count() == 0


def test_schedules_invert(spark):
    for i, knots in enumerate(mixing.SCHEDULES):
        total = sum((t1 - t0) * (a + b) / 2 for (t0, a), (t1, b) in zip(knots, knots[1:]))
        for t in (0.0, 0.2, 0.5, 0.75, 0.99):
            share, done = 0.0, 0
            for (t0, a), (t1, b) in zip(knots, knots[1:]):
                end = min(t, t1)
                if end > t0:
                    share += (end - t0) * (a + a + (b - a) * (end - t0) / (t1 - t0)) / 2
                done += 1
            got = spark.range(1).select(mixing.invert(F.lit(i), F.lit(share / total)).alias("t")).first().t
            assert got == pytest.approx(t, abs=1e-9) and done


def test_token_counts(spark):
    rows = documents()
    docs = frame(spark, rows).withColumn("n_tokens", F.lit("clash"))
    with open(tokencount.VOCABULARY, "rb") as f:
        e = tokencount.encoder(f.read())
    sizes = [len(e.encode_ordinary(r[1] or "")) for r in rows]
    assert all(e.decode(e.encode_ordinary(r[1] or "")) == (r[1] or "") for r in rows)
    got = {r.length: r for r in tokencount.length_histogram(tokencount.token_lengths(docs), Scratch(spark, "t")).collect()}
    assert set(got) == set(sizes)
    for n, r in got.items():
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least, r.tokens_cut_at) == (sizes.count(n), sum(s >= n for s in sizes), sum(s for s in sizes if s >= n), sum(min(s, n) for s in sizes))
        assert (r.total_docs, r.total_tokens) == (len(sizes), sum(sizes)) and r.quantile == pytest.approx(sum(s <= n for s in sizes) / len(sizes))
    assert tokencount.length_histogram(tokencount.token_lengths(frame(spark, [])), Scratch(spark, "t")).count() == 0


def test_language_stage_without_labels(spark):
    import corpus_pipeline as P

    docs = frame(spark, [(1, "a clean text", None, "s", 1), (2, "été", None, "s", 1), (3, None, None, "s", 1), (4, "12 !", None, "s", 1)])
    assert sorted(r.doc_id for r in P.language_id(spark, docs, "").collect()) == [1, 2]


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as P

    rng = random.Random(11)
    item = " ".join("item%d" % rng.randint(0, 9999) for _ in range(30))
    body = lambda: " ".join("word%s" % "".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(80))
    plain = [(i, body(), "en", f"s{i % 3}", 1) for i in range(30)]
    rows = plain + [(100, plain[3][1], "en", "s0", 1), (101, plain[4][1] + " more", "en", "s1", 1), (102, body() + " " + item, "en", "s1", 1), (103, body() + " me@mail.example.com " + body(), "en", "s2", 1), (104, "12 34", "en", "s", 1), (105, None, "en", "s", 1)]
    sf = save(spark, tmp_path, documents=frame(spark, rows).withColumn("extra", F.lit(7)).withColumn("taken", F.lit(1)), benchmark=spark.createDataFrame([(1, item)], "item_id long, text string"))
    out = {r.doc_id: r for r in P.run(spark, sf).collect()}
    assert set(range(30)) <= set(out) and set(out) - set(range(30)) <= {101, 103} and 103 in out and 100 not in out
    assert "[EMAIL]" in out[103].text and "@" not in out[103].text and out[103].n_chars == len(out[103].text) and out[0].extra == 7
    assert sum(r.taken for r in out.values()) == pytest.approx(1.5 * sum(r["size"] for r in out.values()), abs=3)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
        assert stage(spark, docs.limit(0), sf).count() == 0
    assert P.STAGES[-1][1](spark, docs.limit(0), sf).count() == 0
