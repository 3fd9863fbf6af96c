"""Language identification by hierarchical discrimination.

A linear SVM per family (one against the rest) predicts the language family; within the
family, one-versus-one linear SVMs separate its languages. Features are hashed byte 1- to
4-grams of the whole lower-cased text, non-letters collapsed to word ends, as square roots
of counts scaled to length one.

Training reads only text and lang of the training rows. It uses a bounded sample: about
PER_LANGUAGE rows of each language (all, if fewer), chosen by a hash of the id, so the
sample doesn't depend on the layout; with over SAMPLE_ROWS / PER_LANGUAGE languages, each has
an equal share of SAMPLE_ROWS, but at least LEAST rows. Every language is learned. The sample's
features are a written table, and every task fits the classifiers of one family, or of the
pairs between two groups of at most TOGETHER languages, so that no process holds more rows
than that; the driver gets the classifiers. Prediction runs over every row; the model has
8 KB for each family and pair of languages in a family.

The score is the product of the calibrated family probability and the pairwise coupling
within the family, between 0 and 1.

Edge cases: null text, or text without a letter, gives ``und`` with score 0; so does
everything if there is no labelled row; a single language is always predicted with score 1;
repeated rows each give a row; a null doc_id hashes as an empty one; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, prepare, slices, table, text_arrays

UNDETERMINED = "und"
PER_LANGUAGE, SAMPLE_ROWS, LEAST, TOGETHER = 800, 24_000, 40, 8
DIMENSIONS = 2048
#: Families of common language codes; an unlisted code is in the family ``other``.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "yi", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk", "be"),
    "uralic": ("fi", "et", "hu"),
    "indic": ("hi", "bn", "mr", "ne", "pa", "gu", "ur"),
    "turkic": ("tr", "az", "kk", "uz", "ky"),
    "semitic": ("ar", "he", "am", "mt"),
    "sinitic": ("zh", "yue"),
}


def family(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang in codes), "other")


#: Bytes that aren't part of a letter become a space; all bytes of other scripts stay.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32


def features(texts: pa.Array, dimensions: int = DIMENSIONS) -> np.ndarray:
    """One unit row for each text."""
    data, off = text_arrays(pc.utf8_lower(texts.fill_null("")))
    n = len(off) - 1
    counts = np.zeros((n, dimensions), np.float32)
    if len(data) == 0:
        return counts
    # a space between documents, so that no gram spans two of them
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(off) + 1)
    wide = np.full(len(data) + n, 32, np.uint8)
    at = np.arange(len(data)) + np.repeat(np.arange(n), np.diff(off))
    wide[at] = _FOLD[data]
    keep = np.concatenate(([True], (wide[1:] != 32) | (wide[:-1] != 32)))
    wide, doc = wide[keep].astype(np.uint32), doc[keep]
    base = doc * dimensions
    total = np.zeros(n * dimensions, np.int64)
    h = np.zeros(len(wide), np.uint32)
    for k in range(1, 5):
        if len(wide) < k:
            break
        h = h[: len(wide) - k + 1] * np.uint32(0x01000193) + wide[k - 1 :] + np.uint32(k)
        slot = (((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(16)) % np.uint32(dimensions)
        inside = doc[k - 1 :] == doc[: len(doc) - k + 1]
        total += np.bincount((base[: len(h)] + slot)[inside], minlength=n * dimensions)
    counts = np.sqrt(total.reshape(n, dimensions)).astype(np.float32)
    norm = np.linalg.norm(counts, axis=1, keepdims=True)
    return counts / np.where(norm > 0, norm, 1)


def has_letter(texts: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(texts.fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)


def train_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, steps: int = 150) -> tuple[np.ndarray, float, float]:
    """A linear SVM with squared hinge loss: weights, bias, slope of the score's logistic.

    Both classes weigh the same. Accelerated gradient descent; ``y`` is +1 or -1.
    """
    x = np.concatenate((x, np.ones((len(x), 1), x.dtype)), axis=1).astype(np.float32)
    y = y.astype(np.float32)
    cost = np.where(y > 0, len(y) / 2 / max(1, (y > 0).sum()), len(y) / 2 / max(1, (y < 0).sum())) * c / len(y)
    cost = cost.astype(np.float32)
    v = np.ones(x.shape[1], np.float32)
    for _ in range(15):
        v = x.T @ (cost * (x @ v))
        big = float(np.linalg.norm(v))
        v /= big or 1.0
    step, w, z, t = 1.0 / (1e-3 + 2 * big), np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32), 1.0
    for _ in range(steps):
        gap = np.maximum(0, 1 - y * (x @ z))
        nw = (z - step * (1e-3 * z - 2 * (x.T @ (cost * y * gap)))).astype(np.float32)
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z, w, t = (nw + (t - 1) / nt * (nw - w)).astype(np.float32), nw, nt
    margin, slope = (y * (x @ w)).astype(np.float64), 1.0
    for _ in range(25):  # Newton steps for the slope, with a weak pull to 4
        p = 1 / (1 + np.exp(np.clip(slope * margin, -30, 30)))
        slope -= (-(margin * p).mean() + 0.01 * (slope - 4)) / ((margin**2 * p * (1 - p)).mean() + 0.01)
        slope = min(max(slope, 0.5), 20.0)
    return w[:-1], float(w[-1]), slope


#: A fitted classifier: kind, the languages or family it tells apart, weights, bias and slope.
Fit = tuple[str, str, str, np.ndarray, float, float]


def fit_family(x: np.ndarray, of: np.ndarray, name: str) -> list[Fit]:
    """The classifier of a family against the rest; ``of`` are the rows' families."""
    return [("family", name, "", *train_svm(x, np.where(of == name, 1.0, -1.0)))]


def fit_pairs(x: np.ndarray, lang: np.ndarray, left: list[str], right: list[str]) -> list[Fit]:
    """A classifier for every pair of a language in ``left`` and a later one in ``right``."""
    out = []
    for a in left:
        for b in right:
            if a < b:
                rows = (lang == a) | (lang == b)
                out.append(("pair", a, b, *train_svm(x[rows], np.where(lang[rows] == a, 1.0, -1.0))))
    return out


def jobs_of(languages: list[str], together: int = TOGETHER) -> list[tuple[str, str, list[str], list[str]]]:
    """What is fitted at once: (kind, family, languages, languages)."""
    families = sorted({family(v) for v in languages})
    out = [("family", f, languages, []) for f in families] if len(families) > 1 else []
    for f in families:
        own = [v for v in languages if family(v) == f]
        parts = [own[i : i + together] for i in range(0, len(own), together)]
        out += [("pair", f, p, q) for i, p in enumerate(parts) for q in parts[i:] if len(p) > 1 or p is not q]
    return out


class Model:
    """Family classifiers and, in each family, one classifier for every pair of languages."""

    def __init__(self, languages: list[str], fits: list[Fit]):
        self.languages = sorted(languages)
        self.families = sorted({family(v) for v in self.languages})
        fits = sorted(fits, key=lambda f: f[:3])
        self.jobs = [(kind, a if kind == "family" else (a, b)) for kind, a, b, *_ in fits]
        self.w = np.stack([f[3] for f in fits], axis=1).astype(np.float32) if fits else None
        self.b, self.slope = (np.array([f[k] for f in fits]) for k in (4, 5))

    @classmethod
    def of(cls, x: np.ndarray, lang: list[str]) -> Model:
        """Fitted in this process."""
        y, languages = np.array(lang), sorted(set(lang))
        fits = []
        for kind, f, left, right in jobs_of(languages):
            fits += fit_family(x, np.array([family(v) for v in lang]), f) if kind == "family" else fit_pairs(x, y, left, right)
        return cls(languages, fits)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        n = len(x)
        if self.w is None:
            return [self.languages[0]] * n, np.ones(n)
        p = 1 / (1 + np.exp(np.clip(-self.slope * (x @ self.w + self.b), -30, 30)))
        if len(self.families) > 1:
            fam = p[:, [i for i, (kind, _) in enumerate(self.jobs) if kind == "family"]]
            fam = fam / fam.sum(axis=1, keepdims=True)
        else:
            fam = np.ones((n, 1))
        best = fam.argmax(axis=1)
        lang, score = np.empty(n, object), np.zeros(n)
        for f, name in enumerate(self.families):
            rows = best == f
            own = [v for v in self.languages if family(v) == name]
            each = np.zeros((int(rows.sum()), len(own)))
            for i, (kind, key) in enumerate(self.jobs):
                if kind == "pair" and key[0] in own:
                    each[:, own.index(key[0])] += p[rows, i]
                    each[:, own.index(key[1])] += 1 - p[rows, i]
            each = each / each.sum(axis=1, keepdims=True) if len(own) > 1 else np.ones_like(each)
            lang[rows] = np.array(own, object)[each.argmax(axis=1)]
            score[rows] = fam[rows, f] * each.max(axis=1)
        return lang.tolist(), np.clip(score, 0, 1)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(train: DataFrame, per_language: int = PER_LANGUAGE, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Learns from (doc_id, text, lang) rows with a label; the sample's size is bounded."""
    spark = train.sparkSession
    scratch = Scratch(spark, "langid")
    train = train.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r.lang: r.n for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    most = min(per_language, max(LEAST, sample_rows // len(counts)))
    share = F.create_map(*(F.lit(v) for lang, n in sorted(counts.items()) for v in (lang, min(1.0, most / n))))
    place = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("sample")), 11) / F.lit(float(1 << 53))
    chosen = train.where(place < F.try_element_at(share, F.col("lang")))

    def run(batches):
        for b in batches:
            for part in slices(b.select(["lang", "text"])):
                x = features(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([v.tobytes() for v in x], pa.binary())], ["lang", "x"])

    sample = scratch.save(chosen.select("lang", "text").mapInArrow(run, "lang string, x binary"), "sample")
    languages = sorted(r.lang for r in sample.select("lang").distinct().collect())
    if not languages:
        return None
    jobs = jobs_of(languages)
    wanted = [(v, i) for i, (_, _, left, right) in enumerate(jobs) for v in dict.fromkeys(left + right)]

    def fitted(t):
        kind, f, left, right = jobs[t.column("job")[0].as_py()]
        rows = sorted(zip(t.column("lang").to_pylist(), t.column("x").to_pylist()))
        lang = np.array([v for v, _ in rows])
        x = np.frombuffer(b"".join(v for _, v in rows), np.float32).reshape(len(rows), -1)
        fits = fit_family(x, np.array([family(v) for v in lang.tolist()]), f) if kind == "family" else fit_pairs(x, lang, left, right)
        return pa.table([pa.array(c) for c in zip(*((*k, w.astype(np.float32).tobytes(), b, slope) for *k, w, b, slope in fits))], ["kind", "a", "b", "w", "bias", "slope"])

    fits = []
    if wanted:
        needs = spark.createDataFrame(wanted, "lang string, job int")
        rows = sample.join(F.broadcast(needs), "lang").groupBy("job").applyInArrow(fitted, "kind string, a string, b string, w binary, bias double, slope double")
        fits = [(r.kind, r.a, r.b, np.frombuffer(r.w, np.float32), r.bias, r.slope) for r in rows.collect()]
    scratch.drop(sample)
    return Model(languages, fits)


def predict(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(*keep, lang_pred, score) of every row, from its text alone."""
    spark = docs.sparkSession
    prepare(spark)
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")

    def run(batches):
        for b in batches:
            for part in slices(b, "_text"):
                for at in range(0, part.num_rows, 256):
                    piece = part.slice(at, 256)
                    text = piece.column(piece.num_columns - 1)
                    letters = has_letter(text) if model is not None else np.zeros(piece.num_rows, bool)
                    lang, score = model.predict(features(text)) if letters.any() else ([UNDETERMINED] * piece.num_rows, np.zeros(piece.num_rows))
                    lang = [v if ok else UNDETERMINED for v, ok in zip(lang, letters)]
                    yield pa.RecordBatch.from_arrays([*piece.columns[:-1], pa.array(lang, pa.string()), pa.array(np.where(letters, score, 0.0))], names=schema.names)

    return docs.select(*keep, F.col("text").cast("string").alias("_text")).mapInArrow(run, schema)


def identify(docs: DataFrame, keep: tuple[str, ...], train=None) -> DataFrame:
    """Learns from the rows that aren't held out and predicts all."""
    return predict(docs, fit(docs.where(~held_out()) if train is None else train), keep)


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out())
    return identify(docs, ("doc_id", "held_out"))
