"""Small documents that hold the cases every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, size=40):
    return " ".join(rng.choice(["the", "of", "and", *("w%d" % k for k in range(size))]) for _ in range(n))


def documents(seed=1):
    """Null, empty, blank and very long texts, copies, near copies, shared passages, repeated rows."""
    rng = random.Random(seed)
    passage, line = words(rng, 40, 400), "This is one common line of exactly the same words in many documents, again and again and again and again."
    out = [(0, None, "en", None, 0), (1, "", None, "s1", 0), (2, " \t\n ", "en", "s1", 4), (3, "!!! 123 ...", "en", "s2", 11), (4, "word", "en", "s2", 4), (5, "a" * 5000, "en", "s2", 5000)]
    for i in range(6, 40):
        text = words(rng, rng.choice([3, 12, 13, 14, 60, 200]), 400)
        if i % 5 == 0:
            text += " " + passage + " " + words(rng, 5, 400)
        if i % 4 == 0:
            text = line + "\n" + text
        out.append((i, text, "en", f"s{i % 3}", len(text)))
    out += [(i + 100, t, lang, s, n) for i, t, lang, s, n in out[10:16]]  # exact copies
    out += [(200, out[20][1].replace("the", "The", 1) if out[20][1] else "", "en", "s1", 9), (201, words(rng, 6000, 400), "en", "hot", 1), (202, "é" * 300 + " ü " * 60, "fr", "hot", 2)]
    out += [out[12], out[12], (None, "no id but words enough to make a window of thirteen words in all", "en", "s1", 3)]
    return out


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)


def save(spark, tmp_path, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
