"""Personal data by patterns and a semi-Markov conditional random field.

Base spans (email, ip, card, phone) are found by patterns over the whole text and always
stay. Around every digit or ``@``, and every value that a key names as a secret, the
semi-Markov field then segments the words that base spans leave free: candidate segments of up to MAX_WORDS words are scored by features of the
whole span (shape, digits, check sum, octets, the words before), and bounded-entity dynamic
programming chooses boundaries and types jointly, ``O`` being a segment of one word. Found
segments are added as further spans; they can also be of the type ``secret``.

The field is trained by conditional likelihood (forward-backward over segments, numpy) on
silver labels - base spans, words that the patterns match by themselves, and assigned
secrets - in a bounded sample: the regions of about
SAMPLE_DOCS documents chosen by a hash of the id, cut between segments into pieces of up to
WINDOW words, at most MAX_REGIONS of them. Decoding runs over whole regions.

Words are taken whole whatever their length, and regions are decoded whole whatever theirs;
the work is linear in the text.

Edge cases: a null text is empty and has no spans; repeated rows each give a row; an empty
table gives none; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, table

KINDS = ("email", "ip", "card", "phone")
TYPES = ("O", "email", "ip", "card", "phone", "secret")
MAX_WORDS, WINDOW, NEAR = 4, 16, 3
SAMPLE_DOCS, MAX_REGIONS = 4000, 4000
SLOTS, WIDTH = 4096, 16
#: Words that are decoded at once, but for a single longer run.
DECODED = 8192

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]+")
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_SECRET = re.compile(r"(?i)\b(?:token|secret|api[_-]?key|password|passwd|pwd)\b[\x20\x09]*[=:][\x20\x09]*[\"']?([A-Za-z0-9+/_.-]{16,})")
#: Every secret matches this as well.
_KEY = re.compile(r"(?i)(?:token|secret|key|password|passwd|pwd)[\x20\x09]*[=:]")
_BLANK = " \t\n\v\f\r"
_TRIM = "\"'<>[]{},;:!?*#$%&|.=`"

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of local@domain, linear in the text: a match must
    take the whole run of local characters before an ``@`` (or what an earlier match left)."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and (c := text[start - 1]) < "\x7f" and (c.isalnum() or c in "._%+-"):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append((start, end, "email"))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[Span]:
    """Email, ip, card and phone spans by pattern, ordered by start, then kind."""
    out = _emails(text)
    out += [(*m.span(), "ip") for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((*m.span(), "card"))
    if "+" in text:
        out += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def silver_spans(text: str) -> list[Span]:
    return base_spans(text) + [(*m.span(1), "secret") for m in _SECRET.finditer(text)]


def triggers(text: str) -> list[int]:
    """Places of digits, ``@`` and secrets' values: the words there are what the field is for."""
    out = [m.start() for m in _TRIGGER.finditer(text)]
    if "=" in text or ":" in text:
        out = sorted(out + [m.start(1) for m in _SECRET.finditer(text)])
    return out


def areas(text: str) -> list[tuple[list[tuple[int, int]], list[int]]]:
    """Runs of whole consecutive words, up to NEAR on each side of every triggering one, and the
    numbers of these in the run."""
    out: list[tuple[list[tuple[int, int]], list[int]]] = []
    run: list[tuple[int, int]] = []
    hits: list[int] = []
    floor = 0

    def back(at: int, blank: bool) -> int:
        while at > floor and (text[at - 1] in _BLANK) == blank:
            at -= 1
        return at

    for at in triggers(text):
        if at < floor:  # in a word that the run has
            k = len(run) - 1
            while run[k][0] > at:
                k -= 1
            if not hits or hits[-1] != k:
                hits.append(k)
        else:
            begin = back(at, False)
            before = [(begin, _WORDS.match(text, begin).end())]
            edge = back(begin, True)
            while len(before) <= NEAR and edge > floor:
                before.append((back(edge, False), edge))
                edge = back(before[-1][0], True)
            if run and edge > floor:
                out.append((run, hits))
                run, hits = [], []
            run += before[::-1]
            hits.append(len(run) - 1)
        while len(run) <= hits[-1] + NEAR:
            m = _WORDS.search(text, run[-1][1])
            if m is None:
                break
            run.append(m.span())
        floor = run[-1][1]
    if run:
        out.append((run, hits))
    return out


def regions(text: str) -> list[list[tuple[int, int]]]:
    return [words for words, _ in areas(text)]


def blocks(gold: np.ndarray) -> list[tuple[int, int]]:
    """Cuts a run for training into pieces of at most WINDOW words, none inside a silver segment."""
    out, low = [], 0
    while low < len(gold):
        high = min(len(gold), low + WINDOW)
        while high < len(gold) and gold[high, 0] == 0:
            high -= 1
        out.append((low, high))
        low = high
    return out


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in _TRIM:
        start += 1
    while end > start and text[end - 1] in _TRIM:
        end -= 1
    return start, end


_SHAPES = ((re.compile("[0-9]+"), "9"), (re.compile("[a-z]+"), "a"), (re.compile("[A-Z]+"), "A"), (re.compile(r"[^\x00-\x7f]+"), "u"))


def span_features(text: str, words: list[tuple[int, int]], i: int, n: int) -> list[int]:
    """Slots of the features of words i..i+n-1 taken as one span."""
    start, end = trimmed(text, words[i][0], words[i + n - 1][1])
    s = text[start:end]
    digits = [c for c in s if "0" <= c <= "9"]
    d = len(digits)
    shape = s
    for pattern, to in _SHAPES:
        shape = pattern.sub(to, shape)
    parts = s.split(".")
    size = len(s)
    before = text[words[i - 1][0] : words[i - 1][1]].lower() if i else "^"
    before2 = text[words[i - 2][0] : words[i - 2][1]].lower() if i > 1 else "^"
    f = [f"n{n}", f"s{shape}", f"d{d if d < 20 else 20}", f"l{min(size // 4, 12)}", f"r{4 * d // size if size else 9}", f"n{n}h{bool(d)}", f"a{s.count('@')}.{s.rpartition('@')[2].count('.') if '@' in s else '-'}"]
    f.append("o%d" % (len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)))
    if 12 <= d <= 19:
        f.append("c%d%d" % (luhn("".join(digits)), d + s.count(" ") + s.count("-") == size))
    if size >= 16:
        f.append("x%d" % all(c in "0123456789abcdefABCDEF" for c in s))
    if before in ("=", ":") or before2 in ("token", "key", "secret", "password"):
        f.append(f"k{before}|{before2}")
    f.append("p%d%d" % (s[:1] == "+", s[:1] == "("))
    if size == 0:
        f.append("none")
    inner = [text[a:b] for a, b in words[i : i + n]]
    f.append("e%d" % sum(not any("0" <= c <= "9" or c == "@" for c in w) for w in inner))
    return [zlib.crc32(x.encode()) % (SLOTS - 1) + 1 for x in f[:WIDTH]]


def lattice(text: str, words: list[tuple[int, int]]) -> np.ndarray:
    """Feature slots [word, length - 1, WIDTH]; slot 0 is empty and weighs nothing."""
    out = np.zeros((len(words), MAX_WORDS, WIDTH), np.int16)
    for i in range(len(words)):
        for n in range(1, min(MAX_WORDS, len(words) - i) + 1):
            f = span_features(text, words, i, n)
            out[i, n - 1, : len(f)] = f
    return out


class Field:
    """Weights of span features by type, and of a type after a type."""

    def __init__(self):
        self.w = np.zeros((SLOTS, len(TYPES)), np.float32)
        self.a = np.zeros((len(TYPES), len(TYPES)), np.float32)

    def scores(self, slots: np.ndarray, free: np.ndarray) -> np.ndarray:
        """Scores [region, word, length, type]; what a segment can't be is minus infinity."""
        s = np.zeros((*slots.shape[:3], len(TYPES)))
        for k in range(WIDTH):
            s += self.w[slots[..., k]]
        s[:, :, 1:, 0] = -np.inf
        s[:, :, :, 1:][~free] = -np.inf
        return s

    def best(self, slots: np.ndarray, size: np.ndarray, free: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """The best segmentation of each region: (word, length, type) of its entities."""
        s = self.scores(slots, free)
        r, longest, t = len(s), s.shape[1], len(TYPES)
        top = np.full((r, longest + 1, t), -np.inf)
        back = np.zeros((r, longest + 1, t, 2), np.int8)
        top[:, 0, 0] = 0
        for j in range(1, longest + 1):
            for n in range(1, min(MAX_WORDS, j) + 1):
                via = top[:, j - n, :, None] + self.a[None]
                prev = via.argmax(axis=1)
                got = np.take_along_axis(via, prev[:, None], 1)[:, 0] + s[:, j - n, n - 1]
                better = got > top[:, j]
                top[:, j][better] = got[better]
                back[:, j, :, 0][better] = n
                back[:, j, :, 1][better] = prev[better]
        out = []
        for k in range(r):
            j, y, found = int(size[k]), int(top[k, size[k]].argmax()), []
            while j > 0:
                n, prev = back[k, j, y]
                if y:
                    found.append((j - int(n), int(n), y))
                j, y = j - int(n), int(prev)
            out.append(found[::-1])
        return out

    def fit(self, slots: np.ndarray, size: np.ndarray, free: np.ndarray, gold: np.ndarray, steps: int = 60, rate: float = 0.3) -> None:
        """Conditional likelihood by AdaGrad; gold[region, word] is (length, type) or (0, 0) inside a segment."""
        r, t = len(slots), len(TYPES)
        starts = np.nonzero(gold[:, :, 0])
        n, y = gold[starts][:, 0], gold[starts][:, 1]
        real = np.arange(WINDOW)[None, :, None] + np.arange(1, MAX_WORDS + 1)[None, None, :] <= size[:, None, None]
        want_w, want_a = np.zeros_like(self.w, np.float64), np.zeros((t, t))
        np.add.at(want_w, (slots[starts[0], starts[1], n - 1].astype(int).ravel(), np.repeat(y, WIDTH)), 1)
        for k in range(r):
            seq = [0, *(int(v) for v, m in zip(gold[k, :, 1], gold[k, :, 0]) if m)]
            np.add.at(want_a, (seq[:-1], seq[1:]), 1)
        sum_w, sum_a = np.full_like(self.w, 1e-6), np.full((t, t), 1e-6)

        def lse(x, axis):
            m = x.max(axis=axis, keepdims=True)
            m[~np.isfinite(m)] = 0
            with np.errstate(divide="ignore"):
                return np.log(np.exp(x - m).sum(axis=axis)) + np.squeeze(m, axis)

        for _ in range(steps):
            s = self.scores(slots, free)
            s[~real] = -np.inf
            fw, bw = np.full((r, WINDOW + 1, t), -np.inf), np.full((r, WINDOW + 1, t), -np.inf)
            fw[:, 0, 0] = 0
            for j in range(1, WINDOW + 1):
                fw[:, j] = lse(np.stack([lse(fw[:, j - m, :, None] + self.a[None], 1) + s[:, j - m, m - 1] for m in range(1, min(MAX_WORDS, j) + 1)]), 0)
            bw[np.arange(r), size] = 0
            for j in range(WINDOW - 1, -1, -1):
                step = lse(np.stack([s[:, j, m - 1] + bw[:, j + m] for m in range(1, min(MAX_WORDS, WINDOW - j) + 1)]), 0)
                here = lse(self.a[None] + step[:, None, :], 2)
                bw[:, j] = np.where((size > j)[:, None], here, bw[:, j])
            z = lse(fw[np.arange(r), size], 1)
            got_w, got_a = np.zeros_like(want_w), np.zeros((t, t))
            for j in range(WINDOW):
                for m in range(1, min(MAX_WORDS, WINDOW - j) + 1):
                    after = s[:, j, m - 1] + bw[:, j + m] - z[:, None]
                    p = np.exp(np.minimum(fw[:, j, :, None] + self.a[None] + after[:, None, :], 0))
                    got_a += p.sum(axis=0)
                    q = p.sum(axis=1)
                    for c in range(1, t) if m > 1 else range(t):
                        got_w[:, c] += np.bincount(slots[:, j, m - 1].ravel().astype(int), np.repeat(q[:, c], WIDTH), SLOTS)
            gw, ga = want_w - got_w - 0.02 * self.w, want_a - got_a - 0.02 * self.a
            gw[0] = 0
            sum_w += gw**2
            sum_a += ga**2
            self.w += (rate * gw / np.sqrt(sum_w)).astype(np.float32)
            self.a += (rate * ga / np.sqrt(sum_a)).astype(np.float32)


def _free(words: list[tuple[int, int]], taken: list[Span]) -> np.ndarray:
    """Whether words i..i+n-1 touch no span of ``taken``."""
    out = np.ones((len(words), MAX_WORDS), bool)
    starts, ends = [a for a, _ in words], [b for _, b in words]
    for s, e, _ in taken:  # the words that the span touches are low..high-1
        low, high = bisect.bisect_right(ends, s), bisect.bisect_left(starts, e)
        for n in range(1, MAX_WORDS + 1):
            out[max(0, low - n + 1) : high, n - 1] = False
    for n in range(2, MAX_WORDS + 1):
        out[max(0, len(words) - n + 1) :, n - 1] = False
    return out


def _gold(text: str, words: list[tuple[int, int]], spans: list[Span]) -> np.ndarray:
    """(length, type) at the first word of each silver segment; other words are O."""
    out, known, i = np.zeros((len(words), 2), np.int8), {}, 0
    for a, b, k in spans:
        known.setdefault(a, []).append((b, TYPES.index(k)))
    while i < len(words):
        for n in range(min(MAX_WORDS, len(words) - i), 0, -1):
            a, b = trimmed(text, words[i][0], words[i + n - 1][1])
            y = next((y for x in (a, a + 1) for e, y in known.get(x, ()) if x < e <= b and b - e <= 1), 0)
            if not y:  # a span by itself, which its neighbours hide from the patterns
                alone = base_spans(text[a:b])
                y = TYPES.index(alone[0][2]) if len(alone) == 1 and alone[0][:2] == (0, b - a) else 0
            if y or n == 1:
                out[i] = n, y
                i += n
                break
    return out


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, max_regions: int = MAX_REGIONS) -> Field:
    """Trains on the regions of a bounded sample of documents."""
    prepare(docs.sparkSession)
    field, total = Field(), docs.count()
    if total == 0:
        return field
    place = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("pii")), 11) / F.lit(float(1 << 53))
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text")).where((place < min(1.0, sample_docs / total)) & F.col("text").rlike(f"[0-9@]|{_KEY.pattern}"))

    def run(batches):
        for b in batches:
            for text in b.column(0).to_pylist():
                spans = silver_spans(text)
                for words in regions(text):
                    x, gold = lattice(text, words), _gold(text, words, spans)
                    for a, b in blocks(gold):
                        fill = lambda v: np.concatenate((v, np.zeros((WINDOW - len(v), *v.shape[1:]), v.dtype)))
                        part = fill(_free(words[a:b], [])), fill(gold[a:b])
                        own = x[a:b].copy()
                        own[~part[0][: b - a]] = 0  # a segment over the piece's end
                        yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (fill(own), *part)] + [pa.array([b - a], pa.int32())], ["x", "free", "gold", "n"])

    rows = chosen.select("text").mapInArrow(run, "x binary, free binary, gold binary, n int").orderBy(F.xxhash64("x", "gold")).limit(max_regions).collect()
    if rows:
        read = lambda c, kind, *shape: np.frombuffer(b"".join(r[c] for r in rows), kind).reshape(len(rows), *shape)
        field.fit(read("x", np.int16, WINDOW, MAX_WORDS, WIDTH), np.array([r.n for r in rows]), read("free", bool, WINDOW, MAX_WORDS), read("gold", np.int8, WINDOW, 2))
    return field


def added_spans(texts: list[str], bases: list[list[Span]], field: Field) -> list[list[Span]]:
    """Spans that the field adds to the base spans of each text."""
    out: list[list[Span]] = [[] for _ in texts]
    jobs = []
    for k, (text, taken) in enumerate(zip(texts, bases)):
        near, at = [], 0
        for words, hits in areas(text):
            while at < len(taken) and taken[at][0] < words[-1][1]:
                near.append(taken[at])
                at += 1
            near = [s for s in near if words[0][0] < s[1]]
            free = _free(words, near)
            if any(free[i, 0] for i in hits):
                jobs.append((k, words, free))
    jobs.sort(key=lambda job: len(job[1]))
    at = 0
    while at < len(jobs):
        part = jobs[at : at + 256]
        while len(part) > 1 and len(part) * len(part[-1][1]) > DECODED:  # padded to the longest
            part = part[: max(1, DECODED // len(part[-1][1]))]
        at += len(part)
        longest = len(part[-1][1])
        fill = lambda v: np.concatenate((v, np.zeros((longest - len(v), *v.shape[1:]), v.dtype)))  # noqa: E731,B023
        slots = np.stack([fill(lattice(texts[k], words)) for k, words, _ in part])
        for (k, words, _), found in zip(part, field.best(slots, np.array([len(w) for _, w, _ in part]), np.stack([fill(f) for _, _, f in part]))):
            for i, n, y in found:
                a, b = trimmed(texts[k], words[i][0], words[i + n - 1][1])
                if a < b:
                    out[k].append((a, b, TYPES[y]))
    return out


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def all_spans(base: list[Span], added: list[Span]) -> list[Span]:
    return sorted(base + added, key=lambda s: (s[0], TYPES.index(s[2]), s[1]))


def find(docs: DataFrame, field: Field, keep: tuple[str, ...] = ("doc_id",), redact: bool = False) -> DataFrame:
    """Spans of every whole text: (*keep, n_email, n_ip, n_card, n_phone, base_sha256, spans).

    With ``redact``: (*keep, text) with every span replaced by its kind in brackets.
    """
    spark = docs.sparkSession
    prepare(spark)
    schema = docs.select(*keep).schema
    schema = schema.add("text", "string") if redact else schema.add("n_email", "long").add("n_ip", "long").add("n_card", "long").add("n_phone", "long").add("base_sha256", "string").add("spans", "string")

    def run(batches):
        for b in batches:
            texts = b.column(b.num_columns - 1).to_pylist()
            full = [t or "" for t in texts]
            seen = [bool(t) and (_TRIGGER.search(t) is not None or _KEY.search(t) is not None) for t in full]
            bases = [base_spans(t) if s else [] for t, s in zip(full, seen)]
            at = [i for i, s in enumerate(seen) if s]
            added = dict(zip(at, added_spans([full[i] for i in at], [bases[i] for i in at], field)))
            spans = [all_spans(base, added.get(i, [])) for i, base in enumerate(bases)]
            if redact:
                cols = [pa.array([redacted(t, s) if s else t for t, s in zip(texts, spans)], pa.string())]
            else:
                cols = [pa.array([sum(s[2] == k for s in base) for base in bases], pa.int64()) for k in KINDS]
                cols += [pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base in bases]), pa.array([_joined(s) for s in spans])]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *cols], names=schema.names)

    return docs.select(*keep, F.col("text").cast("string").alias("_text")).mapInArrow(run, schema)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with spans replaced by [KIND]; overlapping spans by the first one's kind."""
    out, end = [], 0
    for a, b, kind in spans:
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def op1_pii(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return find(docs, fit(docs))


def pii_base_spans(spark, sf_dir: str) -> DataFrame:
    """What op1_pii returns of the base spans, which SQL can express."""
    return op1_pii(spark, sf_dir).drop("spans")


def _sql_kind(kind: str, pattern: str, good: str, rank: int) -> str:
    """Matches m of one pattern with their places: all pieces between them tell the starts."""
    return f"""select doc_id, '{kind}' as kind, {rank} as rank, m, s from (
      select doc_id, unnest(ms) as m, unnest(list_transform(range(1, len(ms) + 1), lambda i: list_sum(list_transform(ps[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda p: length(p))), 0))) as s
      from (select doc_id, regexp_extract_all(t, '{pattern}') as ms, string_split_regex(t, '{pattern}') as ps from d) where len(ms) > 0) where {good}"""


_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
ORACLE = f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
b as ({_sql_kind('email', r'[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+', 'true', 0)}
  union all {_sql_kind('ip', r'[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)', "list_max(list_transform(string_split(m, '.'), lambda p: p::hugeint)) <= 255", 1)}
  union all {_sql_kind('card', r'[0-9](?:[\x20-]?[0-9])+', f"length({_DIGITS}) between 12 and 19 and list_sum(list_transform(range(0, length({_DIGITS})), lambda i: case when i % 2 = 0 then reverse({_DIGITS})[i + 1]::int else 2 * reverse({_DIGITS})[i + 1]::int - case when reverse({_DIGITS})[i + 1]::int > 4 then 9 else 0 end end)) % 10 = 0", 2)}
  union all {_sql_kind('phone', r'\+[0-9][\x20().0-9-]+[0-9]', f"length({_DIGITS}) between 9 and 15", 3)}),
g as (select doc_id, count(*) filter (where kind = 'email') as n_email, count(*) filter (where kind = 'ip') as n_ip, count(*) filter (where kind = 'card') as n_card, count(*) filter (where kind = 'phone') as n_phone,
        string_agg(kind || ':' || s::bigint || ':' || (s + length(m))::bigint, ',' order by s, rank) as spans from b group by doc_id)
select d.doc_id, coalesce(n_email, 0) as n_email, coalesce(n_ip, 0) as n_ip, coalesce(n_card, 0) as n_card, coalesce(n_phone, 0) as n_phone, sha256(coalesce(spans, '')) as base_sha256
from d left join g using (doc_id)
"""
