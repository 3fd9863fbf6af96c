"""Language-model scoring by deleted interpolation.

Tokens are the words of a text, A-Z lower-cased, and one end. The model mixes the maximum
likelihood estimates of a token after its predecessor, of the token alone, and of any of the
V + 1 tokens. The mixture weights depend on how often the predecessor was seen (a bucket per
power of two) and are learned by expectation-maximisation on held-out counts: a seventh of
the training documents is held out, its counts are deleted from the estimates, and the
weights maximise its likelihood. For scoring, all training counts are used.

Counts cover all training documents. They travel by the packed exchange: each block of
documents sends its distinct tokens and pairs, and gets the corpus counts of these back; so
a common word costs one entry a block. EM works on a table of bounded size: the held-out
tokens by context bucket and by both estimates, in cells of STEP decimal digits down to LOWEST,
below one in 1e20 tokens; the tokens of a cell count with their mean log estimates (summed in
millionths, so that reruns agree). Only learning sees the cells, scoring doesn't; a test holds
the learned weights against those from exact estimates.

Tokens are told apart by 64 bits of hash. Edge cases: null and empty texts are one end
token; repeated rows count and are scored each; a null doc_id hashes as an empty one; without
training text every token has the estimate 1 / (V + 1), which is 1 as V is 0; an empty table
gives none; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Scratch, mix64, real_id, table
from .exchange import Block, gather, n_buckets, pack, route, whole
from .suffix_tree import word_places

END, BEGIN = np.uint64(0x1F0E2D3C4B5A6978), np.uint64(0x8796A5B4C3D2E1F1)
FOLDS, HELD_OUT, DELETED = 7, 2, 3
BUCKETS, STEP, LOWEST = 24, 0.1, -20.0
#: Text of a block; a task holds a block's tokens and pairs, and a bucket's, as numbers.
BLOCK_BYTES = 4 << 20
#: Bytes of text that are hashed at once.
SLICE_BYTES = 1 << 20
#: Flags of documents in blocks.
TRAIN, FOLD, TEST = 0, 1, 2


def tokens(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and predecessor's hash of every token, and n+1 bounds by document."""
    starts, _, h, of = word_places(LOWER[block.data], block.off, SLICE_BYTES)
    per = np.diff(of) + 1
    bounds = np.concatenate(([0], np.cumsum(per)))
    out = np.empty(bounds[-1], np.uint64)
    out[bounds[1:] - 1] = END
    is_word = np.ones(bounds[-1], bool)
    is_word[bounds[1:] - 1] = False
    out[is_word] = h
    before = np.empty_like(out)
    before[1:] = out[:-1]
    before[bounds[:-1]] = BEGIN
    return out, before, bounds


def pairs(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(before * np.uint64(0x9E3779B97F4A7C15) + token)


def _counted(keys: np.ndarray, flag: np.ndarray):
    u, inv = np.unique(keys, return_inverse=True)
    return u, [np.bincount(inv[flag != TEST], minlength=len(u)).astype(np.uint32), np.bincount(inv[flag == FOLD], minlength=len(u)).astype(np.uint32)]


def _emit(block: Block, _replies=None):
    token, before, bounds = tokens(block)
    flag = np.repeat(block.flags, np.diff(bounds))
    return [_counted(mix64(token), flag), _counted(pairs(before, token), flag)]


def _combine(stream: int, group: np.ndarray, values: list[np.ndarray], size: np.ndarray) -> list[np.ndarray]:
    n = int(group.max()) + 1 if len(group) else 0
    out = [np.bincount(group, v, n) for v in values]
    return [x.astype(np.uint32) if len(x) == 0 or x.max() < 2**32 else x.astype(np.int64) for x in out]


def _totals(stream: int, keys: np.ndarray, out: list[np.ndarray]) -> list[int]:
    seen, fold = out
    if stream:
        return [0, 0, 0, 0, 0]
    end = keys == mix64(np.array([END]))[0]
    return [seen.sum(dtype=np.int64), np.count_nonzero(seen), fold.sum(dtype=np.int64), seen[end].sum(dtype=np.int64), fold[end].sum(dtype=np.int64)]


def bucket(count: np.ndarray) -> np.ndarray:
    """The bucket of a context's frequency: 0 if unseen, else one per power of two."""
    return np.minimum(np.ceil(np.log2(count + 1.0)), BUCKETS - 1).astype(np.int64)


def _context(token: np.ndarray, single: np.ndarray, bounds: np.ndarray, docs: int) -> np.ndarray:
    """How often each token's predecessor was seen as one; a text's first has the begin."""
    out = np.empty(len(token), np.float64)
    out[1:] = single[:-1]
    out[bounds[:-1]] = docs
    return out


def _estimates(block: Block, arrays: list[np.ndarray], docs: int, fold_docs: int):
    token, before, bounds = tokens(block)
    _, one = np.unique(mix64(token), return_inverse=True)
    _, two = np.unique(pairs(before, token), return_inverse=True)
    single, single_fold, pair, pair_fold = arrays[0][one].astype(np.float64), arrays[1][one].astype(np.float64), arrays[2][two].astype(np.float64), arrays[3][two].astype(np.float64)
    return bounds, single, single_fold, pair, pair_fold, _context(token, single, bounds, docs), _context(token, single_fold, bounds, fold_docs)


def cells(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each estimate, 0 if it is zero, and its logarithm in millionths."""
    log = np.log10(np.where(f > 0, f, 1.0))
    return np.where(f > 0, np.maximum(1, np.rint((log - LOWEST) / STEP) + 1), 0).astype(np.int64), np.rint(log * 1e6).astype(np.int64)


def learn(table: list[tuple[int, float, float, int]], unseen: float, steps: int = 200) -> np.ndarray:
    """EM over (bucket, pair estimate, single estimate, n): weights [bucket, 3] of pair, single, uniform.

    Buckets without held-out tokens take the nearest one's weights.
    """
    w = np.tile(np.array([0.4, 0.5, 0.1]), (BUCKETS, 1))
    w[0] = [0, 0.9, 0.1]
    if not table:
        return w
    b, f2, f1, n = (np.array(x, np.float64 if k else np.int64) for k, x in enumerate(zip(*table)))
    p = np.stack([f2, f1, np.full(len(b), unseen)], axis=1)
    for _ in range(steps):
        share = w[b] * p
        share *= (n / share.sum(axis=1))[:, None]
        new = np.stack([np.bincount(b, share[:, k], BUCKETS) for k in range(3)], axis=1) + 1e-3
        w = new / new.sum(axis=1, keepdims=True)
    seen = np.flatnonzero(np.bincount(b, minlength=BUCKETS))
    for k in range(1, BUCKETS):
        if k not in seen and len(seen[seen > 0]):
            w[k] = w[min(seen[seen > 0], key=lambda s: (abs(s - k), s))]
    w[0, 0] = 0
    w[0] /= w[0].sum()
    return w


def score(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = scratch.spark
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    flag = F.when(fold == HELD_OUT, TEST).when(fold == DELETED, FOLD).otherwise(TRAIN)
    blocks = pack(docs, scratch, flag, F.when(fold == DELETED, 1).otherwise(0), BLOCK_BYTES)
    back, found = route(blocks, scratch, _emit, _combine, _totals, n_buckets(blocks.count()))
    n, v, n_fold, n_docs, fold_docs = (found[:5] or [0, 0, 0, 0, 0])

    def held_out_counts(_, block, replies):
        arrays = whole(replies[0], [np.uint32] * 4)
        bounds, single, single_fold, pair, pair_fold, context, context_fold = _estimates(block, arrays, n_docs, fold_docs)
        rest = context - context_fold
        with np.errstate(divide="ignore", invalid="ignore"):
            f2 = np.where(rest > 0, (pair - pair_fold) / rest, 0)
            f1 = (single - single_fold) / max(1, n - n_fold)
        (c2, l2), (c1, l1) = cells(f2), cells(f1)
        u, first, c = np.unique((bucket(rest) * 256 + c2) * 256 + c1, return_inverse=True, return_counts=True)
        add = lambda x: np.bincount(first, x, len(u)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(c), pa.array(add(l2)), pa.array(add(l1))], ["key", "n", "l2", "l1"])

    held = blocks.where("cls = 1")
    own = back.join(F.broadcast(held.select("block")) if held.count() < 100_000 else held.select("block"), "block", "left_semi")
    counts = gather(held, [own], scratch, held_out_counts, "key long, n long, l2 long, l1 long").groupBy("key").agg(*(F.sum(c).alias(c) for c in ("n", "l2", "l1")))
    mean = lambda cell, log, n: 10 ** (log / n / 1e6) if cell else 0.0
    weights = learn([(r.key >> 16, mean(r.key >> 8 & 255, r.l2, r.n), mean(r.key & 255, r.l1, r.n), r.n) for r in counts.orderBy("key").collect()], 1 / (v + 1))
    if n == 0:
        weights[:] = [0, 0, 1]

    def scored(_, block, replies):
        arrays = whole(replies[0], [np.uint32] * 4)
        bounds, single, _, pair, _, context, _ = _estimates(block, arrays, n_docs, fold_docs)
        w = weights[bucket(context)]
        with np.errstate(divide="ignore", invalid="ignore"):
            p = w[:, 0] * np.where(context > 0, pair / np.maximum(context, 1), 0) + w[:, 1] * single / max(1, n) + w[:, 2] / (v + 1)
        base = np.log10((single + 1) / (n + v + 1))
        add = lambda x: np.add.reduceat(x, bounds[:-1])
        cols = [pa.array(block.ids), pa.array(block.flags == TEST), pa.array(np.diff(bounds)), pa.array(add((single > 0).astype(np.int64))), pa.array(np.full(len(block.ids), n, np.int64)), pa.array(add(base)), pa.array(add(np.log10(p)))]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    out = gather(blocks, [back], scratch, scored, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumn("doc_id", real_id("doc_id"))


def op10_ngram_score(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), Scratch(spark, "op10"))


def ngram_base_score(spark, sf_dir: str) -> DataFrame:
    """What op10_ngram_score returns beside the model's score, which SQL can express."""
    return op10_ngram_score(spark, sf_dir).drop("score").withColumn("base_score", F.round("base_score", 6))


_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"""
ORACLE = rf"""
with d as (select doc_id, {_CRC} % 7 = 2 as held_out, list_append(list_transform(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'),
    lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')), ' ') as w from documents),
t as (select doc_id, held_out, unnest(w) as w from d),
c as (select w, count(*) as c from t where not held_out group by w),
s as (select coalesce(sum(c), 0)::bigint as n, count(*) as v from c)
select doc_id, any_value(held_out) as held_out, count(*) as n_tokens, count(c.c) as n_known, any_value(n) as train_tokens, round(sum(log10((coalesce(c.c, 0) + 1) / (n + v + 1))), 6) as base_score
from t left join c using (w), s group by doc_id
"""
