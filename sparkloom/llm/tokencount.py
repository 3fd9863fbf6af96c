"""Token counts from an exact length histogram.

Every whole text is encoded with a public byte-pair vocabulary (path a parameter) and
only its length is kept. Documents are aggregated by encoded length; suffix sums over the
histogram then answer, for every context limit that occurs as a length, how many documents
reach it, how many tokens there are, and how many remain if texts are cut at it. Quantiles
come from the same table.

The suffix sums are made in two levels, over blocks of BLOCK lengths, so that no task gets
more than one block or the list of blocks.

Edge cases: null and empty texts have length 0 and are counted; an empty table gives an
empty histogram; repeated rows count each time; extra columns are ignored.
"""

from __future__ import annotations

import base64
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Scratch, prepare, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's texts are split before merging (fixed by the public tokenizer).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK = 64

_LOADED: dict[str, object] = {}


def encoder(content: bytes, pattern: str = PATTERN):
    import hashlib

    key = hashlib.sha256(content + pattern.encode()).hexdigest()
    if key not in _LOADED:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        _LOADED[key] = tiktoken.Encoding(f"vocabulary-{key[:8]}", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[key]


def token_lengths(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, n_tokens) of every row. The vocabulary file (under a few MB) goes to each task."""
    prepare(docs.sparkSession)
    if os.path.getsize(vocabulary) > 64 << 20:
        raise ValueError("a vocabulary file of over 64 MB isn't sent to the tasks")
    with open(vocabulary, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        e = encoder(sent.value, pattern)
        for b in batches:
            n = np.fromiter((len(e.encode_ordinary(x)) if x else 0 for x in (v.as_py() for v in b.column(1))), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n)], ["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame, scratch: Scratch) -> DataFrame:
    """Per distinct length: documents and tokens at it, at or above it, and totals cut at it."""
    h = scratch.save(lengths.groupBy(F.col("n_tokens").alias("length")).agg(F.count("*").alias("n_docs")), "histogram")  # read twice
    h = h.withColumn("n_tokens", F.col("length") * F.col("n_docs")).withColumn("_b", F.floor(F.col("length") / BLOCK))
    blocks = h.groupBy("_b").agg(F.sum("n_docs").alias("_d"), F.sum("n_tokens").alias("_t"))
    above = W.partitionBy(F.lit(0)).orderBy(F.col("_b").desc()).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(F.lit(0))
    blocks = blocks.select("_b", F.coalesce(F.sum("_d").over(above), F.lit(0)).alias("_da"), F.coalesce(F.sum("_t").over(above), F.lit(0)).alias("_ta"), F.sum("_d").over(whole).alias("_dn"), F.sum("_t").over(whole).alias("_tn"))
    inside = W.partitionBy("_b").orderBy(F.col("length").desc()).rowsBetween(W.unboundedPreceding, 0)
    h = h.withColumn("_di", F.sum("n_docs").over(inside)).withColumn("_ti", F.sum("n_tokens").over(inside)).join(blocks, "_b")
    docs_ge, tokens_ge = F.col("_di") + F.col("_da"), F.col("_ti") + F.col("_ta")
    return h.select(
        "length", "n_docs", "n_tokens", docs_ge.alias("docs_at_least"), tokens_ge.alias("tokens_at_least"),
        (F.col("_tn") - tokens_ge + docs_ge * F.col("length")).alias("tokens_cut_at"),
        ((F.col("_dn") - docs_ge + F.col("n_docs")) / F.col("_dn")).alias("quantile"),
        F.col("_dn").alias("total_docs"), F.col("_tn").alias("total_tokens"),
    )


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    return length_histogram(token_lengths(table(spark, sf_dir, "documents")), Scratch(spark, "op7"))
