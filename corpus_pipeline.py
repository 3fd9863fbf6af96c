"""A corpus pipeline of five stages over ``documents``; each calls one operator of sparkloom.llm.

1. language_id: rows whose text has no determined language go (null or letterless text).
2. near_dedup: documents whose sets of 5-word shingles have a similarity of 0.8 or more are linked;
   one document of each group of linked ones stays, the smallest doc_id.
3. decontaminate: documents that hold an item of ``benchmark`` go.
4. pii: personal data is replaced by its kind in brackets; n_chars follows the text.
5. mix: documents get their training position and the words that the mix takes; columns of
   these names in the input give way. Rows are sorted by position.

Stages take and return any extra columns. Repeated rows: see the operators' modules; empty
tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import decontaminate, langid, mixing, pii, similar
from sparkloom.llm.common import Scratch, scope, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs.where(~langid.held_out()))
    if model is None:  # no labelled row to learn from
        return docs.where(F.col("text").cast("string").rlike(r"\p{L}"))
    rows = langid.predict(docs.select(F.struct(*docs.columns).alias("_row"), "text"), model, ("_row",))
    return rows.where(F.col("lang_pred") != langid.UNDETERMINED).select("_row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similar.one_of_each(docs, Scratch(spark, "near_dedup"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = pii.find(docs.select(F.struct(*docs.columns).alias("_row"), "text"), pii.fit(docs), ("_row",), redact=True)
    new = {"text": F.col("text"), "n_chars": F.when(F.col("_row.n_chars").isNotNull(), F.char_length("text").cast("long")) if "n_chars" in docs.columns else None}
    return rows.select(*(new[c].alias(c) if c in new else F.col("_row").getField(c).alias(c) for c in docs.columns))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    new = ("size", "source_size", "target", "taken", "position", "position2")
    rest = [c for c in docs.columns if c not in new]
    rows = mixing.mix(docs.select("doc_id", "source", "text", F.struct(*rest).alias("_row")), Scratch(spark, "mix"), keep=("_row",))
    return rows.select(*(F.col("_row").getField(c).alias(c) for c in rest), *new)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminated), ("pii", without_pii), ("mix", mix)]

#: The stages train models and compare shingles; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    last = None
    for name, stage in STAGES[:-1]:
        with scope():  # what the stage wrote for itself goes when its result is stored
            docs = scratch.save(stage(spark, docs, sf_dir), name)
        if last is not None:
            scratch.drop(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
