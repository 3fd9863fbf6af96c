"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight and a schedule: a piecewise linear density of its weight over
training time 0..1. Integrating the schedule and scaling it by the source's target gives
the source's cumulative token demand; inverting it turns the running number of words of a
document within its source into the document's training position. Documents are then
range-sorted by position. All steps are built-in expressions.

Order within a source is the hash of the id, so that it doesn't depend on the layout; a
running sum over it is made in two levels (hash ranges of about RANGE_ROWS documents, then
within a range), so that a hot source is spread over many tasks.

Edge cases: a null text has size 0 and takes nothing; a null source is a source of its own,
the last; a null id is ordered as an empty one; repeated rows are separate documents; an
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Scratch, table

WEIGHTS = (5.0, 2.0, 1.0)
#: Knots (time, relative weight) by weight index: the strong source fades, the weak one rises.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))
BUDGET, MOST = 1.5, 2
RANGE_ROWS = 1024


def pieces(knots) -> list[tuple[float, float, float, float]]:
    """(share before, time, density, slope) of each linear piece, the integral scaled to 1."""
    total = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))
    out, share = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        out.append((share, t0, w0 / total, (w1 - w0) / total / (t1 - t0)))
        share += (t1 - t0) * (w0 + w1) / 2 / total
    return out


def invert(schedule: Column, share: Column, schedules=SCHEDULES) -> Column:
    """The time at which the integrated schedule reaches ``share``."""
    out = F.lit(None).cast("double")
    for i, knots in enumerate(schedules):
        for before, t0, d, slope in pieces(knots):
            rest = share - F.lit(before)
            at = F.lit(t0) + (rest / F.lit(d) if slope == 0 else (F.sqrt(F.greatest(F.lit(0.0), F.lit(d * d) + F.lit(2 * slope) * rest)) - F.lit(d)) / F.lit(slope))
            out = F.when((schedule == i) & (share >= before), at).otherwise(out)
    return out


def targets(sized: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: int = MOST) -> DataFrame:
    """One row per source: k (place by code point, null last), n_docs, source_size, target.

    Sources below the water line take ``most`` times their size; the others share the rest by
    weight. Works on the table of sources, which has one row for each.
    """
    s = sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    everything = W.partitionBy(F.lit(0))
    s = s.withColumn("k", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1)
    s = s.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("k") % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * most).withColumn("goal", F.sum("source_size").over(everything) * F.lit(budget))
    order = everything.orderBy((F.col("cap") / F.col("w")).asc(), F.col("k").asc())
    before, rest = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    s = s.withColumn("level", (F.col("goal") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(rest))
    s = s.withColumn("full", F.col("cap") / F.col("w") <= F.col("level"))
    s = s.withColumn("line", F.max(F.when(~F.col("full"), F.col("level"))).over(everything))
    return s.select("source", "k", "n_docs", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("w") * F.col("line")).alias("target"))


def mix(docs: DataFrame, scratch: Scratch, weights=WEIGHTS, schedules=SCHEDULES, budget: float = BUDGET, most: int = MOST, keep: tuple[str, ...] = ()) -> DataFrame:
    """Adds size, source_size, target, taken, position, position2 to (doc_id, source, *keep).

    Rows are range-sorted by position; documents that are not taken come last, without one.
    position2 is where the second pass over a document begins, if it is taken again.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")
    sized = docs.select("doc_id", "source", *keep, F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"), key.alias("_key"))
    sized = scratch.save(sized, "sized")
    plan = scratch.save(targets(sized.select("source", "size"), weights, budget, most), "sources")  # a small file: the planner sees its size and broadcasts it only below its threshold
    thin = sized.join(plan.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    thin = thin.withColumn("_range", F.floor(F.col("_key") * (F.floor(F.col("n_docs") / RANGE_ROWS) + 1) / F.lit(1 << 32)))
    sums = thin.groupBy("k", "_range").agg(F.sum("size").alias("_words"))
    sums = sums.select(F.col("k").alias("_k"), F.col("_range").alias("_r"), F.coalesce(F.sum("_words").over(W.partitionBy("k").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    sums = scratch.save(sums, "ranges")
    within = W.partitionBy("k", "_range").orderBy("_key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    out = thin.withColumn("_in", F.coalesce(F.sum("size").over(within), F.lit(0)))
    out = out.join(sums, (F.col("k") == F.col("_k")) & (F.col("_range") == F.col("_r"))).withColumn("_at", F.col("_base") + F.col("_in"))
    out = out.withColumn("_goal", F.round("target").cast("long")).withColumn("_full", F.when(F.col("source_size") > 0, F.expr("_goal div source_size")).otherwise(F.lit(0)))
    rest = F.col("_goal") - F.col("_full") * F.col("source_size")
    out = out.withColumn("taken", F.col("size") * F.col("_full") + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_at"))))
    schedule = (F.col("k") % len(schedules)).cast("int")
    when = lambda at: F.round(invert(schedule, at / F.col("_goal"), schedules), 9)
    out = out.withColumn("position", F.when(F.col("taken") > 0, when(F.col("_at").cast("double")))).withColumn("position2", F.when(F.col("taken") > F.col("size"), when((F.col("_at") + F.col("source_size")).cast("double"))))
    return out.select("doc_id", "source", *keep, "size", "source_size", "target", "taken", "position", "position2").orderBy(F.col("position").asc_nulls_last(), "doc_id")


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), Scratch(spark, "op6")).select("doc_id", "size", "source_size", "target", "taken", "position", "position2")


ORACLE = r"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
         cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) as h
  from documents),
s0 as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as k from d group by source),
s1 as (select *, [5.0, 2.0, 1.0][(k % 3 + 1)::int]::double as w, source_size * 2 as cap, sum(source_size) over () * 1.5::double as goal from s0),
s2 as (select *, (goal - coalesce(sum(cap) over (order by cap / w, k rows between unbounded preceding and 1 preceding), 0)) /
         sum(w) over (order by cap / w, k rows between current row and unbounded following) as level from s1),
s as (select source, k, source_size, case when cap / w <= level then cap::double else w * max(case when cap / w > level then level end) over () end as target from s2),
p as (select d.doc_id, d.size, s.source_size, s.target, s.k, round(s.target)::bigint as goal,
        coalesce(sum(d.size) over (partition by s.k order by d.h, d.doc_id, d.size rows between unbounded preceding and 1 preceding), 0) as pos0
      from d join s on d.source is not distinct from s.source),
t as (select *, case when source_size > 0 then size * (goal // source_size) + greatest(0, least(size, goal - (goal // source_size) * source_size - pos0)) else 0 end as taken from p),
u as (select *, pos0 / goal::double as u1, (pos0 + source_size) / goal::double as u2 from t)
select doc_id, size, source_size, target, taken::bigint as taken,
  case when taken > 0 then round(case k % 3 when 0 then 1.5 - sqrt(2.25 - 2 * u1) when 1 then u1 else sqrt(0.25 + 2 * u1) - 0.5 end, 9) end as position,
  case when taken > size then round(case k % 3 when 0 then 1.5 - sqrt(2.25 - 2 * u2) when 1 then u2 else sqrt(0.25 + 2 * u2) - 0.5 end, 9) end as position2
from u
"""
