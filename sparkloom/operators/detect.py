"""Detection rules over window snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..sources.scratch import settle
from .window import E_SPAN, running

FOLD = 128


def baselines(snaps: DataFrame, alpha: float, min_events: int, start: float | None = None, fold: int = FOLD) -> DataFrame:
    """Adds baseline (the average before each evaluation) and ema (after it); null where not updated.

    The exponential average is a fold in the order of evaluations. Runs of ``fold`` of them are
    folded by themselves into decay and offset: a run turns the average x before it into offset
    + decay * x. Runs of ``fold`` such runs are composed in the same way, and only these are
    folded one after another; then each run is gone through once more from its own start.
    """
    used = running(snaps.where(F.col("total") >= min_events), F.col("e"), F.floor(F.col("e") / E_SPAN), {"o": F.lit(1)})
    runs = used.groupBy(F.floor((F.col("o") - 1) / fold).alias("r")).agg(F.array_sort(F.collect_list(F.struct("o", "e", F.col("error_rate").alias("x")))).alias("xs"))
    a, keep = F.lit(float(alpha)), F.lit(1.0 - alpha)
    mixed = lambda acc, x: F.when(acc.isNull(), x).otherwise(a * x + keep * acc)
    none = F.lit(start).cast("double")
    zero = F.when(F.col("r") == 0, none).otherwise(F.lit(0.0))
    # nothing from before the first evaluation goes on: its run decays to 0
    decay = F.when(F.col("r") == 0, F.lit(0.0)).otherwise(F.pow(keep, F.size("xs")))
    runs = settle(runs.withColumn("offset", F.aggregate("xs", zero, lambda acc, v: mixed(acc, v["x"]))).withColumn("decay", decay), "runs")
    ends = runs.groupBy(F.floor(F.col("r") / fold).alias("g")).agg(F.array_sort(F.collect_list(F.struct("r", "offset", "decay"))).alias("rs"))
    compose = lambda acc, v: F.struct((v["offset"] + v["decay"] * acc["offset"]).alias("offset"), (v["decay"] * acc["decay"]).alias("decay"))
    ends = ends.withColumn("all", F.aggregate("rs", F.struct(F.lit(0.0).alias("offset"), F.lit(1.0).alias("decay")), compose))
    top = ends.groupBy().agg(F.array_sort(F.collect_list(F.struct(F.col("g").alias("r"), F.col("all.offset").alias("offset"), F.col("all.decay").alias("decay")))).alias("rs"))
    groups = top.select(F.explode(_starts("rs", F.coalesce(none, F.lit(0.0)))).alias("s")).select(F.col("s.r").alias("g2"), F.col("s.begin").alias("g_begin"))
    starts = ends.join(groups, F.col("g") == F.col("g2")).select(F.explode(_starts("rs", F.col("g_begin"))).alias("s"))
    starts = starts.select(F.col("s.r").alias("r2"), F.when(F.col("s.r") == 0, none).otherwise(F.col("s.begin")).alias("begin"))
    walk = lambda acc, v: F.struct(mixed(acc["ema"], v["x"]).alias("ema"), F.concat(acc["out"], F.array(F.struct(v["e"].alias("e"), acc["ema"].alias("baseline"), mixed(acc["ema"], v["x"]).alias("ema")))).alias("out"))
    each = runs.join(starts, F.col("r") == F.col("r2")).select(F.explode(F.aggregate("xs", F.struct(F.col("begin").alias("ema"), F.array().cast("array<struct<e:bigint,baseline:double,ema:double>>").alias("out")), walk)["out"]).alias("s")).select("s.*")
    return snaps.join(each, "e", "left")


def _starts(runs: str, begin: Column) -> Column:
    """Of runs (r, offset, decay) in order: the average before each."""
    kind = "array<struct<r:bigint,begin:double>>"
    step = lambda acc, v: F.struct((v["offset"] + v["decay"] * acc["ema"]).alias("ema"), F.concat(acc["out"], F.array(F.struct(v["r"].alias("r"), acc["ema"].alias("begin")))).alias("out"))
    return F.aggregate(runs, F.struct(begin.alias("ema"), F.array().cast(kind).alias("out")), step)["out"]


# The names of the rules and the wording of their messages.
def _alert(df: DataFrame, rule: str, subject: Column, message: Column, severity: str, value: Column) -> DataFrame:
    return df.select("e", F.col("watermark").alias("at"), F.lit(rule).alias("rule"), subject.alias("subject"), message.alias("message"), F.lit(severity).alias("severity"), value.cast("double").alias("value"))


def spike_alerts(with_baseline: DataFrame, c: Config) -> DataFrame:
    hot = with_baseline.where((F.col("total") >= c.anomaly_min_events) & (F.col("baseline") > 0) & (F.col("error_rate") > F.lit(c.anomaly_spike_multiplier) * F.col("baseline")))
    text = F.format_string("Error rate %.1f%% exceeds %.1f x trailing avg %.1f%% over %ds", F.col("error_rate") * 100, F.lit(c.anomaly_spike_multiplier), F.col("baseline") * 100, F.lit(c.window_seconds))
    return _alert(hot, "ERROR_RATE_SPIKE", F.lit("GLOBAL"), text, "CRITICAL", F.col("error_rate"))


def service_limit(c: Config) -> int:
    return max(10, c.anomaly_min_events // 2)


def service_alerts(counts: DataFrame, evals: DataFrame, c: Config) -> DataFrame:
    hot = counts.where(F.col("n") >= service_limit(c)).join(evals.select("e", "watermark"), "e")
    return _alert(hot, "SERVICE_ERROR_CONCENTRATION", F.col("service"), F.format_string("Service '%s' produced %d errors in %ds", "service", "n", F.lit(c.window_seconds)), "CRITICAL", F.col("n"))


def login_alerts(counts: DataFrame, evals: DataFrame, c: Config) -> DataFrame:
    hot = counts.where(F.col("n") >= c.anomaly_failed_login_threshold).join(evals.select("e", "watermark"), "e")
    return _alert(hot, "FAILED_LOGIN_BURST", F.col("ip"), F.format_string("%d failed auth attempts from %s in %ds", "n", "ip", F.lit(c.window_seconds)), "DEGRADED", F.col("n"))
