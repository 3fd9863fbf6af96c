"""The event-time window over arrivals, in closed form.

Arrival order is the order of ids. ``eff``, the running maximum of event times, never falls,
and an event is live at watermark M exactly if eff >= M - W: the live events are a suffix of
the arrivals, late ones included. So totals are differences of running sums, and the figures
by key come from each event's first and last evaluation; no event is joined with the batches
it is live in.

Running figures over all arrivals are made in two levels - per id range, and within one - so
that no task gets more than one range; those along a key, per key and range of evaluations, so
that a hot key is dealt over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..sources.scratch import settle

ID_SPAN = 1 << 14
TIME_SPAN_US = 60_000_000
E_SPAN = 1 << 12


def running(df: DataFrame, order: Column, bucket: Column, sums: dict[str, Column], maxima: dict[str, Column] | None = None, ties: tuple[Column, ...] = (), keys: tuple[str, ...] = ()) -> DataFrame:
    """Adds inclusive running sums and maxima along ``order``, of each of ``keys``; ``bucket`` must rise with it."""
    maxima = maxima or {}
    df = df.withColumn("_b", bucket)
    totals = df.groupBy(*keys, "_b").agg(*(F.sum(c).alias(f"_s_{k}") for k, c in sums.items()), *(F.max(c).alias(f"_m_{k}") for k, c in maxima.items()))
    before = W.partitionBy(*(keys or (F.lit(0),))).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    carry = totals.select(F.col("_b").alias("_b2"), *(F.col(k).alias(f"_k_{k}") for k in keys), *(F.coalesce(F.sum(f"_s_{k}").over(before), F.lit(0)).alias(f"_s_{k}") for k in sums), *(F.max(f"_m_{k}").over(before).alias(f"_m_{k}") for k in maxima))
    inside = W.partitionBy(*keys, "_b").orderBy(order, *ties).rowsBetween(W.unboundedPreceding, 0)
    df = df.withColumns({f"_i_{k}": F.sum(c).over(inside) for k, c in sums.items()} | {f"_x_{k}": F.max(c).over(inside) for k, c in maxima.items()})
    same = F.col("_b") == F.col("_b2")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    df = df.join(carry, same)
    df = df.withColumns({k: F.col(f"_i_{k}") + F.col(f"_s_{k}") for k in sums} | {k: F.greatest(f"_x_{k}", f"_m_{k}") for k in maxima})
    return df.drop("_b", "_b2", *(f"_k_{k}" for k in keys), *(f"_{p}_{k}" for k in sums for p in "si"), *(f"_{p}_{k}" for k in maxima for p in "mx"))


def by_id(c: str = "id", span: int = ID_SPAN) -> Column:
    return F.floor(F.col(c) / span)


def number_batches(raw: DataFrame, batch_size: int, span: int = ID_SPAN) -> DataFrame:
    """Adds batch_id over all raw rows by id, those that won't parse included.

    Numbers are made from the ids alone, a scan of one column, and joined back; rows that
    repeat an id are in the batch of the last of them.
    """
    ids = raw.groupBy(F.col("id").alias("_id")).agg(F.count("*").alias("_n"))
    numbers = running(ids, F.col("_id"), by_id("_id", span), {"_rn": F.col("_n")})
    numbers = numbers.select("_id", F.floor((F.col("_rn") - 1) / batch_size).alias("batch_id"))
    return raw.join(numbers, F.col("id") == F.col("_id")).drop("_id")


def dedupe(events: DataFrame) -> DataFrame:
    """One event of each positive id; others are all kept. One pass over the events."""
    alone = F.when(F.col("id") > 0, F.lit(-1)).otherwise(F.monotonically_increasing_id())
    return events.withColumn("_alone", alone).dropDuplicates(["id", "_alone"]).drop("_alone")


def entries(analyzed: DataFrame) -> DataFrame:
    """What the window holds of an event."""
    return analyzed.select("id", "at", "batch_id", F.coalesce("service", F.lit("UNKNOWN")).alias("service"), (F.col("severity") == "CRITICAL").alias("is_error"), (F.col("category") == "AUTH").alias("is_auth"), "ip", "latency_ms")


def track(entries: DataFrame, span: int = ID_SPAN) -> DataFrame:
    """Adds eff (running maximum of ``at``, epoch at least), pos and errors so far."""
    floor = F.greatest(F.col("at"), F.timestamp_seconds(F.lit(0)))
    return running(entries, F.col("id"), by_id(span=span), {"pos": F.lit(1), "errors_so_far": F.col("is_error").cast("long")}, {"eff": floor})


def evaluations(tracked: DataFrame, span: int = ID_SPAN) -> DataFrame:
    """One row for each batch with an event: e (1, 2, ...), its watermark and running figures."""
    e = tracked.groupBy("batch_id").agg(F.max("pos").alias("last_pos"), F.max("errors_so_far").alias("last_errors"), F.max("eff").alias("watermark"))
    return running(e, F.col("batch_id"), by_id("batch_id", span), {"e": F.lit(1)})


def below(points: DataFrame, queries: DataFrame, at: str, sums: dict[str, Column], strict: bool) -> DataFrame:
    """For each query time, sums over the points before it (or at it, unless ``strict``)."""
    p = points.groupBy(F.col(at).alias("_t")).agg(*(F.sum(c).alias(k) for k, c in sums.items())).withColumn("_q", F.lit(False))
    q = queries.select(F.col(at).alias("_t")).distinct()
    q = q.select("_t", *(F.lit(0).cast("long").alias(k) for k in sums), F.lit(True).alias("_q"))
    both = p.unionByName(q).withColumn("_o", F.when(F.col("_q"), 0 if strict else 2).otherwise(1))
    both = settle(both.withColumnsRenamed({k: f"_v_{k}" for k in sums}), "times")
    both = running(both, F.col("_t"), F.floor(F.unix_micros("_t") / TIME_SPAN_US), {k: F.col(f"_v_{k}") for k in sums}, ties=(F.col("_o"),))
    return both.where("_q").select(F.col("_t").alias(at), *sums)


def seconds(n: int) -> Column:
    return F.expr(f"INTERVAL '{int(n)}' SECOND")


def snapshots(tracked: DataFrame, evals: DataFrame, window_seconds: int) -> DataFrame:
    """total, errors and error_rate of the window at each evaluation."""
    cut = evals.withColumn("eff", F.col("watermark") - seconds(window_seconds))
    gone = below(tracked, cut, "eff", {"n": F.lit(1), "n_errors": F.col("is_error").cast("long")}, strict=True)
    out = cut.join(gone, "eff")
    total, errors = F.col("last_pos") - F.col("n"), F.col("last_errors") - F.col("n_errors")
    return out.select("e", "batch_id", "watermark", total.alias("total"), errors.alias("errors"), F.coalesce(F.try_divide(errors, total), F.lit(0.0)).alias("error_rate"))


def by_key(tracked: DataFrame, evals: DataFrame, window_seconds: int, key: str, sums: dict[str, Column], having: Column | None = None) -> DataFrame:
    """(e, key, *sums) over the live events at each evaluation where the first sum is above 0.

    Every event counts from its own evaluation to the last whose watermark is at most eff + W;
    running sums of these changes hold until the next change.
    """
    rows = tracked.groupBy(key, "batch_id", "eff").agg(*(F.sum(c).alias(k) for k, c in sums.items())).join(evals.select("batch_id", "e"), "batch_id")
    rows = rows.join(lasting(evals, tracked, window_seconds), "eff").where("last >= e")
    at = F.explode(F.array(F.struct("e", *(F.col(k) for k in sums)), F.struct((F.col("last") + 1).alias("e"), *((-F.col(k)).alias(k) for k in sums))))
    change = rows.select(key, at.alias("_c")).select(key, "_c.*").groupBy(key, "e").agg(*(F.sum(k).alias(k) for k in sums))
    return levels(settle(change, "changes"), key, tuple(sums), having)


def lasting(evals: DataFrame, tracked: DataFrame, window_seconds: int) -> DataFrame:
    """(eff, last): the last evaluation in which an event of that time is live."""
    ends = tracked.select("eff").distinct().withColumn("until", F.col("eff") + seconds(window_seconds))
    last = below(evals.select(F.col("watermark").alias("until")), ends, "until", {"last": F.lit(1)}, strict=False)
    return last.select((F.col("until") - seconds(window_seconds)).alias("eff"), "last")


def levels(change: DataFrame, key: str, sums: tuple[str, ...], having: Column | None = None, span: int = E_SPAN) -> DataFrame:
    """(e, key, *sums): running sums of changes, at every evaluation until the next change where
    the first one is above 0. A key's changes are worked on per range of ``span`` evaluations."""
    bucket = F.floor(F.col("e") / span)
    level = running(change.withColumnsRenamed({k: f"_v_{k}" for k in sums}), F.col("e"), bucket, {k: F.col(f"_v_{k}") for k in sums}, keys=(key,))
    level = level.withColumn("_r", bucket)
    first = change.groupBy(F.col(key).alias("_fk"), bucket.alias("_fr")).agg(F.min("e").alias("_first"))
    first = first.select("_fk", "_fr", F.lead("_first").over(W.partitionBy("_fk").orderBy("_fr")).alias("_later"))
    level = level.select(key, "e", *sums, "_r", F.lead("e").over(W.partitionBy(key, "_r").orderBy("e")).alias("_soon"))
    level = level.where(F.col(sums[0]) > 0)
    level = level if having is None else level.where(having)
    level = level.join(first, (F.col(key) == F.col("_fk")) & (F.col("_r") == F.col("_fr")))
    return level.withColumn("e", F.explode(F.sequence("e", F.coalesce("_soon", "_later") - 1))).select(key, "e", *sums)


def errors_by_service(tracked: DataFrame, evals: DataFrame, window_seconds: int, least: int = 1) -> DataFrame:
    return by_key(tracked.where("is_error"), evals, window_seconds, "service", {"n": F.lit(1)}, F.col("n") >= least)


def failed_logins_by_ip(tracked: DataFrame, evals: DataFrame, window_seconds: int, least: int = 1) -> DataFrame:
    return by_key(tracked.where("is_auth and ip is not null"), evals, window_seconds, "ip", {"n": F.lit(1)}, F.col("n") >= least)


def latency_by_service(tracked: DataFrame, evals: DataFrame, window_seconds: int) -> DataFrame:
    out = by_key(tracked.where("latency_ms is not null"), evals, window_seconds, "service", {"n": F.lit(1), "total_ms": F.col("latency_ms")})
    return out.select("service", "e", (F.col("total_ms") / F.col("n")).alias("avg_latency_ms"))
