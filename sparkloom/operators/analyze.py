"""Per-event derivations: category, domain, severity, fingerprint, trace, enrichment, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

STACK_FRAMES = 5
#: A lookup table up to this size is broadcast; a larger one is joined by a shuffle.
BROADCAST_BYTES = 64 << 20


def _has(c: Column, *words: str) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.lower(c).contains(w)
    return out


def category(status: Column, exception: Column) -> Column:
    by_status = F.when(status.isin(401, 403), "AUTH").when(status == 429, "RATE_LIMIT").when(status >= 500, "SERVER_ERROR").when(status >= 400, "CLIENT_ERROR")
    by_exception = F.when(exception.isNull(), "GENERAL").when(_has(exception, "sql", "dataaccess", "jdbc"), "DATABASE").when(_has(exception, "timeout", "connect", "socket"), "NETWORK")
    by_exception = by_exception.when(_has(exception, "nullpointer", "illegalstate", "illegalargument"), "APPLICATION_BUG").otherwise("EXCEPTION")
    return F.coalesce(by_status, by_exception)


def domain(service: Column) -> Column:
    return F.when(service.isNull(), "UNKNOWN").when(_has(service, "checkout", "payment", "order"), "PAYMENTS").when(_has(service, "auth", "login", "account", "user"), "ACCOUNT").when(_has(service, "catalog", "product", "search"), "CATALOG").otherwise(service)


def severity(level: Column, status: Column) -> Column:
    status = F.coalesce(status, F.lit(0))
    return F.when(level.isin("FATAL", "ERROR") | (status >= 500), "CRITICAL").when((level == "WARN") | (status >= 400), "DEGRADED").otherwise("NORMAL")


def stack_signature(stack: Column, frames: int = STACK_FRAMES) -> Column:
    """Scrubbed lines of a stack up to its fifth ``at`` frame."""
    lines = F.filter(F.transform(F.split(stack, r"\R"), X.strip), lambda s: s != "")
    begin = F.struct(F.lit(0).alias("n"), F.array().cast("array<string>").alias("kept"))
    step = lambda acc, s: F.when(acc["n"] >= frames, acc).otherwise(F.struct((acc["n"] + F.when(s.startswith("at "), 1).otherwise(0)).alias("n"), F.concat(acc["kept"], F.array(s)).alias("kept")))
    return X.scrub_lines(F.array_join(F.aggregate(lines, begin, step)["kept"], "\n"))


def fingerprint(stack: Column, exception: Column, service: Column, message: Column) -> Column:
    empty = lambda c: F.coalesce(c, F.lit(""))
    plain = X.strip(F.concat(empty(exception), F.lit("|"), empty(service), F.lit("|"), X.scrub(empty(message))))
    return F.substr(F.sha2(F.when(X.strip(empty(stack)) != "", stack_signature(stack)).otherwise(plain), 256), F.lit(1), F.lit(16))


def trace_id(fields: Column) -> Column:
    keys = ("traceId", "trace_id", "traceID", "trace", "sessionId", "session_id", "session")
    return F.coalesce(*(X.blank_to_null(F.try_element_at(fields, F.lit(k))) for k in keys))


def index_name(at: Column, prefix: str = "app-logs-") -> Column:
    return F.concat(F.lit(prefix), F.date_format(at, "yyyy.MM.dd"))


def analyze(events: DataFrame) -> DataFrame:
    e = F.try_element_at("fields", F.lit("exception"))
    return events.withColumns({
        "category": category(F.col("status_code"), e), "domain": domain(F.col("service")), "severity": severity(F.col("level"), F.col("status_code")),
        "fingerprint": fingerprint(F.col("stack_trace"), e, F.col("service"), F.col("message")), "trace_id": trace_id(F.col("fields")),
        "es_id": F.concat(F.lit("applog-"), F.col("id")), "target_index": index_name(F.col("at")), "synthetic": F.lit(False),
    })


def _lookup(events: DataFrame, key: str, dim: DataFrame, name: str, small: bool) -> DataFrame:
    """Left join of a (key, value) table with one row a key."""
    dim = dim.toDF("_key", name)
    return events.join(F.broadcast(dim) if small else dim, F.col(key) == F.col("_key"), "left").drop("_key")


def fits(dim: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the optimiser's size estimate proves a lookup table small."""
    return int(str(dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def enrich(events: DataFrame, geo: DataFrame | None = None, segments: DataFrame | None = None, version: str | None = None) -> DataFrame:
    """Adds the map ``enrichment``: deploymentVersion, geo by ip, segment by user; without nulls."""
    parts = {"deploymentVersion": F.lit(version).cast("string")}
    for key, dim, name, out in (("ip", geo, "_geo", "geo"), ("user_id", segments, "_segment", "segment")):
        if dim is not None:
            events = _lookup(events, key, dim, name, fits(dim))
            parts[out] = F.col(name).cast("string")
    full = F.create_map(*(x for k, v in parts.items() for x in (F.lit(k), v)))
    return events.withColumn("enrichment", F.map_filter(full, lambda k, v: v.isNotNull())).drop("_geo", "_segment")
