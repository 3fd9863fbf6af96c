"""Events and alerts as JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import instant_text
from ..schema import DOCUMENT
from .analyze import index_name


def _sorted(m: Column) -> Column:
    return F.map_from_entries(F.array_sort(F.map_entries(m)))


def documents(analyzed: DataFrame) -> DataFrame:
    """(es_id, target_index, body, n_bytes); maps are written in key order, nulls are kept."""
    none = F.create_map().cast("map<string,string>")
    enrichment = F.col("enrichment") if "enrichment" in analyzed.columns else none
    body = F.struct(
        instant_text(F.col("at")).alias("@timestamp"), "level", "service", "message", F.col("id").alias("sourceId"), F.col("user_id").alias("userId"), "ip", F.col("status_code").alias("statusCode"),
        F.col("latency_ms").alias("latencyMs"), F.col("stack_trace").alias("stackTrace"), "category", "domain", "severity", "fingerprint", F.col("trace_id").alias("traceId"), "synthetic",
        _sorted(F.coalesce(enrichment, none)).alias("enrichment"), _sorted(F.coalesce("fields", none)).alias("fields"),
    )
    out = analyzed.select("es_id", "target_index", F.to_json(body, {"ignoreNullFields": "false"}).alias("body"))
    return out.withColumn("n_bytes", F.octet_length("body"))


def alert_events(alerts: DataFrame) -> DataFrame:
    """Alerts as synthetic events, with the columns of analyzed ones."""
    text = lambda v: F.lit(v).cast("string")
    return alerts.select(
        F.lit(-1).cast("long").alias("id"), F.col("at"), F.when(F.col("severity") == "CRITICAL", "ERROR").otherwise("WARN").alias("level"), F.lit("analyzer").alias("service"), "message",
        F.lit(None).cast("long").alias("user_id"), text(None).alias("ip"), F.lit(None).cast("int").alias("status_code"), F.lit(None).cast("long").alias("latency_ms"), text(None).alias("stack_trace"),
        F.create_map(F.lit("rule"), F.col("rule"), F.lit("subject"), F.col("subject")).alias("fields"), F.lit("ALERT").alias("category"), F.lit("OBSERVABILITY").alias("domain"), "severity",
        F.concat(F.lit("alert:"), F.col("rule")).alias("fingerprint"), text(None).alias("trace_id"),
        F.concat_ws("-", F.lit("alert"), F.col("rule"), F.col("subject"), F.unix_seconds("at").cast("string")).alias("es_id"), index_name(F.col("at"), "app-alerts-").alias("target_index"), F.lit(True).alias("synthetic"),
    )


def latest(docs: DataFrame, key: str = "es_id") -> DataFrame:
    """One document an id, as an overwrite by id leaves it (equal ids have equal bodies)."""
    return docs.groupBy(key).agg(*(F.max(c).alias(c) for c in docs.columns if c != key))


# Fields whose mapping doesn't follow from their type.
_MAPPED = {"@timestamp": {"type": "date"}, "message": {"type": "text"}, "stackTrace": {"type": "text"}, "ip": {"type": "ip", "ignore_malformed": True}}


def index_template(patterns: tuple[str, ...] = ("app-logs-*", "app-alerts-*"), shards: int = 1, replicas: int = 1, refresh: str = "5s") -> dict:
    """The receiver's template for both families of indices, from the document schema."""
    plain = {"string": "keyword", "long": "long", "integer": "integer", "boolean": "boolean", "map": "object"}
    of = lambda f: _MAPPED.get(f.name) or {"type": plain[f.dataType.typeName()]} | ({"dynamic": True} if f.dataType.typeName() == "map" else {})
    return {
        "index_patterns": list(patterns),
        "template": {"settings": {"number_of_shards": shards, "number_of_replicas": replicas, "refresh_interval": refresh}, "mappings": {"dynamic": True, "properties": {f.name: of(f) for f in DOCUMENT.fields}}},
    }


def read_documents(docs: DataFrame) -> DataFrame:
    """Bodies read back by the document schema."""
    return docs.select("es_id", "target_index", F.from_json("body", DOCUMENT).alias("d")).select("es_id", "target_index", "d.*")
