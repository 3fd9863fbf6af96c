"""Raw rows to events: total expressions; a row that can't be parsed carries ``parse_error``.

Adds to the raw columns cleaned values and: ``at`` (instant), ``fields`` (map), ``parse_error``.
One pass; split it with ``events`` and ``dead_letters``.
"""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

_ISO = r"^\d{4}-\d\d-\d\dT\d\d:\d\d(:\d\d(\.\d{1,9})?)?"
REASON_CHARS = 512


def prepare(spark) -> None:
    """Session settings, and this package on the path of Python workers started elsewhere."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")


def zoned(naive: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` as an instant (session time zone UTC)."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), naive).cast("timestamp")


def field_time(raw: Column, zone: str) -> Column:
    """Epoch seconds, epoch millis (13 digits or more), or ISO time with or without an offset.

    Instants after the year 294246 have no timestamp in Spark: they are unparseable.
    """
    digits = raw.rlike(r"^\d+$")
    number = raw.try_cast("long")
    epoch = F.when(F.length(raw) >= 13, F.when(number <= ((1 << 63) - 1) // 1000, F.timestamp_millis(number))).otherwise(F.timestamp_seconds(number))
    full = F.when(raw.rlike(r"T\d\d:\d\d($|Z|[+-])"), F.regexp_replace(raw, r"(T\d\d:\d\d)", "$1:00")).otherwise(raw)
    return F.when(digits, epoch).when(raw.rlike(_ISO + r"(Z|[+-]\d\d:\d\d(:\d\d)?)$"), full.try_cast("timestamp")).when(raw.rlike(_ISO + "$"), zoned(full.try_cast("timestamp_ntz"), zone))


def _pinned(c):
    """The same value, but not deterministic to the optimiser: else it would push a filter on
    the column below the projection and put the whole parse in place of the name, again and again."""
    return F.when(F.spark_partition_id() >= 0, c)


def parse(raw: DataFrame, zone: str = "UTC", keep: tuple[str, ...] = ()) -> DataFrame:
    prepare(raw.sparkSession)
    d = raw.withColumn("raw_message", F.col("message")).withColumn("message", X.strip(F.col("message")))
    d = d.withColumn("_json", F.coalesce(X.json_like(F.col("message")), F.lit(False)))
    d = d.withColumn("_from_json", F.when(F.col("_json"), X.json_fields(F.col("message"))))
    nothing = F.create_map().cast("map<string,string>")
    d = d.withColumn("fields", _pinned(F.when(F.col("_json"), F.col("_from_json")).when(F.col("message") != "", X.text_fields(F.col("message"))).otherwise(nothing)))
    d = d.drop("_from_json")
    m, j = F.coalesce("fields", nothing), F.col("_json")
    own = X.level(F.col("level"))
    of_json = lambda c: F.when(j, c)
    user = F.when(j, X.first_of(m, "user", "userId", "user_id")).otherwise(X.first_of(m, "user"))
    status = F.when(j, X.first_of(m, "status", "statusCode", "status_code")).otherwise(X.first_of(m, "status"))
    d = d.select(
        "id", "ts", F.when(j & (own == "UNKNOWN"), X.level(X.first_of(m, "level"))).otherwise(own).alias("level"),
        F.coalesce(X.blank_to_null(F.col("service")), of_json(X.blank_to_null(X.first_of(m, "service", "logger")))).alias("service"), "message",
        F.coalesce("user_id", X.whole_number(user, "long")).alias("user_id"),
        F.coalesce(X.blank_to_null(F.col("ip")), of_json(X.blank_to_null(X.first_of(m, "ip")))).alias("ip"),
        F.coalesce("status_code", X.whole_number(status, "int")).alias("status_code"),
        F.coalesce("latency_ms", of_json(X.whole_number(X.first_of(m, "latency", "latencyMs", "latency_ms"), "long"))).alias("latency_ms"),
        X.blank_to_null(F.col("stack_trace")).alias("stack_trace"), "fields", "raw_message", "_json", *keep,
    )
    given = X.strip(X.first_of(m, "ts", "timestamp", "time"))
    d = d.withColumn("_given", given).withColumn("at", F.when(F.col("ts").isNotNull(), zoned(F.col("ts"), zone)).otherwise(field_time(F.col("_given"), zone)))
    error = F.when(F.col("_json") & F.col("fields").isNull(), F.concat(F.lit("IllegalArgumentException: malformed JSON message: "), F.col("message")))
    error = error.when(F.col("at").isNull() & (F.coalesce("_given", F.lit("")) == ""), F.lit("IllegalArgumentException: no usable timestamp (column null and none in message)"))
    error = error.when(F.col("at").isNull(), F.concat(F.lit("IllegalArgumentException: unparseable timestamp: '"), F.col("_given"), F.lit("'")))
    return d.withColumn("parse_error", _pinned(error)).drop("_json", "_given")


def events(parsed: DataFrame) -> DataFrame:
    return parsed.where("parse_error is null").drop("parse_error", "raw_message")


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where("parse_error is not null").select(F.col("id").alias("source_id"), "raw_message", F.substr("parse_error", F.lit(1), F.lit(REASON_CHARS)).alias("reason"))
