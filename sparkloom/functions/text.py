"""Scalar functions as Column expressions; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity names by their aliases.
LEVEL_ALIASES = {
    "trace": "TRACE", "finest": "TRACE",
    "debug": "DEBUG", "fine": "DEBUG", "verbose": "DEBUG",
    "info": "INFO", "information": "INFO", "notice": "INFO",
    "warn": "WARN", "warning": "WARN",
    "error": "ERROR", "err": "ERROR", "severe": "ERROR",
    "fatal": "FATAL", "critical": "FATAL", "crit": "FATAL", "emergency": "FATAL", "panic": "FATAL",
}

# The patterns of key=value pairs, exception types and threads.
KV_PAIR = r'(\w+)=("[^"]*"|\S+)'
EXCEPTION_TYPE = r"\b([A-Za-z_][\w.]*(?:Exception|Error|Throwable))\b"
THREAD = r"\[([^\]]+)\]"

# What is scrubbed from fingerprinted text, in order.
SCRUBS = (
    (r"\$\$Lambda\$\d+/0x[0-9a-fA-F]+", r"\$\$Lambda"),
    (r"@[0-9a-fA-F]+", "@"),
    (r"0x[0-9a-fA-F]+", "0x"),
    (r":\d+", ":"),
    (r"\d{2,}", "#"),
    (r"\s+", " "),
)


# White space as the JVM has it - separators but no-break ones, and controls.
WHITE_SPACE = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2008\u2009\u200a\u2028\u2029\u205f\u3000"


def strip(c: Column) -> Column:
    """Removes Unicode white space (not no-break space) from both ends; looks at the ends only."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def level(c: Column) -> Column:
    names = F.create_map(*(F.lit(x) for pair in LEVEL_ALIASES.items() for x in pair))
    return F.coalesce(F.try_element_at(names, F.lower(strip(c))), F.lit("UNKNOWN"))


def whole_number(c: Column, kind: str) -> Column:
    """A long or int in decimal digits, else null."""
    return F.when(strip(c).rlike(r"^[+-]?\d+$"), strip(c).try_cast(kind))


def json_like(c: Column) -> Column:
    return c.startswith("{") & c.endswith("}")


def kv_pairs(c: Column) -> Column:
    """key=value pairs of a text; quotes go, the last of equal keys wins."""
    quoted = lambda v: (F.length(v) >= 2) & v.startswith('"') & v.endswith('"')
    values = F.transform(F.regexp_extract_all(c, F.lit(KV_PAIR), F.lit(2)), lambda v: F.when(quoted(v), F.substr(v, F.lit(2), F.length(v) - 2)).otherwise(v))
    return F.map_from_arrays(F.regexp_extract_all(c, F.lit(KV_PAIR), F.lit(1)), values)


def _found(c: Column, pattern: str, key: str) -> Column:
    got = F.regexp_extract(c, pattern, 1)
    return F.when(got != "", F.create_map(F.lit(key), got)).otherwise(F.create_map().cast("map<string,string>"))


def text_fields(c: Column) -> Column:
    """Pairs, the first exception type (over a pair's), and the first [thread] (under a pair's)."""
    return F.map_concat(_found(c, THREAD, "thread"), kv_pairs(c), _found(c, EXCEPTION_TYPE, "exception"))


_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "allowUnquotedFieldNames": "false"}


def _entries(c: Column, prefix: Column | None) -> Column:
    """(key, text, is it an object) of a JSON object's fields without null."""
    texts = F.from_json(c, "map<string,string>", _JSON)
    kinds = F.from_json(c, "map<string,variant>", _JSON)
    name = (lambda k: k) if prefix is None else (lambda k: F.concat(prefix, F.lit("."), k))
    return F.transform(
        F.filter(F.map_entries(texts), lambda e: e["value"].isNotNull()),
        lambda e: F.struct(name(e["key"]).alias("k"), e["value"].alias("v"), (e["value"].startswith("{") & F.coalesce(F.schema_of_variant(kinds[e["key"]]).startswith("OBJECT"), F.lit(False))).alias("o")),
    )


def json_fields(c: Column) -> Column:
    """A JSON object as dotted keys to texts: arrays as JSON, nulls left out; null if malformed.

    Objects are opened level by level; a text has at most as many levels as opening braces.
    """
    opened = lambda e: F.when(e["o"], _entries(e["v"], e["k"])).otherwise(F.array(e))
    level = lambda acc, _: F.when(F.exists(acc, lambda e: e["o"]), F.flatten(F.transform(acc, opened))).otherwise(acc)
    depth = F.length(c) - F.length(F.replace(c, F.lit("{"), F.lit("")))
    flat = F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), depth)), _entries(c, None), level)
    return F.map_from_entries(F.transform(flat, lambda e: F.struct(e["k"], e["v"])))


def first_of(m: Column, *keys: str) -> Column:
    """The value of the first key that is present."""
    return F.coalesce(*(F.try_element_at(m, F.lit(k)) for k in keys))


def scrub(c: Column) -> Column:
    for pattern, to in SCRUBS:
        c = F.regexp_replace(c, pattern, to)
    return strip(c)


def scrub_lines(c: Column) -> Column:
    """``scrub`` of each of the stripped lines between line feeds, over the whole text at once."""
    for pattern, to in SCRUBS:
        c = F.regexp_replace(c, r"[ \t]+" if pattern == r"\s+" else pattern, to)
    return c


def instant_text(c: Column) -> Column:
    """ISO instant with 0, 3 or 6 digits of fraction."""
    return F.concat(F.regexp_replace(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"(\.000000|000)$", ""), F.lit("Z"))
