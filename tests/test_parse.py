import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import text as X
from sparkloom.operators import analyze as A
from sparkloom.operators import documents, parse
from sparkloom.schema import DOCUMENT, RAW

NOON = dt.datetime(2026, 1, 1, 12, 0)


def row(i=1, ts=NOON, level=None, service=None, message=None, user=None, ip=None, status=None, latency=None, stack=None):
    return (i, ts, level, service, message, user, ip, status, latency, stack)


def parsed(spark, *rows, zone="UTC"):
    return {r.id: r for r in parse.parse(spark.createDataFrame(list(rows), RAW), zone).collect()}


def test_json_is_flattened_and_promoted(spark):
    r = parsed(spark, row(message='{"level":"warn","user":"77","status":"503","latency_ms":9,"logger":"db","ip":"1.2.3.4","context":{"requestId":"abc","deep":{"k":1.50}},"tags":[1, "x"],"none":null,"flag":true}'))[1]
    assert r.fields == {"level": "warn", "user": "77", "status": "503", "latency_ms": "9", "logger": "db", "ip": "1.2.3.4", "context.requestId": "abc", "context.deep.k": "1.5", "tags": '[1,"x"]', "flag": "true"}
    assert (r.level, r.user_id, r.status_code, r.latency_ms, r.service, r.ip) == ("WARN", 77, 503, 9, "db", "1.2.3.4")


def test_a_string_that_looks_like_an_object_stays_a_string(spark):
    assert parsed(spark, row(message='{"a":"{\\"b\\":1}"}'))[1].fields == {"a": '{"b":1}'}


def test_first_present_key_is_taken_even_if_it_is_no_number(spark):
    assert parsed(spark, row(message='{"user":"x","userId":"5"}'))[1].user_id is None


def test_columns_win_over_fields(spark):
    r = parsed(spark, row(level="info", service="s", message='{"level":"error","service":"t","user":1}', user=9))[1]
    assert (r.level, r.service, r.user_id) == ("INFO", "s", 9)


def test_malformed_json_is_quarantined_but_text_in_braces_is_not_always(spark):
    got = parsed(spark, row(1, message='{"a": }'), row(2, message="{not valid json"), row(3, message="{x}"))
    assert got[1].parse_error.startswith("IllegalArgumentException: malformed JSON message") and got[2].parse_error is None and got[3].parse_error is not None
    assert [r.source_id for r in parse.dead_letters(parse.parse(spark.createDataFrame([row(1, message='{"a": }')], RAW))).collect()] == [1]


def test_text_pairs_exception_and_thread(spark):
    r = parsed(spark, row(message='user=8821 traceId=xyz-1 msg="a b" user=9 exception=x thread=w [pool-1] java.io.IOException: y'))[1]
    assert r.fields == {"user": "9", "traceId": "xyz-1", "msg": "a b", "exception": "java.io.IOException", "thread": "w"} and r.user_id == 9


@pytest.mark.parametrize("raw,name", [("SEVERE", "ERROR"), ("err", "ERROR"), (" Warning ", "WARN"), ("panic", "FATAL"), ("zzz", "UNKNOWN"), (None, "UNKNOWN"), ("  ", "UNKNOWN")])
def test_levels(spark, raw, name):
    assert parsed(spark, row(level=raw))[1].level == name


@pytest.mark.parametrize("text,utc", [
    ("ts=1767268800", "2026-01-01 12:00:00"), ("timestamp=1767268800123", "2026-01-01 12:00:00.123"), ("time=2026-01-01T12:00:00Z", "2026-01-01 12:00:00"), ("time=2026-01-01T12:00:00.5+02:00", "2026-01-01 10:00:00.5"),
    ("time=2026-01-01T12:00", "2026-01-01 11:00:00"), ("time=2026-07-01T12:00:00", "2026-07-01 10:00:00"), ("time=2026-01-01T12:00Z", "2026-01-01 12:00:00"),
])
def test_time_in_the_message(spark, text, utc):
    got = parsed(spark, row(ts=None, message=text), zone="Europe/Berlin")[1].at
    assert got == dt.datetime.fromisoformat(utc)


@pytest.mark.parametrize("text", ["ts=yesterday", "time=2026-01-01", "ts=99999999999999999999", "nothing", None, ""])
def test_no_time(spark, text):
    r = parsed(spark, row(ts=None, message=text))[1]
    assert r.at is None and "timestamp" in r.parse_error


def test_naive_times_are_in_the_zone(spark):
    assert parsed(spark, row(ts=dt.datetime(2026, 7, 1, 12)), zone="Europe/Berlin")[1].at == dt.datetime(2026, 7, 1, 10)


def test_white_space(spark):
    r = parsed(spark, row(service=" \t ", message=" hi  ", ip=" 1 ", stack="\n"))[1]
    assert (r.service, r.message, r.ip, r.stack_trace) == (None, "hi ", "1", None)


def analyzed(spark, *rows):
    return {r.id: r for r in A.analyze(parse.events(parse.parse(spark.createDataFrame(list(rows), RAW)))).collect()}


def test_classification(spark):
    cases = [(401, None, "AUTH"), (429, None, "RATE_LIMIT"), (503, None, "SERVER_ERROR"), (404, None, "CLIENT_ERROR"), (None, "exception=MySQLError", "DATABASE"), (200, "exception=ConnectError", "NETWORK"), (None, "x.NullPointerException", "APPLICATION_BUG"), (None, "x.OddException", "EXCEPTION"), (None, "fine", "GENERAL")]
    got = analyzed(spark, *(row(i, status=s, message=m) for i, (s, m, _) in enumerate(cases)))
    assert [got[i].category for i in range(len(cases))] == [c for *_, c in cases]
    got = analyzed(spark, row(1, service="Order-API"), row(2, service="user-x"), row(3, service="search"), row(4, service="Own"), row(5), row(6, level="fatal"), row(7, level="warn"), row(8, status=400))
    assert [got[i].domain for i in range(1, 6)] == ["PAYMENTS", "ACCOUNT", "CATALOG", "Own", "UNKNOWN"]
    assert [got[i].severity for i in range(5, 9)] == ["NORMAL", "CRITICAL", "DEGRADED", "DEGRADED"]


def test_fingerprints(spark):
    stack = "java.lang.{}Exception: at {}\n\tat a.B.c(B.java:{})\n\tat a.D$$Lambda$14/0x0{}.run(D.java:1)\n"
    got = analyzed(spark, row(1, stack=stack.format("Null", 12, 10, "aa")), row(2, stack=stack.format("Null", 97, 99, "bb")), row(3, stack=stack.format("Other", 12, 10, "aa")), row(4, message="took 15 ms"), row(5, message="took 27 ms"), row(6, message="took 5 ms"))
    assert got[1].fingerprint == got[2].fingerprint != got[3].fingerprint
    assert got[4].fingerprint == got[5].fingerprint != got[6].fingerprint and len(got[4].fingerprint) == 16


def test_only_five_frames_count(spark):
    frames = "\n".join(f"at a.B.m{chr(97 + i)}(B.java:{i})" for i in range(7))
    got = analyzed(spark, row(1, stack="E\n" + frames), row(2, stack="E\n" + frames + "\nat z.Z.z(Z.java:1)"), row(3, stack="F\n" + frames))
    assert got[1].fingerprint == got[2].fingerprint != got[3].fingerprint


def test_trace_and_enrichment(spark):
    got = analyzed(spark, row(1, message="session=s1 trace_id=t1"), row(2, message="session=s1"), row(3, message="x"))
    assert [got[i].trace_id for i in (1, 2, 3)] == ["t1", "s1", None]
    events = parse.events(parse.parse(spark.createDataFrame([row(1, user=5, ip="9.9.9.9"), row(2)], RAW)))
    out = A.enrich(events, spark.createDataFrame([("9.9.9.9", "FR")], "ip string, c string"), spark.createDataFrame([(5, "gold")], "u long, s string"), "v7").collect()
    assert {r.id: r.enrichment for r in out} == {1: {"deploymentVersion": "v7", "geo": "FR", "segment": "gold"}, 2: {"deploymentVersion": "v7"}}


def test_empty_input(spark):
    assert A.analyze(parse.events(parse.parse(spark.createDataFrame([], RAW)))).count() == 0


def test_documents(spark):
    rows = [row(5, service="pay", message="user=7 a=\"x y\"", status=503, ts=dt.datetime(2026, 1, 1, 12, 0, 0, 120000)), row(6)]
    docs = documents.documents(A.enrich(A.analyze(parse.events(parse.parse(spark.createDataFrame(rows, RAW)))), version="v1"))
    body = {r.es_id: r for r in docs.collect()}
    d = json.loads(body["applog-5"].body)
    assert list(d) == DOCUMENT.names and d["@timestamp"] == "2026-01-01T12:00:00.120Z" and d["userId"] == 7 and d["fields"] == {"a": "x y", "user": "7"} and d["enrichment"] == {"deploymentVersion": "v1"}
    e = json.loads(body["applog-6"].body)
    assert list(e) == DOCUMENT.names and e["service"] is None and e["@timestamp"] == "2026-01-01T12:00:00Z" and e["fields"] == {}
    assert body["applog-5"].target_index == "app-logs-2026.01.01" and body["applog-5"].n_bytes == len(body["applog-5"].body.encode())
    back = {r.es_id: r for r in documents.read_documents(docs).collect()}
    assert back["applog-5"].sourceId == 5 and back["applog-5"].severity == "CRITICAL" and back["applog-6"].synthetic is False
    mapped = documents.index_template()["template"]["mappings"]["properties"]
    assert list(mapped) == DOCUMENT.names and mapped["ip"]["ignore_malformed"] and mapped["statusCode"] == {"type": "integer"} and mapped["fields"] == {"type": "object", "dynamic": True}


def test_white_space_is_that_of_the_jvm(spark):
    every = [chr(c) for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c,) for c in every], "c string")
    got = df.select("c", (X.strip(F.col("c")) == "").alias("a"), F.col("c").rlike(r"^\p{javaWhitespace}$").alias("b")).where("a <> b").collect()
    assert got == []
    one = spark.createDataFrame([("\t a b\u2003\n",), ("",), (None,), ("\u00a0x ",)], "c string").select(X.strip(F.col("c")).alias("s")).collect()
    assert [r.s for r in one] == ["a b", "", None, "\u00a0x"]


def test_lines_are_scrubbed_at_once(spark):
    rng = random.Random(3)
    texts = ["\n".join("".join(rng.choice(["at ", "x", "12", ":7", "@ab", "0xF", " ", "\t", "$$Lambda$1/0xa", "é", "\u2003"]) for _ in range(rng.randint(0, 8))).strip() for _ in range(4)) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    each = F.array_join(F.transform(F.split("c", "\n"), X.scrub), "\n")
    assert df.where(X.scrub_lines(F.col("c")) != each).count() == 0


def test_json_of_any_depth(spark):
    deep = '{"a":' * 30 + '{"b": 1, "c": "{"}' + "}" * 30
    r = parsed(spark, row(message=deep))[1]
    assert r.fields == {".".join("a" * 30) + ".b": "1", ".".join("a" * 30) + ".c": "{"} and r.parse_error is None


def test_times_after_the_year_9999(spark):
    df = parse.parse(spark.createDataFrame([row(i=k, ts=None, message=m) for k, m in ((1, "ts=253402300800"), (2, "ts=999999999999999"), (3, "ts=9223372036854775807"))], RAW))
    got = {r.id: (r.ms, r.parse_error is None) for r in df.select("id", F.unix_millis("at").alias("ms"), "parse_error").collect()}
    assert got == {1: (253402300800000, True), 2: (999999999999999, True), 3: (None, False)}
