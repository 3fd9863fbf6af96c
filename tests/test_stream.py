"""State, and the stream against the same batches evaluated at once."""

import datetime as dt
import urllib.error
import urllib.request

import pytest
from pyspark.sql import functions as F

from sparkloom.config import Config
from sparkloom.functions.metrics import Metrics, serve
from sparkloom.plans.batch import build
from sparkloom.schema import RAW
from sparkloom.sources.state import Checkpoint, MemoryBaselines, StoredBaselines, baselines, parse_dead_letters
from sparkloom.streaming.stream import Pipeline, catch_up, read_files, start

C = Config(batch_size=40, window_seconds=600, anomaly_min_events=10, anomaly_failed_login_threshold=3)


def rows(n):
    out = []
    for i in range(1, n + 1):
        ts = dt.datetime(2026, 1, 1) + dt.timedelta(seconds=20 * i - (900 if i % 17 == 0 else 0))
        bad = 100 < i < 160
        out.append((i, ts, "error" if bad and i % 2 else "info", f"svc-{i % 2}", '{"a": }' if i % 23 == 0 else f"user={i}", None, "1.1.1.1" if i % 5 == 0 else None, 401 if i % 5 == 0 else 200, i % 7, None))
    return out


def test_checkpoint_never_falls(spark, tmp_path):
    mark = Checkpoint(spark, f"file://{tmp_path}/c")
    assert mark.read("p") == 0 and mark.advance("p", 100) == 100 and mark.advance("p", 50) == 100 and mark.advance("p", 150) == 150 and mark.read("q") == 0


def test_dead_letters_by_key(spark, tmp_path):
    dead = parse_dead_letters(spark, f"file://{tmp_path}/d")
    new = lambda *r: spark.createDataFrame(list(r), "source_id long, raw_message string, reason string")
    dead.add(new((1, "a", "x"), (2, "b", "x")))
    first = {r.source_id: r for r in dead.table.read().collect()}
    dead.add(new((1, "c", "y")))
    now = {r.source_id: r for r in dead.table.read().collect()}
    assert set(now) == {1, 2} and now[1].reason == "y" and now[1].failed_at == first[1].failed_at


def test_baselines(spark, tmp_path):
    kept = baselines(spark, f"file://{tmp_path}/b", "p:")
    assert isinstance(kept, StoredBaselines) and kept.get("k") is None
    kept.set("k", 0.25)
    assert baselines(spark, f"file://{tmp_path}/b", "p:").get("k") == 0.25
    assert isinstance(baselines(spark, None), MemoryBaselines) and isinstance(baselines(spark, "nosuch://x/y"), MemoryBaselines)


def test_stream_is_the_batch_run_and_replays_change_nothing(spark, tmp_path):
    data = rows(200)
    for k in range(5):
        spark.createDataFrame(data[40 * k : 40 * k + 40], RAW).coalesce(1).write.parquet(f"{tmp_path}/in{k}")
    want = build(spark.createDataFrame(data, RAW), C)
    pipeline = Pipeline(spark, f"file://{tmp_path}/out", C)
    for k in range(5):
        pipeline.process(spark.read.parquet(f"{tmp_path}/in{k}"), k)
        if k == 3:  # the same batch again, as after a failure before its commit
            pipeline.process(spark.read.parquet(f"{tmp_path}/in{k}"), k)
    got = spark.read.parquet(f"{tmp_path}/out/snapshots")
    assert [tuple(r) for r in got.orderBy("e").select("total", "errors").collect()] == [tuple(r) for r in want.snapshots.orderBy("e").select("total", "errors").collect()]
    key = lambda df: sorted((r.rule, r.subject, r.at, r.message) for r in df.collect())
    alerts = key(want.alerts)
    assert alerts and key(spark.read.parquet(f"{tmp_path}/out/alerts")) == alerts
    docs = spark.read.json(f"{tmp_path}/out/documents")
    assert docs.where("es_id like 'applog-%'").count() == 200 - 200 // 23
    assert pipeline.parse_dead.table.read().count() == 200 // 23


def test_structured_stream(spark, tmp_path):
    for k in range(3):
        spark.createDataFrame(rows(120)[40 * k : 40 * k + 40], RAW).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    pipeline = Pipeline(spark, f"file://{tmp_path}/out", C)
    query = start(read_files(spark, f"{tmp_path}/in", RAW), pipeline, once=True)
    assert query.awaitTermination(120) and query.exception() is None
    assert spark.read.parquet(f"{tmp_path}/out/snapshots").agg(F.count("*")).first()[0] == 3 and pipeline.ready
    assert pipeline.metrics.values["rows.extracted"] == 120


def test_http_surface():
    metrics, ready = Metrics(), [False]
    server = serve(metrics, lambda: ready[0], 0)
    get = lambda path: urllib.request.urlopen(f"http://127.0.0.1:{server.server_address[1]}{path}", timeout=5)
    metrics.add("rows.parsed", 3)
    assert get("/health/live").status == 200 and b"pipeline_rows_parsed_total 3" in get("/metrics").read()
    with pytest.raises(urllib.error.HTTPError, match="503"):
        get("/health/ready")
    ready[0] = True
    assert get("/health/ready").status == 200
    server.shutdown()


def test_catch_up_resumes_after_a_failure(spark, tmp_path):
    raw = spark.createDataFrame(rows(100), RAW)
    pipeline, marks = Pipeline(spark, f"file://{tmp_path}/out", C), Checkpoint(spark, f"file://{tmp_path}/marks")
    deliver, calls = pipeline._deliver, []

    def broken(docs, batch):
        calls.append(batch)
        if len(calls) == 2:
            raise OSError("down")
        deliver(docs, batch)

    pipeline._deliver = broken
    with pytest.raises(OSError):
        catch_up(raw, pipeline, marks)
    assert marks.read("app-logs") == 40 and pipeline.metrics.values["run.failures"] == 1 and pipeline.metrics.values["backlog.estimate"] == 100
    assert catch_up(raw, pipeline, marks) == 60 and catch_up(raw, pipeline, marks) == 0 and marks.read("app-logs") == 100
    assert calls == [0, 1, 1, 2]
    want = build(raw, C).snapshots.orderBy("e").select("total", "errors").collect()
    assert spark.read.parquet(f"{tmp_path}/out/snapshots").orderBy("e").select("total", "errors").collect() == want
