"""The main flow from its settings, against a local receiver; and the supervisor of the stream."""

import threading
import time
import urllib.error
import urllib.request

import pytest

from sparkloom import config
from sparkloom.runner import App
from sparkloom.schema import RAW
from sparkloom.streaming.stream import Supervisor

from .test_delivery import Server
from .test_stream import rows


def settings(tmp_path, server=None, **more):
    own = {"source.path": f"file://{tmp_path}/in", "state.path": f"file://{tmp_path}/state", "batch.size": "40", "window.seconds": "600", "anomaly.min.events": "10", "anomaly.failed.login.threshold": "3", "bulk.base.delay.ms": "0", "bulk.max.delay.ms": "0", "run.interval.seconds": "0"}
    if server:
        own |= {"es.host": "127.0.0.1", "es.port": str(server.server.server_address[1])}
    return config.load(own | more, {})


def test_files_to_the_receiver(spark, tmp_path):
    spark.createDataFrame(rows(100), RAW).coalesce(1).write.parquet(f"{tmp_path}/in")
    with Server() as server:
        app = App(spark, settings(tmp_path, server))
        assert not app.ready() and app.reachable()
        assert app.tick() == 100 and app.ready() and app.marks.read("app-logs") == 100
        sent = {line for _, _, body in server.got for line in body.splitlines() if "applog-" in line}
        assert len(sent) == 100 - 100 // 23 and any("alert-" in body for _, _, body in server.got)
        assert app.pipeline.baselines.get("error_rate") is not None
        assert app.pipeline.parse_dead.table.read().count() == 100 // 23
        spark.createDataFrame(rows(130)[100:], RAW).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        server.answers += [(503, "")] * 4
        assert app.tick() == -1 and app.failures == 1 and app.marks.read("app-logs") == 100
        assert app.tick() == 30 and app.tick() == 0 and app.marks.read("app-logs") == 130
        # another start goes on where this one ended
        again = App(spark, settings(tmp_path, server))
        assert again.tick() == 0 and again.pipeline.baselines.get("error_rate") == app.pipeline.baselines.get("error_rate")


def test_run_and_stop(spark, tmp_path):
    spark.createDataFrame(rows(40), RAW).coalesce(1).write.parquet(f"{tmp_path}/in")
    app = App(spark, settings(tmp_path, sink="files"))
    server = app.serve(0)
    get = lambda path: urllib.request.urlopen(f"http://127.0.0.1:{server.server_address[1]}{path}", timeout=20).status
    with pytest.raises(urllib.error.HTTPError, match="503"):
        get("/health/ready")
    loop = threading.Thread(target=app.run)
    loop.start()
    for _ in range(300):
        if app.marks.read("app-logs") == 40:
            break
        time.sleep(0.1)
    assert get("/health/ready") == 200 and app.stop()
    loop.join(20)
    assert not loop.is_alive() and spark.read.json(f"{tmp_path}/state/documents").count() >= 39
    app.c = config.Config(source_path=f"file://{tmp_path}/gone")
    with pytest.raises(urllib.error.HTTPError, match="503"):
        get("/health/ready")
    server.shutdown()


def test_sources_that_cannot_be_reached(spark, tmp_path):
    app = App(spark, settings(tmp_path, **{"source.path": "", "db.url": "jdbc:none://nowhere"}))
    assert not app.reachable() and app.tick() == -1 and app.failures == 1


class Query:
    def __init__(self, fails):
        self.fails, self.ended = fails, threading.Event()

    def awaitTermination(self, timeout=None):
        if self.fails:
            raise RuntimeError("failed")
        return self.ended.wait(timeout)

    def exception(self):
        return None

    def stop(self):
        self.ended.set()


def test_supervisor_starts_a_failed_stream_anew():
    begun = []

    def begin():
        begun.append(Query(len(begun) < 2))
        return begun[-1]

    supervisor = Supervisor(begin, config.Config(run_interval_seconds=0))
    loop = threading.Thread(target=supervisor.run)
    loop.start()
    for _ in range(100):
        if len(begun) == 3:
            break
        time.sleep(0.1)
    supervisor.stop()
    loop.join(5)
    assert len(begun) == 3 and supervisor.failures == 2 and not loop.is_alive()
