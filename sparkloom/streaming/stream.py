"""The flow as a stream: every micro-batch is one evaluation.

State N+1 - the live suffix of the window, watermark and baseline - is a function of state N
and batch N alone, and outputs are written under the batch's number. So a batch that runs
again after a failure gives the same state and overwrites its own output: nothing is counted
twice. Late events are kept, so there is no Spark watermark.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions.metrics import Metrics
from ..operators import analyze as A
from ..operators import delivery, detect, documents, parse, window
from ..sources import app_logs
from ..sources.state import Baselines, Checkpoint, MemoryBaselines, Versions, index_dead_letters, parse_dead_letters

BASELINE = "error_rate"
_LIVE = ("id", "at", "service", "is_error", "is_auth", "ip", "latency_ms", "eff")


class Pipeline:
    """Processes micro-batches; ``process`` fits foreachBatch."""

    def __init__(self, spark: SparkSession, path: str, c: Config, metrics: Metrics | None = None, transport: Callable[[], delivery.Transport] | None = None, geo: DataFrame | None = None, segments: DataFrame | None = None, baselines: Baselines | None = None):
        parse.prepare(spark)
        self.spark, self.path, self.c, self.metrics, self.transport, self.geo, self.segments = spark, path.rstrip("/"), c, metrics or Metrics(), transport, geo, segments
        self.live, self.meta = Versions(spark, f"{self.path}/state/live"), Versions(spark, f"{self.path}/state/meta")
        self.parse_dead, self.index_dead = parse_dead_letters(spark, f"{self.path}/parse_dead_letter"), index_dead_letters(spark, f"{self.path}/index_dead_letter")
        self.baselines = MemoryBaselines() if baselines is None else baselines
        self.ready = False

    def _state(self, n: int) -> tuple[DataFrame | None, int, float | None]:
        """Live entries, watermark in microseconds and baseline after batch n; at a start without
        state, the baseline that was stored last."""
        meta = self.meta.read(n)
        if meta is None:
            return None, 0, self.baselines.get(BASELINE)
        row = meta.first()
        return self.live.read(n), row.watermark_us, row.ema

    def process(self, raw: DataFrame, batch: int) -> None:
        began = time.time()
        try:
            self._process(raw, batch)
        except Exception:
            self.metrics.add("run.failures")
            raise
        self.ready = True
        self.metrics.set("last.run.epoch.seconds", time.time())
        self.metrics.add("run.latency", time.time() - began)

    def _process(self, raw: DataFrame, batch: int) -> None:
        c = self.c
        parsed = parse.parse(raw.withColumn("batch_id", F.lit(batch)), c.source_zone, keep=("batch_id",)).persist()
        try:
            n = parsed.agg(F.count("*").alias("rows"), F.count_if(F.col("parse_error").isNull()).alias("good")).first()
            self.metrics.add("rows.extracted", n.rows)
            self.metrics.add("rows.parsed", n.good)
            if n.rows > n.good:
                self.metrics.add("deadletter.parse", n.rows - n.good)
                self.parse_dead.add(parse.dead_letters(parsed))
            live, mark, ema = self._state(batch - 1)
            if n.good == 0:
                self._keep(batch, live, mark, ema)
                return
            self._evaluate(parsed, batch, live, mark, ema)
        finally:
            parsed.unpersist()

    def _keep(self, batch: int, live: DataFrame | None, mark: int, ema: float | None) -> None:
        if live is not None:
            self.live.write(live, batch)
            self.meta.write(self.spark.createDataFrame([(mark, ema)], "watermark_us long, ema double"), batch)

    def _evaluate(self, parsed: DataFrame, batch: int, live: DataFrame | None, mark: int, ema: float | None) -> None:
        c = self.c
        analyzed = A.enrich(A.analyze(window.dedupe(parse.events(parsed))), self.geo, self.segments, c.deployment_version)
        new = window.entries(analyzed)
        if live is not None:  # what is in the window already isn't counted again
            new = new.join(live.where("id > 0").select("id"), "id", "left_anti")
        new = window.track(new).withColumn("eff", F.greatest("eff", F.timestamp_micros(F.lit(mark))))
        both = new.select(*_LIVE) if live is None else live.select(*_LIVE).unionByName(new.select(*_LIVE))
        both = both.persist()
        try:
            top = both.agg(F.unix_micros(F.max("eff")).alias("m")).first().m
            mark = max(mark, top or 0)
            inside = both.where(F.unix_micros("eff") >= mark - c.window_seconds * 1_000_000)
            self.live.write(inside, batch)
            inside = self.live.read(batch)
            row = inside.agg(F.count("*").alias("total"), F.count_if("is_error").alias("errors")).first()
            rate = row.errors / row.total if row.total else 0.0
            e = F.timestamp_micros(F.lit(mark))
            snap = self.spark.createDataFrame([(batch, row.total, row.errors, rate, ema)], "e long, total long, errors long, error_rate double, baseline double").withColumn("watermark", e)
            evals = snap.select("e", "watermark")
            counts = lambda rows, key: rows.groupBy(key).agg(F.count("*").alias("n")).withColumn("e", F.lit(batch).cast("long"))
            alerts = detect.spike_alerts(snap, c).unionByName(detect.service_alerts(counts(inside.where("is_error"), "service"), evals, c)).unionByName(detect.login_alerts(counts(inside.where("is_auth and ip is not null"), "ip"), evals, c))
            docs = documents.documents(analyzed).unionByName(documents.documents(documents.alert_events(alerts)))
            self._deliver(docs, batch)
            alerts.write.mode("overwrite").parquet(f"{self.path}/alerts/batch={batch:012d}")
            snap.write.mode("overwrite").parquet(f"{self.path}/snapshots/batch={batch:012d}")
            self.metrics.add("events.analyzed", analyzed.count())
            self.metrics.add("alerts.raised", alerts.count())
            if row.total >= c.anomaly_min_events:
                ema = rate if ema is None else c.anomaly_ema_alpha * rate + (1 - c.anomaly_ema_alpha) * ema
                self.baselines.set(BASELINE, ema)
            self.meta.write(self.spark.createDataFrame([(mark, ema)], "watermark_us long, ema double"), batch)
        finally:
            both.unpersist()

    def _deliver(self, docs: DataFrame, batch: int) -> None:
        if self.transport is None:
            docs.write.mode("overwrite").partitionBy("target_index").json(f"{self.path}/documents/batch={batch:012d}")
            self.metrics.add("docs.indexed", docs.count())
            return
        began = time.time()
        told = delivery.deliver(docs, self.transport, self.c).persist()
        try:
            sums = told.agg(F.sum("indexed").alias("indexed"), F.sum("retries").alias("retries"), F.count("es_id").alias("dead")).first()
            if sums.dead:
                self.index_dead.add(told.where("es_id is not null").drop("indexed", "retries"))
            for name, value in (("docs.indexed", sums.indexed), ("bulk.retries", sums.retries), ("deadletter.index", sums.dead)):
                self.metrics.add(name, value or 0)
        finally:
            told.unpersist()
        self.metrics.add("index.latency", time.time() - began)


def catch_up(raw: DataFrame, pipeline: Pipeline, marks: Checkpoint, stopped: Callable[[], bool] = lambda: False) -> int:
    """Pages through a table by its key until a short page, or until ``stopped`` says so between
    pages; returns the rows read.

    A page's number is stored with the mark, so a page that failed comes again under the same
    number and replaces what it left. For large backlogs use plans.batch.Flow, which takes all
    pages at once.
    """
    c, rows = pipeline.c, 0
    cursor = marks.read(c.pipeline_name)
    try:
        pipeline.metrics.set("backlog.estimate", app_logs.backlog(raw, cursor).first().backlog or 0)
    except Exception:  # noqa: BLE001  the estimate is for the gauge only
        pass
    while True:
        page = app_logs.page(raw, cursor, c.batch_size).persist()
        try:
            found = page.agg(F.count("*").alias("n"), F.max("id").alias("top")).first()
            if found.n == 0:
                return rows
            number = marks.read(f"{c.pipeline_name}:pages")
            pipeline.process(page, number)
            cursor = marks.advance(c.pipeline_name, found.top, pages=number + 1)
            rows += found.n
            if found.n < c.batch_size or stopped():
                return rows
        finally:
            page.unpersist()


def start(raw: DataFrame, pipeline: Pipeline, once: bool = False):
    """Runs the stream: all there is and then stop, or at the run interval for good."""
    writer = raw.writeStream.foreachBatch(pipeline.process).option("checkpointLocation", f"{pipeline.path}/checkpoint").queryName(pipeline.c.pipeline_name)
    trigger = {"availableNow": True} if once else {"processingTime": f"{max(1, pipeline.c.run_interval_seconds)} seconds"}
    return writer.trigger(**trigger).start()


def read_files(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


class Supervisor:
    """Starts the stream anew when it fails, never two at a time; ``stop`` waits for the grace time."""

    def __init__(self, begin: Callable[[], object], c: Config):
        self.begin, self.c = begin, c
        self._stop, self.query, self.failures = threading.Event(), None, 0

    def run(self) -> None:
        while not self._stop.is_set():
            try:
                self.query = self.begin()
                self.query.awaitTermination()
                if self.query.exception() is None:
                    return
            except Exception:  # noqa: BLE001  the next tick tries again
                self.failures += 1
            self._stop.wait(max(1, self.c.run_interval_seconds))

    def stop(self) -> None:
        self._stop.set()
        if self.query is not None:
            self.query.stop()
            self.query.awaitTermination(self.c.shutdown_grace_seconds)
