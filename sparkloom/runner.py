"""The whole pipeline from its settings: source, state, sink, probes and the loop that runs it."""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from .config import Config
from .functions.metrics import Metrics, serve
from .operators import delivery
from .sources import app_logs
from .sources.state import Checkpoint, baselines
from .streaming.stream import Pipeline, catch_up


class App:
    """Runs catch-ups at the run interval, one after another; a failed one is tried again at the next.

    Every catch-up reads the source from the mark on, in pages of the batch size, and moves the
    mark when a page's documents are delivered and its state is written.
    """

    def __init__(self, spark: SparkSession, c: Config, transport: Callable[[], delivery.Transport] | None = None, geo: DataFrame | None = None, segments: DataFrame | None = None):
        self.spark, self.c, self.metrics = spark, c, Metrics()
        if transport is None and c.sink == "http":
            transport = partial(delivery.HttpTransport, c)
        path = c.state_path.rstrip("/")
        self.marks = Checkpoint(spark, f"{path}/marks")
        self.pipeline = Pipeline(spark, path, c, self.metrics, transport, geo, segments, baselines(spark, f"{path}/baselines", c.redis_key_prefix))
        self.failures, self._stop, self._idle = 0, threading.Event(), threading.Event()
        self._idle.set()

    def source(self) -> DataFrame:
        if self.c.source_path:
            return app_logs.read_parquet(self.spark, self.c.source_path)
        return app_logs.read_jdbc(self.spark, self.c, self.c.source_table, self.marks.read(self.c.pipeline_name))

    def reachable(self) -> bool:
        """Whether the source answers now."""
        try:
            return bool(self.source().columns) if not self.c.source_path else app_logs.exists(self.spark, self.c.source_path)
        except Exception:  # noqa: BLE001  whatever it is, there is no source
            return False

    def ready(self) -> bool:
        return self.pipeline.ready and self.reachable()

    def tick(self) -> int:
        """One catch-up; the rows read, or -1 if it failed."""
        self._idle.clear()
        try:
            return catch_up(self.source(), self.pipeline, self.marks, self._stop.is_set)
        except Exception:  # noqa: BLE001  the next tick tries again
            self.failures += 1
            return -1
        finally:
            self._idle.set()

    def run(self) -> None:
        while not self._stop.is_set():
            self.tick()
            self._stop.wait(max(1, self.c.run_interval_seconds))

    def stop(self) -> bool:
        """No further page begins; waits for the present one, cancels it after the grace time.
        Returns whether it came to its end."""
        self._stop.set()
        done = self._idle.wait(self.c.shutdown_grace_seconds)
        if not done:
            self.spark.sparkContext.cancelAllJobs()
        return done

    def serve(self, port: int | None = None):
        return serve(self.metrics, self.ready, self.c.health_port if port is None else port)
