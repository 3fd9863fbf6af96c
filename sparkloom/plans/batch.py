"""The whole flow over a bounded input."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from ..config import Config
from ..operators import analyze as A
from ..operators import detect, documents, parse, window
from ..sources.scratch import settle


class Flow:
    """One catch-up run: batches are numbered over all rows by id, and each with an event is
    evaluated at its end. A part is made when it is first asked for; what other parts use
    several times is written once."""

    def __init__(self, raw: DataFrame, c: Config, geo: DataFrame | None = None, segments: DataFrame | None = None):
        self.raw, self.c, self.geo, self.segments = raw, c, geo, segments

    def _parse(self) -> DataFrame:
        return parse.parse(window.number_batches(self.raw, self.c.batch_size), self.c.source_zone, keep=("batch_id",))

    @cached_property
    def parsed(self) -> DataFrame:
        return settle(self._parse(), "parsed")

    @cached_property
    def dead(self) -> DataFrame:
        return parse.dead_letters(self.parsed)

    @cached_property
    def analyzed(self) -> DataFrame:
        return A.enrich(A.analyze(window.dedupe(parse.events(self.parsed))), self.geo, self.segments, self.c.deployment_version)

    @cached_property
    def tracked(self) -> DataFrame:
        # the window needs a few columns only: unless the parsed rows are there, they aren't written for it
        analyzed = self.analyzed if "parsed" in self.__dict__ else A.analyze(window.dedupe(parse.events(self._parse())))
        return settle(window.track(settle(window.entries(analyzed), "entries")), "tracked")

    @cached_property
    def evaluations(self) -> DataFrame:
        return settle(window.evaluations(self.tracked), "evaluations")

    @cached_property
    def snapshots(self) -> DataFrame:
        return settle(window.snapshots(self.tracked, self.evaluations, self.c.window_seconds), "snapshots")

    @cached_property
    def baselines(self) -> DataFrame:
        return detect.baselines(self.snapshots, self.c.anomaly_ema_alpha, self.c.anomaly_min_events)

    @cached_property
    def errors_by_service(self) -> DataFrame:
        return window.errors_by_service(self.tracked, self.evaluations, self.c.window_seconds)

    @cached_property
    def failed_logins_by_ip(self) -> DataFrame:
        return window.failed_logins_by_ip(self.tracked, self.evaluations, self.c.window_seconds)

    @cached_property
    def latency_by_service(self) -> DataFrame:
        return window.latency_by_service(self.tracked, self.evaluations, self.c.window_seconds)

    @cached_property
    def spike_alerts(self) -> DataFrame:
        return detect.spike_alerts(self.baselines, self.c)

    @cached_property
    def service_alerts(self) -> DataFrame:
        counts = window.errors_by_service(self.tracked, self.evaluations, self.c.window_seconds, detect.service_limit(self.c))
        return detect.service_alerts(counts, self.evaluations, self.c)

    @cached_property
    def login_alerts(self) -> DataFrame:
        counts = window.failed_logins_by_ip(self.tracked, self.evaluations, self.c.window_seconds, self.c.anomaly_failed_login_threshold)
        return detect.login_alerts(counts, self.evaluations, self.c)

    @cached_property
    def alerts(self) -> DataFrame:
        return self.spike_alerts.unionByName(self.service_alerts).unionByName(self.login_alerts)

    @cached_property
    def documents(self) -> DataFrame:
        own = documents.documents(self.analyzed)
        return own.unionByName(documents.documents(documents.alert_events(self.alerts)))


def build(raw: DataFrame, c: Config, geo: DataFrame | None = None, segments: DataFrame | None = None) -> Flow:
    return Flow(raw, c, geo, segments)
