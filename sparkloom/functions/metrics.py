"""Counters and gauges, and the HTTP surface for probes and scraping."""

from __future__ import annotations

import threading
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

COUNTERS = ("rows.extracted", "rows.parsed", "deadletter.parse", "events.analyzed", "alerts.raised", "docs.indexed", "deadletter.index", "bulk.retries", "run.failures")
TIMERS = ("index.latency", "run.latency")
GAUGES = ("last.run.epoch.seconds", "backlog.estimate")


class Metrics:
    def __init__(self):
        self._lock = threading.Lock()
        self.values = {k: 0 for k in (*COUNTERS, *TIMERS, *GAUGES)}
        self.times = {k: 0 for k in TIMERS}

    def add(self, name: str, value: float = 1) -> None:
        with self._lock:
            self.values[name] += value
            if name in self.times:
                self.times[name] += 1

    def set(self, name: str, value: float) -> None:
        with self._lock:
            self.values[name] = value

    def text(self) -> str:
        """The Prometheus text format."""
        out = []
        with self._lock:
            for name, value in self.values.items():
                plain = "pipeline_" + name.replace(".", "_")
                if name in self.times:
                    out += [f"# TYPE {plain}_seconds summary", f"{plain}_seconds_count {self.times[name]}", f"{plain}_seconds_sum {value}"]
                else:
                    kind, tail = ("gauge", "") if name in GAUGES else ("counter", "_total")
                    out += [f"# TYPE {plain}{tail} {kind}", f"{plain}{tail} {value}"]
        return "\n".join(out) + "\n"


def serve(metrics: Metrics, ready: Callable[[], bool], port: int) -> ThreadingHTTPServer:
    """/health/live, /health/ready and /metrics on a daemon thread; port 0 takes a free one."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            if self.path == "/health/live":
                code, body = 200, '{"status":"UP"}'
            elif self.path == "/health/ready":
                code, body = (200, '{"status":"READY"}') if ready() else (503, '{"status":"NOT_READY"}')
            elif self.path == "/metrics":
                code, body = 200, metrics.text()
            else:
                code, body = 404, ""
            self.send_response(code)
            self.send_header("Content-Type", "text/plain; version=0.0.4" if self.path == "/metrics" else "application/json")
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("", port), Handler)
    threading.Thread(target=server.serve_forever, daemon=True, name="sparkloom-probes").start()
    return server
