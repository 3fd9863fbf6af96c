import pytest

from sparkloom import config
from sparkloom.operators import delivery as D

OPS = [D.Operation(f"d{i}", "app-logs-x", "{}" + "x" * 8) for i in range(10)]
FAST = config.Config(bulk_base_delay_ms=0, bulk_max_delay_ms=0)


class Fake:
    def __init__(self, *answers):
        self.answers, self.calls = list(answers), []

    def bulk(self, operations):
        self.calls.append([o.es_id for o in operations])
        answer = self.answers.pop(0) if self.answers else []
        if isinstance(answer, Exception):
            raise answer
        return [D.ItemFailure(o, status, "why") for o in operations for i, status in answer if o.es_id == i]


def test_requests():
    ops = [D.Operation(str(i), "x", "b" * 10) for i in range(1000)]
    assert [len(r) for r in D.requests(ops, 500, 1 << 20)] == [500, 500]
    assert [len(r) for r in D.requests(ops[:5], 500, 15)] == [1] * 5
    assert [len(r) for r in D.requests(ops[:5], 500, 20)] == [2, 2, 1]
    assert [len(r) for r in D.requests([D.Operation("a", "x", "é" * 50), *ops[:2]], 500, 20)] == [1, 2]
    assert list(D.requests([], 5, 5)) == []


def test_a_busy_receiver_is_asked_again():
    fake = Fake([("d3", 429), ("d4", 503)], [])
    out = D.send(OPS, fake, FAST)
    assert (out.indexed, out.dead, out.retries, fake.calls[1]) == (10, [], 1, ["d3", "d4"])


def test_a_refused_document_is_not_sent_again():
    fake = Fake([("d1", 400)])
    out = D.send(OPS, fake, FAST)
    assert out.indexed == 9 and [(f.operation.es_id, f.http_status) for f in out.dead] == [("d1", 400)] and len(fake.calls) == 1


def test_retries_run_out():
    fake = Fake(*[[("d1", 503), ("d2", 503)]] * 9)
    out = D.send(OPS, fake, FAST)
    assert len(fake.calls) == 4 and out.indexed == 8 and [(f.http_status, f.reason) for f in out.dead] == [(0, "retries exhausted")] * 2


def test_a_dead_transport_stops_the_batch():
    with pytest.raises(D.DeliveryError):
        D.send(OPS, Fake(*[D.TransportError("down")] * 9), FAST)
    assert D.send(OPS, Fake(D.TransportError("down")), FAST).indexed == 10


def test_delays():
    assert all(0 <= D.delay_ms(a, 100, 500) <= min(500, 100 << (a - 1)) for a in range(1, 40) for _ in range(20))


def test_config():
    c = config.load({"batch.size": "7", "es.host": " ", "window.seconds": "9"}, {"WINDOW_SECONDS": "60", "ES_HOST": " "})
    assert (c.batch_size, c.es_host, c.window_seconds, c.anomaly_ema_alpha) == (7, "localhost", 60, 0.3)
    for bad in ({"batch.size": "0"}, {"anomaly.ema.alpha": "1.5"}, {"batch.size": "x"}, {"run.interval.seconds": "-1"}):
        with pytest.raises(ValueError, match="Invalid configuration"):
            config.load(bad, {})


def test_deliver_in_tasks(spark):
    docs = spark.createDataFrame([(f"applog-{i}", "t", "{}") for i in range(100)], "es_id string, target_index string, body string")
    out = D.deliver(docs, lambda: Fake([(f"applog-{i}", 400) for i in range(100)]), FAST).collect()
    assert sum(r.es_id is not None for r in out) == 100 and sum(r.indexed for r in out) == 0


def test_a_stopped_sender_gives_up():
    waits = []
    with pytest.raises(D.DeliveryError, match="stopped"):
        D.send(OPS, Fake(*[[("d1", 503)]] * 9), config.Config(bulk_base_delay_ms=10**6, bulk_max_delay_ms=10**6), waits.append, lambda: len(waits) >= 2)
    assert len(waits) == 2 and all(w <= D.TICK for w in waits)


class Server:
    """A bulk endpoint that answers what it is told to."""

    def __enter__(self):
        import threading
        from http.server import BaseHTTPRequestHandler, HTTPServer

        self.got, self.answers, own = [], [], self

        class Handler(BaseHTTPRequestHandler):
            def do_POST(self):
                own.got.append((self.path, dict(self.headers), self.rfile.read(int(self.headers["Content-Length"])).decode()))
                code, body = own.answers.pop(0) if own.answers else (200, None)
                if body is None:
                    import json

                    body = json.dumps({"items": [{"index": {"status": 201}} for _ in own.got[-1][2].strip().splitlines()[::2]]})
                self.send_response(code)
                self.end_headers()
                self.wfile.write(body.encode())

            def log_message(self, *args):
                pass

        self.server = HTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        return self

    def config(self, **more):
        return config.Config(es_host="127.0.0.1", es_port=self.server.server_address[1], bulk_base_delay_ms=0, bulk_max_delay_ms=0, **more)

    def __exit__(self, *_):
        self.server.shutdown()
        self.server.server_close()


def test_http_transport():
    with Server() as server:
        to = D.HttpTransport(server.config(es_api_key="k", es_username="u"))
        assert to.bulk(OPS[:2]) == []
        path, headers, body = server.got[0]
        assert path == "/_bulk" and headers["Authorization"] == "ApiKey k" and headers["Content-Type"] == "application/x-ndjson"
        assert body == "".join(f'{{"index": {{"_index": "app-logs-x", "_id": "{o.es_id}"}}}}\n{o.body}\n' for o in OPS[:2])
        server.answers.append((200, '{"items": [{"index": {"status": 400, "error": {"reason": "bad"}}}, {"index": {"status": 429, "error": "busy"}}]}'))
        assert [(f.operation.es_id, f.http_status, f.reason, f.retryable) for f in to.bulk(OPS[:2])] == [("d0", 400, "bad", False), ("d1", 429, "busy", True)]
        for code, body in ((500, "{}"), (200, "no json"), (200, "{}"), (200, '{"items": [{"index": {"status": 201}}]}')):  # the last answers one of two
            server.answers.append((code, body))
            with pytest.raises(D.TransportError):
                to.bulk(OPS[:2])
        assert "Basic" in D.HttpTransport(server.config(es_username="u", es_password="p")).headers["Authorization"]
    with pytest.raises(D.TransportError):
        to.bulk(OPS[:1])


def test_requests_of_an_index_are_streamed(spark):
    docs = spark.createDataFrame([(k, f"i{k % 3}", "x" * (1 + k * 37 % 90)) for k in range(900)], "id long, target_index string, body string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    got = sorted(map(tuple, D.request_sizes(docs, "id", 20, 500).collect()))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = []
    for i in range(3):
        ops = [D.Operation(str(k), f"i{i}", "x" * (1 + k * 37 % 90)) for k in range(900) if k % 3 == i]
        want += [(f"i{i}", n, len(r), sum(o.n_bytes for o in r)) for n, r in enumerate(D.requests(ops, 20, 500))]
    assert got == sorted(want)
