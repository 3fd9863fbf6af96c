"""The closed form of the window against a queue that is evicted from its front."""

import datetime as dt
import random
from collections import Counter, deque

import pytest
from pyspark.sql import functions as F

from sparkloom.config import Config
from sparkloom.operators import detect, window
from sparkloom.sources.scratch import settle

EPOCH = dt.datetime(2026, 1, 1)
ENTRY = "id long, at timestamp, batch_id long, service string, is_error boolean, is_auth boolean, ip string, latency_ms long"


def model(rows, width):
    """Per batch: total, errors, errors by service, logins by ip."""
    live, mark, out = deque(), EPOCH - dt.timedelta(days=1), []
    for k, r in enumerate(rows):
        mark = max(mark, r[1])
        live.append(r)
        while live and live[0][1] < mark - dt.timedelta(seconds=width):
            live.popleft()
        if k + 1 == len(rows) or rows[k + 1][2] != r[2]:
            out.append((len(live), sum(x[4] for x in live), Counter(x[3] for x in live if x[4]), Counter(x[6] for x in live if x[5])))
    return out


def run(spark, rows, width):
    tracked = settle(window.track(spark.createDataFrame(rows, ENTRY), span=64))
    return tracked, settle(window.evaluations(tracked, span=4))


@pytest.mark.parametrize("seed,span", [(0, 4096), (1, 3), (2, 1)])
def test_against_a_queue(spark, seed, span, monkeypatch):
    rng, t, rows, batch = random.Random(seed), 0.0, [], 0
    for i in range(1, 400):
        t += rng.choice([0, 1, 5, 40])
        batch += rng.random() < 0.05
        late = rng.choice([0, 0, 0, 30, 300])
        rows.append((i * 3, EPOCH + dt.timedelta(seconds=t - late), batch, rng.choice("ab"), rng.random() < 0.4, rng.random() < 0.3, rng.choice(["x", "y"]), 5))
    want = model(rows, 120)
    tracked, evals = run(spark, rows, 120)
    got = {r.e: r for r in window.snapshots(tracked, evals, 120).collect()}
    assert [(got[e + 1].total, got[e + 1].errors) for e in range(len(want))] == [w[:2] for w in want]
    monkeypatch.setattr(window.levels, "__defaults__", (None, span))
    for k, rows_of, col in ((2, window.errors_by_service, "service"), (3, window.failed_logins_by_ip, "ip")):
        found = {(r.e, r[col]): r.n for r in rows_of(tracked, evals, 120).collect()}
        assert found == {(e + 1, key): n for e, w in enumerate(want) for key, n in w[k].items()}


def test_the_edge_of_the_window_is_inside(spark):
    rows = [(i, EPOCH + dt.timedelta(minutes=5 * i), 0, "s", False, False, None, None) for i in range(1, 11)]
    tracked, evals = run(spark, rows, 300)
    assert window.snapshots(tracked, evals, 300).first().total == 2


def test_batches_are_numbered_over_ranges(spark):
    got = window.number_batches(spark.range(1, 1001).select((F.col("id") * 7).alias("id")), 30, span=128).groupBy("batch_id").count().collect()
    assert sorted(r.batch_id for r in got) == list(range(34)) and sorted(r["count"] for r in got)[0] == 10


@pytest.mark.parametrize("fold", [1, 3, 6, 128])
def test_exponential_average(spark, fold):
    rates = [(e, 100 if e % 4 else 10, ((e * 37) % 11) / 20) for e in range(1, 40)]
    snaps = spark.createDataFrame(rates, "e long, total long, error_rate double")
    got = {r.e: (r.baseline, r.ema) for r in detect.baselines(snaps, 0.3, 50, fold=fold).collect()}
    ema = None
    for e, total, x in rates:
        if total < 50:
            assert got[e] == (None, None)
            continue
        before, ema = ema, x if ema is None else 0.3 * x + 0.7 * ema
        assert got[e][0] == (None if before is None else pytest.approx(before)) and got[e][1] == pytest.approx(ema)


def test_rules(spark):
    c = Config()
    snaps = spark.createDataFrame([(e, 100, 5, 0.05) for e in range(1, 11)] + [(11, 100, 40, 0.4)], "e long, total long, errors long, error_rate double").withColumn("watermark", F.timestamp_seconds(F.lit(1767268800)))
    spikes = detect.spike_alerts(detect.baselines(snaps, 0.3, 50), c).collect()
    assert [(r.e, r.message) for r in spikes] == [(11, "Error rate 40.0% exceeds 3.0 x trailing avg 5.0% over 300s")]
    evals = snaps.select("e", "watermark")
    logins = detect.login_alerts(spark.createDataFrame([(1, "1.1.1.1", 25), (1, "2.2.2.2", 19)], "e long, ip string, n long"), evals, c).collect()
    assert [(r.subject, r.message, r.severity) for r in logins] == [("1.1.1.1", "25 failed auth attempts from 1.1.1.1 in 300s", "DEGRADED")]
    services = detect.service_alerts(spark.createDataFrame([(1, "pay", 60), (1, "x", 24)], "e long, service string, n long"), evals, c).collect()
    assert [(r.subject, r.message) for r in services] == [("pay", "Service 'pay' produced 60 errors in 300s")]


def test_replays_are_counted_once(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (-1,), (-1,)], "id long")
    assert sorted(r.id for r in window.dedupe(df).collect()) == [-1, -1, 1, 2]
