import datetime as dt
import random

from editlens.operators import monitor
from tests.conftest import edits_df


def series(spark, pts):
    return spark.createDataFrame(pts, "minute timestamp_ntz, records long")


def brute_alarm(pts, thr, k, p):
    vals = {t: v for t, v in pts}
    out = {}
    for t, v in pts:
        out[t] = all(vals.get(t - dt.timedelta(seconds=p * i), -1) > thr for i in range(k))
    return out


def test_sustained_alarm_matches_brute_force(spark):
    rnd = random.Random(11)
    t0 = dt.datetime(2024, 1, 1)
    pts = [(t0 + dt.timedelta(minutes=m), rnd.randint(0, 10))
           for m in range(300) if rnd.random() > 0.15]
    got = {r.minute: r.alarm for r in
           monitor.sustained_alarm(series(spark, pts), 5, 3, 60).collect()}
    assert got == brute_alarm(pts, 5, 3, 60)


def test_alarm_gap_is_not_breaching(spark):
    t0 = dt.datetime(2024, 1, 1)
    pts = [(t0, 600), (t0 + dt.timedelta(minutes=1), 600), (t0 + dt.timedelta(minutes=3), 600)]
    got = {r.minute: r.alarm for r in monitor.sustained_alarm(series(spark, pts), 500, 2).collect()}
    assert got == {pts[0][0]: False, pts[1][0]: True, pts[2][0]: False}


def test_speedup_from_first_run(spark):
    runs = spark.createDataFrame([(1, 480.0), (2, 265.0), (4, 145.0), (8, 85.0)],
                                 "workers int, runtime_s double")
    got = [round(r.speedup, 2) for r in monitor.speedup(runs).orderBy("workers").collect()]
    assert got == [1.0, 1.81, 3.31, 5.65]


def test_sentinel_latency(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = []

    def put(wiki, at, lag, etype="edit", bot=False):
        t = t0 + dt.timedelta(seconds=at)
        rows.append(dict(wiki=wiki, id=str(len(rows)), type=etype, bot=bot, event_time=t,
                         arrival_time=t + dt.timedelta(seconds=lag)))
    put("a", 0, 1.5)                      # one row: seen 1.5 s after it
    put("b", 0, 5), put("b", 10, 30)      # seen before the burst is over: 0
    put("c", 0, 61)                       # seen after the timeout
    put("d", 0, 1, "log")                 # never admitted
    put("e", 0, 20), put("e", 70, 2)      # two bursts
    put("f", 0, 0.5, bot=True)            # no probe
    got = {(r.wiki, r.minute): (r.burst, r.burst_ms, r.latency_ms, r.found)
           for r in monitor.sentinel_latency(edits_df(spark, rows)).collect()}
    t1 = t0 + dt.timedelta(minutes=1)
    assert got == {("a", t0): (1, 0.0, 1500.0, True), ("b", t0): (2, 10000.0, 0.0, True), ("c", t0): (1, 0.0, 60000.0, False),
                   ("d", t0): (1, 0.0, 60000.0, False), ("e", t0): (1, 0.0, 20000.0, True), ("e", t1): (1, 0.0, 2000.0, True)}


def test_throughput_summary(spark):
    t0 = dt.datetime(2024, 1, 1)
    pts = [(t0, 3), (t0 + dt.timedelta(minutes=1), 9), (t0 + dt.timedelta(minutes=2), 4)]
    r = monitor.throughput_summary(series(spark, pts)).first()
    assert (r.periods, r.peak, r.peak_at, r.latest_at, r.latest) == \
        (3, 9, pts[1][0], pts[2][0], 4)
