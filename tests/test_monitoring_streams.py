"""Live alarms, probes, top keys per window and the progress table."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from editlens.operators import monitor, views, windows
from editlens.sources import edit_events
from editlens.streaming import monitoring, speed
from tests.conftest import SF_SMALL, edits_df

T0 = dt.datetime(2024, 1, 1)


def event(i, second, wiki="a", lag=0, type_="edit", bot=False):
    t = T0 + dt.timedelta(seconds=second)
    return dict(wiki=wiki, id=str(i), title="T", type=type_, bot=bot, timestamp=0, event_time=t,
                arrival_time=t + dt.timedelta(seconds=lag))


def land(spark, tmp_dir, batches):
    """One file a batch, in order; a stream that takes a file per micro-batch."""
    src = os.path.join(tmp_dir, "in")
    for rows in batches:
        edits_df(spark, rows).coalesce(1).write.mode("append").option("timestampFormat", speed.TS_FORMAT).json(src)
    names = sorted((os.path.join(src, n) for n in os.listdir(src) if n.endswith(".json")), key=os.path.getmtime)
    for i, n in enumerate(names):
        os.utime(n, (1_700_000_000 + i, 1_700_000_000 + i))
    return src


def drain(spark, tmp_dir, stream, name="out"):
    out, ck = os.path.join(tmp_dir, name), os.path.join(tmp_dir, f"ck-{name}")
    speed.run_to_end(speed.start_query(stream, ck, "append", "parquet", out, {"availableNow": True}))
    return spark.read.schema(stream.schema).parquet(out)


def test_rate_alarm_over_batches(spark, tmp_dir):
    """Breaches in minutes 0-3 and 5-6 (minute 4 is missing), a quiet minute 7."""
    per_minute = {0: 3, 1: 3, 2: 4, 3: 3, 5: 3, 6: 5, 7: 1, 12: 1}
    rows = [event(f"{m}-{i}", 60 * m + i) for m, n in per_minute.items() for i in range(n)]
    src = land(spark, tmp_dir, [rows[:5], rows[5:12], rows[12:]])
    stream = monitoring.rate_alarm_stream(speed.read_events_stream(spark, src, 1), 2, 3)
    got = {r.minute: (r.records, r.breach, r.alarm) for r in drain(spark, tmp_dir, stream).collect()}
    series = monitor.records_per_period(edits_df(spark, rows))
    want = {r.minute: (r.records, r.breach, r.alarm) for r in monitor.sustained_alarm(series, 2, 3).collect()
            if r.minute < T0 + dt.timedelta(minutes=10)}
    assert got == want
    assert [m.minute for m, v in sorted(got.items()) if v[2]] == [2, 3]      # the missing minute ends the run


def test_lag_alarm_over_batches(spark, tmp_dir):
    rows = [event(i, 30 * i, lag=90 if 4 <= i < 10 else 1) for i in range(20)]
    src = land(spark, tmp_dir, [rows[:6], rows[6:]])
    stream = monitoring.lag_alarm_stream(speed.read_events_stream(spark, src, 1))
    got = {tuple(r) for r in drain(spark, tmp_dir, stream).collect()}
    series = monitor.lag_per_period(edits_df(spark, rows))
    end = max(r["arrival_time"] for r in rows) - dt.timedelta(minutes=2)
    want = {tuple(r) for r in monitor.sustained_alarm(series, 60_000, 2, value="max_lag_ms").collect() if r.minute <= end}
    assert got == want and any(r[3] for r in got) and not all(r[3] for r in got)


def test_probe_over_batches(spark, tmp_dir):
    """Seen at once, seen late but in time, seen after the timeout, never admitted."""
    rows = [event("a1", 5, "fast", 1), event("a2", 15, "fast", 1), event("b", 10, "slow", 40),
            event("c", 20, "late", 90), event("d", 30, "log", 1, "log"), event("e", 30, "bot", 1, bot=True)]
    later = [event(f"x{m}", 60 * m, "end", 1) for m in range(3, 9)]
    src = land(spark, tmp_dir, [rows[:3], rows[3:], later])
    sent, seen = (speed.read_events_stream(spark, src, 1) for _ in range(2))
    got = {r.wiki: r for r in drain(spark, tmp_dir, monitoring.probe_stream(sent, seen)).collect() if r.minute == T0}
    assert {w: (r.burst, r.latency_ms, r.found) for w, r in got.items()} == {
        "fast": (2, 0.0, True), "slow": (1, 40_000.0, True), "late": (1, 60_000.0, False), "log": (1, 60_000.0, False)}
    assert got["fast"].burst_ms == 10_000.0


def test_topn_per_window_on_the_stream(spark, tmp_dir):
    ev = edit_events(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "in")
    files = speed.land_in_waves(ev, src, waves=3)
    out, ck = os.path.join(tmp_dir, "top"), os.path.join(tmp_dir, "ck")
    counts = speed.windowed_counts(speed.read_events_stream(spark, src, files))
    speed.run_to_end(monitoring.run_topn_per_window(counts, out, ck, 1, trigger={"availableNow": True}))
    got = monitoring.read_topn(spark, out)
    want = windows.topn_per_window(windows.sliding_edits(ev), 1)
    assert got.count() > 0 and got.exceptAll(want.select(got.columns)).count() == 0
    assert got.groupBy("window_start").count().where("count > 1").count() == 0


def test_progress_is_a_table(spark, tmp_dir):
    """More micro-batches than one, every record kept, counts observed on the way."""
    rows = [event(i, i, bot=i % 3 == 0) for i in range(12)] + [dict(event(99, 20), wiki=None)]
    src = land(spark, tmp_dir, [rows[:4], rows[4:8], rows[8:]])
    log = monitoring.ProgressLog(spark, os.path.join(tmp_dir, "progress"))
    spark.streams.addListener(log)
    try:
        seen = monitoring.observe_counts(speed.read_events_stream(spark, src, 1))
        q = speed.run_speed(seen, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"), {"availableNow": True})
        speed.run_to_end(q)
        log.wait(q)
    finally:
        spark.streams.removeListener(log)
    got = monitoring.progress_by_batch(log.read()).orderBy("batch_id").collect()
    assert [r.input_rows for r in got if r.input_rows] == [4, 4, 5]
    assert [sum(r[c] for r in got) for c in views.COUNT_NAMES] == [13, 9, 8]
    assert got[-1].watermark is not None


def test_complete_mode_refuses_windows(spark, tmp_dir):
    src = land(spark, tmp_dir, [[event(1, 1)]])
    agg = windows.sliding_counts(speed.read_events_stream(spark, src))
    with pytest.raises(ValueError):
        speed.run_complete(agg, os.path.join(tmp_dir, "o"), os.path.join(tmp_dir, "c"), {"availableNow": True})
