import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from editlens.operators import windows
from editlens.plans import publish
from editlens.sources import edit_events, land_raw
from editlens.streaming import speed
from tests.conftest import SF_SMALL, edits_df

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def put(dir_, name, items):
    """items: (wiki, minute offset) -> one JSON file of edit events."""
    os.makedirs(dir_, exist_ok=True)
    with open(os.path.join(dir_, name), "w") as f:
        for i, (w, m) in enumerate(items):
            t = (T0 + dt.timedelta(minutes=m)).strftime("%Y-%m-%dT%H:%M:%S.000000Z")
            f.write(json.dumps(dict(wiki=w, id=f"{name}-{i}", type="edit", bot=False,
                                    event_time=t, arrival_time=t)) + "\n")


def run_once(spark, src, out, ck):
    q = speed.run_speed(speed.read_events_stream(spark, src), out, ck, {"availableNow": True})
    speed.run_to_end(q)


def test_late_rows_are_dropped_after_watermark(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    put(src, "f1.json", [("a", 10)])
    run_once(spark, src, out, ck)
    put(src, "f2.json", [("a", 20)])
    run_once(spark, src, out, ck)
    put(src, "f3.json", [("late", 2)])          # below the 00:19 watermark
    run_once(spark, src, out, ck)
    put(src, "f4.json", [("a", 40)])
    run_once(spark, src, out, ck)
    res = windows.flatten_window(spark.read.parquet(out))
    wikis = {r.wiki for r in res.collect()}
    assert "late" not in wikis
    a10 = res.filter((F.col("wiki") == "a") & (F.col("window_end") <= T0 + dt.timedelta(minutes=16)))
    assert a10.count() == 5 and a10.agg(F.sum("edits")).first()[0] == 5


def test_raw_replay_does_not_depend_on_max_files(spark, tmp_dir):
    """More raw files than a micro-batch takes, hours landed by several writers: no window is lost."""
    hours, max_files = 8, 3
    rows = [dict(wiki=w, id=f"{w}{h}-{m}", type="edit", bot=False, timestamp=int((T0 + d).replace(tzinfo=dt.timezone.utc).timestamp()),
                 event_time=T0 + d, arrival_time=T0 + d)
            for h in range(hours) for m in (1, 30, 59) for w in "ab" for d in (dt.timedelta(hours=h, minutes=m),)]
    ev = edits_df(spark, rows).repartition(5, "id")
    end = max(r["event_time"] for r in rows) - dt.timedelta(minutes=1)
    want = sorted(tuple(r) for r in windows.flatten_window(windows.sliding_counts(ev)).filter(F.col("window_end") <= end).collect())
    raw, out, ck = (os.path.join(tmp_dir, d) for d in ("raw", "out", "ck"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        speed.replay_raw(spark, ev, raw, out, ck, max_files=max_files)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.json(raw).count() == len(rows)
    got = windows.flatten_window(spark.read.parquet(out))
    assert sorted(tuple(r) for r in got.collect()) == want
    assert [len(speed.raw_waves(ev, max_files=n)) for n in (1, 3, 8, 1000)] == [8, 3, 1, 1]


def test_restart_resumes_from_checkpoint(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    put(src, "f1.json", [("a", 1), ("b", 2)])
    put(src, "f2.json", [("a", 3)])

    def replay():
        q = speed.start_query(speed.admitted(speed.read_events_stream(spark, src, max_files=1))
                         .select("wiki", "id"), ck, "append", "parquet", out,
                         {"availableNow": True})
        speed.run_to_end(q)

    replay()
    put(src, "f3.json", [("c", 4)])
    replay()
    ids = sorted(r.id for r in spark.read.parquet(out).collect())
    assert ids == ["f1.json-0", "f1.json-1", "f2.json-0", "f3.json-0"]


def test_streaming_complete_equals_batch(spark, tmp_dir):
    ev = edit_events(spark, SF_SMALL)
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    speed.land_events(ev, src)
    agg = windows.sliding_counts(speed.admitted(speed.read_events_stream(spark, src)))
    speed.run_to_end(speed.run_complete(agg, out, ck, {"availableNow": True}))
    s = windows.flatten_window(publish.current(spark, out))
    b = windows.sliding_edits(ev)
    assert s.count() == b.count() and s.exceptAll(b).count() == 0


def test_envelope_round_trip_and_bad_payload(spark):
    df = spark.createDataFrame(
        [(bytearray(b'{"wiki":"enwiki","title":"X","bot":false,"timestamp":5}'), T0),
         (bytearray(b'{"id":"us1","namespace":3}'), T0), (bytearray(b'{not json'), T0), (None, T0)],
        "data binary, approximateArrivalTimestamp timestamp")
    want = [("enwiki", "X", 5, None, None), (None, None, None, "us1", 3), (None,) * 5, (None,) * 5]
    kafka = df.selectExpr("cast(null as binary) as key", "data as value", "approximateArrivalTimestamp as timestamp")
    for env in (df, kafka):          # nothing is filtered: that is for each layer
        rows = speed.decode_envelope(env).collect()
        assert [(r.wiki, r.title, r.timestamp, r.id, r.namespace) for r in rows] == want
        assert {r.event_time for r in rows} == {T0}
    with pytest.raises(ValueError):
        speed.decode_envelope(df.select("data"))


def test_plain_records_get_their_clocks(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    ev = edit_events(spark, SF_SMALL)
    land_raw(ev, src, clock="event_time")
    run_once(spark, src, out, ck)
    got = windows.flatten_window(spark.read.parquet(out))
    want = windows.sliding_edits(ev.withColumn("event_time", F.timestamp_seconds("timestamp")))
    assert got.count() > 0 and got.exceptAll(want).count() == 0


def test_future_event_does_not_move_the_clock(spark, tmp_dir):
    """One event dated years ahead counts at its arrival and wipes nothing."""
    from editlens.plans import serving
    src, snap, ck = (os.path.join(tmp_dir, d) for d in ("in", "snap", "ck"))
    put(src, "f1.json", [("a", 1), ("a", 2), ("b", 2)])
    with open(os.path.join(src, "f2.json"), "w") as f:
        f.write(json.dumps(dict(wiki="z", id="z", type="edit", bot=False, event_time="2030-01-01T00:00:00.000000Z",
                                arrival_time="2024-01-01T00:03:00.000000Z")) + "\n")
    put(src, "f3.json", [("b", 3), ("b", 3)])
    for i, n in enumerate(("f1.json", "f2.json", "f3.json")):
        os.utime(os.path.join(src, n), (1_700_000_000 + i, 1_700_000_000 + i))
    q = speed.run_snapshot(spark, speed.read_events_stream(spark, src, max_files=1), snap, ck,
                           trigger={"availableNow": True})
    speed.run_to_end(q)
    assert {r.wiki: r["count"] for r in serving.read_snapshot(spark, snap).collect()} == {"a": 2, "b": 3, "z": 1}


def test_snapshot_batch_is_idempotent(spark, tmp_dir):
    from editlens.plans import serving
    state, snap = os.path.join(tmp_dir, "state"), os.path.join(tmp_dir, "snap")
    write = speed.snapshot_writer(spark, state, snap)
    rows = spark.createDataFrame([(T0, "a", 3, T0), (T0, "b", 1, T0)], "s timestamp, wiki string, count long, last timestamp")
    batch = rows.select(F.struct(F.col("s").alias("start")).alias("pane"), "wiki", "count", "last")
    for _ in range(2):               # a retried batch rewrites its own folder and version
        write(batch, 0)
    assert {r.wiki: r["count"] for r in serving.read_snapshot(spark, snap).collect()} == {"a": 3, "b": 1}
    assert publish.versions(spark, snap) == [0]


def test_dedupe_over_several_batches(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    put(src, "f1.json", [("a", 1), ("b", 600)])
    for i in range(3):               # the same ids again, hours apart
        put(src, f"g{i}.json", [("a", 1), ("b", 900 * i)])
    for p in os.listdir(src):        # equal ids in every file
        path = os.path.join(src, p)
        rows = [dict(json.loads(x), id=str(i)) for i, x in enumerate(open(path))] + [dict(id="", wiki="x"), dict(wiki="y")]
        with open(path, "w") as f:
            f.write("".join(json.dumps(r) + "\n" for r in rows))
    d = speed.dedupe_stream(speed.read_events_stream(spark, src, max_files=1)).select("id")
    speed.run_to_end(speed.start_query(d, ck, "append", "parquet", out, {"availableNow": True}))
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["0", "1"]


def test_progress_frame(spark, tmp_dir):
    from editlens.operators.monitor import progress_frame
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    put(src, "f1.json", [("a", 1), ("b", 2)])
    q = speed.run_speed(speed.read_events_stream(spark, src), out, ck, {"availableNow": True})
    speed.run_to_end(q)
    pf = progress_frame(spark, q).orderBy("batch_id").collect()
    assert pf[0].input_rows == 2 and pf[0].batch_id == 0
    assert pf[-1].watermark is not None


def _edit(wiki, second, n, **kw):
    t = (T0 + dt.timedelta(seconds=second)).strftime("%Y-%m-%dT%H:%M:%S.000000Z")
    return json.dumps(dict(dict(wiki=wiki, id=f"{wiki}-{second}-{n}", type="edit", bot=False, event_time=t, arrival_time=t), **kw))


def _put_edits(dir_, files):
    """One JSON file of edits per list, in that order."""
    os.makedirs(dir_, exist_ok=True)
    for i, rows in enumerate(files):
        path = os.path.join(dir_, f"f{i}.json")
        with open(path, "w") as f:
            f.write("\n".join(rows) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


@pytest.mark.parametrize("log", [False, True])
def test_snapshot_reads_the_state_once_per_batch(spark, tmp_dir, monkeypatch, log):
    """Each state row is read once by the batch after it, and by none that changes nothing; of log records too."""
    from editlens.plans import serving
    src, snap, ck = (os.path.join(tmp_dir, d) for d in ("in", "snap", "ck"))
    _put_edits(src, [[_edit("a", 1, 0), _edit("b", 2, 0)], [_edit("a", 12, 0)], [_edit("c", 25, 0)]])
    read, plain = spark.sparkContext.accumulator(0), speed.state_panes

    @F.udf("boolean")
    def seen(t):
        read.add(1)
        return True

    monkeypatch.setattr(speed, "state_panes", lambda *a: plain(*a).where(seen.asNondeterministic()("pane_start")))
    events = speed.read_events_stream(spark, src, max_files=1)
    if log:
        events = speed.decode_envelope(speed.envelope(events))
    speed.run_to_end(speed.run_snapshot(spark, events, snap, ck, trigger={"availableNow": True}))
    assert {r.wiki: r["count"] for r in serving.read_snapshot(spark, snap).collect()} == {"a": 2, "b": 1, "c": 1}
    assert read.value == 2 + 3          # the states of the first two batches
    assert publish.versions(spark, snap) == [1, 2]


def test_snapshot_shuffle_is_as_wide_as_the_rows(spark, tmp_dir):
    src, snap, ck = (os.path.join(tmp_dir, d) for d in ("in", "snap", "ck"))
    _put_edits(src, [[_edit(f"w{i}", 1, 0) for i in range(40)], [_edit(f"w{i}", 2, 0) for i in range(40)]])
    q = speed.run_snapshot(spark, speed.read_events_stream(spark, src, max_files=1), snap, ck, trigger={"availableNow": True})
    speed.run_to_end(q)
    for v in publish.versions(spark, snap):
        assert len([f for f in os.listdir(f"{snap}/v={v}") if f.startswith("part-")]) == 1


def test_snapshot_of_batches_longer_than_the_window_and_out_of_order(spark, tmp_dir):
    """A batch that spans many windows, an older one after a newer one, one that admits nothing but moves the clock,
    one that admits nothing and is old, an empty file: each version is what a plain count over all rows so far gives."""
    from editlens.plans import serving
    src, snap, ck = (os.path.join(tmp_dir, d) for d in ("in", "snap", "ck"))
    files = [[_edit(f"w{i % 7}", i * 37, i) for i in range(60)],
             [_edit("w1", 2100, 1), _edit("w2", 2101, 1), _edit("w9", 2000, 1, bot=True)],
             [_edit("w3", 2330, 1, bot=True), _edit("w4", 2331, 1, type="log")],
             [], [_edit("w1", 2200, 2, type="log")], [_edit("w5", 2335, 1), _edit("w1", 2335, 3)]]
    _put_edits(src, files)
    q = speed.run_snapshot(spark, speed.read_events_stream(spark, src, max_files=1), snap, ck, 300, 10, {"availableNow": True})
    speed.run_to_end(q)
    rows = [json.loads(r) for f in files for r in f]
    secs = lambda r: int((dt.datetime.fromisoformat(r["event_time"]).replace(tzinfo=None) - T0).total_seconds())
    as_of, want = max(map(secs, rows)), {}
    for r in rows:
        if not r["bot"] and r["type"] == "edit" and secs(r) // 10 * 10 >= as_of - 300:
            want[r["wiki"]] = want.get(r["wiki"], 0) + 1
    assert {r.wiki: r["count"] for r in serving.read_snapshot(spark, snap, 50).collect()} == want
    assert {r.wiki: r["count"] for r in serving.state_snapshot(spark, ck, 50).collect()} == want


def test_events_not_admitted_share_a_state_row(spark, tmp_dir):
    src, ck = (os.path.join(tmp_dir, d) for d in ("in", "ck"))
    _put_edits(src, [[_edit(f"w{i}", 1, 0, bot=True) for i in range(20)] + [_edit("a", 2, 0), _edit("unknown", 3, 0)]])
    speed.run_to_end(speed.start_query(speed.pane_stream(speed.read_events_stream(spark, src)), ck, "update", "noop",
                                       trigger={"availableNow": True}))
    assert sorted((r.wiki, r["count"]) for r in speed.state_panes(spark, ck).collect()) == [("a", 1), ("unknown", 1)]


@pytest.mark.parametrize("name", ["speed_snapshot", "speed_snapshot_log", "speed_state_view"])
def test_snapshot_state_is_as_wide_as_the_rows(spark, tmp_dir, monkeypatch, name):
    """Every state partition is committed by every micro-batch: their number follows the landed files, not the
    session's shuffle partitions, which a run leaves as they were."""
    from editlens.plans import catalog, catalog_io
    from editlens.sources.fixtures import TABLE_SCHEMAS
    rows = [(i, T0.replace(tzinfo=None) + dt.timedelta(minutes=61 * i), i % 3, "click", 1.0, '{"k": %d}' % (3 + i % 2)) for i in range(60)]
    spark.createDataFrame(rows, TABLE_SCHEMAS["events"]).write.parquet(os.path.join(tmp_dir, "events.parquet"))
    dirs, plain = {}, catalog_io.fresh_dir
    monkeypatch.setattr(catalog_io, "fresh_dir", lambda s, n: dirs.setdefault(n, plain(s, n)))
    was = spark.conf.get(speed.WIDTH)
    try:
        for width, want in ((30, 24), (5, 5)):
            dirs.clear()
            spark.conf.set(speed.WIDTH, width)
            got = catalog.QUERIES[name](spark, tmp_dir).collect()
            assert spark.conf.get(speed.WIDTH) == str(width)
            state = os.path.join(dirs["ckpt"].removeprefix("file:"), "state", "0")
            assert len([d for d in os.listdir(state) if d.isdigit()]) == want
            assert {r.wiki: r["count"] for r in got} == {"wiki_0": 8, "wiki_1": 8, "wiki_2": 8}
    finally:
        spark.conf.set(speed.WIDTH, was)
    assert [speed.state_width(n) for n in (2, 24, 90)] == [24, 24, 90]
