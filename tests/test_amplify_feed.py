import datetime as dt

from pyspark.sql import functions as F

from editlens.operators import amplify, monitor
from editlens.sources import dedupe_by_id, explode_features
from editlens.streaming import speed
from tests.conftest import edits_df

T0 = dt.datetime(2024, 1, 1)


def test_fanout_clones_and_salted_keys(spark):
    df = edits_df(spark, [dict(id="1", wiki="enwiki"), dict(id="2", wiki=None)])
    rows = amplify.fanout(df, 3).select("id", "_fanout", "pkey").collect()
    got = sorted(((r.id, r._fanout, r.pkey) for r in rows), key=repr)
    assert got == sorted([("1", None, "enwiki"), ("1", 1, "enwiki-1"), ("1", 2, "enwiki-2"),
                          ("2", None, "enwiki"), ("2", 1, "enwiki-1"), ("2", 2, "enwiki-2")],
                         key=repr)
    assert amplify.fanout(df, 1).count() == 2


def test_dedupe_keeps_first_occurrence(spark):
    items = spark.createDataFrame(
        [("q1", T0 + dt.timedelta(minutes=5), "late"), ("q1", T0, "first"),
         ("q2", T0, "only"), (None, T0, "no-id")],
        "id string, event_time timestamp, mag string")
    got = {r.id: r.mag for r in dedupe_by_id(items).collect()}
    assert got == {"q1": "first", "q2": "only"}


def test_explode_features_then_dedupe(spark, tmp_dir):
    import json
    import os
    polls = [{"type": "FeatureCollection",
              "features": [{"id": "a", "properties": {"mag": 1.0}},
                           {"id": "b", "properties": {"mag": 2.0}}]},
             {"type": "FeatureCollection",
              "features": [{"id": "b", "properties": {"mag": 2.0}},
                           {"id": "c", "properties": {"mag": 3.5}}]}]
    for i, p in enumerate(polls):
        with open(os.path.join(tmp_dir, f"poll{i}.json"), "w") as f:
            json.dump(p, f, indent=1)
    feed = spark.read.option("multiLine", True).json(tmp_dir)
    feats = explode_features(feed).withColumn("event_time", F.lit(T0).cast("timestamp"))
    assert feats.count() == 4
    assert sorted(r.id for r in dedupe_by_id(feats).collect()) == ["a", "b", "c"]


def test_bytes_and_lag_per_minute(spark):
    rows = [dict(id=str(i), wiki="w", event_time=T0 + dt.timedelta(seconds=i),
                 arrival_time=T0 + dt.timedelta(seconds=2 * i)) for i in range(40)]
    df = edits_df(spark, rows)
    lag = {r.minute: r.max_lag_ms for r in monitor.lag_per_period(df).collect()}
    assert lag == {T0: 29000, T0 + dt.timedelta(minutes=1): 39000}
    b = monitor.bytes_per_period(df).collect()
    assert sum(r.bytes for r in b) > 0 and len(b) == 2


def test_stream_dedupe_drops_repeats(spark, tmp_dir):
    import json
    import os
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "f.json"), "w") as f:
        for i, t in enumerate(["A", "B", "A", "A", "C"]):
            ts = (T0 + dt.timedelta(seconds=i)).strftime("%Y-%m-%dT%H:%M:%S.000000Z")
            f.write(json.dumps(dict(title=t, id=str(i), event_time=ts, arrival_time=ts)) + "\n")
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    d = speed.dedupe_stream(speed.read_events_stream(spark, src).select("title", "event_time"),
                            "title")
    speed.run_to_end(speed.start_query(d, ck, "append", "parquet", out, {"availableNow": True}))
    assert sorted(r.title for r in spark.read.parquet(out).collect()) == ["A", "B", "C"]


def test_log_records_written_batch_and_streaming(spark, tmp_dir):
    import os
    from editlens.sources import to_log_records, write_log
    df = edits_df(spark, [dict(id="1", wiki="enwiki", bot=False), dict(id="2", wiki=None)])
    recs = to_log_records(df)
    got = {r.key: r.value for r in recs.collect()}
    assert got["enwiki"] == '{"wiki":"enwiki","bot":false,"id":"1"}'
    assert got["default"] == '{"id":"2"}'
    # a file format stands in for the log connector (same writer path)
    write_log(recs, "json", {"path": os.path.join(tmp_dir, "batch")})
    assert spark.read.json(os.path.join(tmp_dir, "batch")).count() == 2
    src = os.path.join(tmp_dir, "src")
    recs.write.json(src)
    stream = spark.readStream.schema("key string, value string").json(src)
    q = write_log(stream, "json", {"path": os.path.join(tmp_dir, "out")},
                  checkpoint=os.path.join(tmp_dir, "ck"), trigger={"availableNow": True})
    speed.run_to_end(q)
    assert spark.read.json(os.path.join(tmp_dir, "out")).count() == 2
