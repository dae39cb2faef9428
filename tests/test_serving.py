import datetime as dt
import json
import os

from editlens.operators import merge
from editlens.plans import publish, serving
from editlens.streaming import speed

T0 = dt.datetime(2024, 1, 1)


def test_merged_view_degrades_to_speed_only(spark, tmp_dir):
    snap = os.path.join(tmp_dir, "snap")
    top = spark.createDataFrame([("frwiki", 12), ("enwiki", 5)], "wiki string, count long")
    serving.write_snapshot(top, snap, 300)
    got = [tuple(r) for r in serving.merged_view(spark, "no_such_db.no_table", snap, 10).collect()]
    assert got == [("frwiki", 12), ("enwiki", 5)]


def test_merged_view_with_batch_table(spark, tmp_dir):
    views = os.path.join(tmp_dir, "wiki_edits")
    spark.createDataFrame([("enwiki", 100), ("dewiki", 40)], "wiki string, edits long") \
        .write.parquet(views)
    (table,) = serving.register_views(spark, "editlens_test", {"wiki_edits": views})
    snap = os.path.join(tmp_dir, "snap")
    serving.write_snapshot(spark.createDataFrame([("enwiki", 5), ("frwiki", 12)],
                                                 "wiki string, count long"), snap, 300)
    got = [tuple(r) for r in serving.merged_view(spark, table, snap, 10).collect()]
    assert got == [("enwiki", 105), ("dewiki", 40), ("frwiki", 12)]
    assert [tuple(r) for r in serving.table_topn(spark, table, 1).collect()] == [("enwiki", 100)]


def test_snapshot_ranks_and_stale_ranks_vanish(spark, tmp_dir):
    snap = os.path.join(tmp_dir, "snap")
    serving.write_snapshot(spark.createDataFrame([(f"w{i}", 10 - i) for i in range(5)],
                                                 "wiki string, count long"), snap, 300)
    serving.write_snapshot(spark.createDataFrame([("a", 3), ("b", 3)],
                                                 "wiki string, count long"), snap, 300)
    rows = serving.read_snapshot(spark, snap, 10).collect()
    assert [(r["rank"], r.wiki, r["count"]) for r in rows] == [(1, "a", 3), (2, "b", 3)]


def _put(dir_, name, items):
    os.makedirs(dir_, exist_ok=True)
    with open(os.path.join(dir_, name), "w") as f:
        for i, (w, s) in enumerate(items):
            t = (T0 + dt.timedelta(seconds=s)).strftime("%Y-%m-%dT%H:%M:%S.000000Z")
            f.write(json.dumps(dict(wiki=w, id=f"{name}-{i}", type="edit", bot=False,
                                    event_time=t, arrival_time=t)) + "\n")


def test_snapshot_state_is_trailing_and_bounded(spark, tmp_dir):
    src, snap, ck = (os.path.join(tmp_dir, d) for d in ("in", "snap", "ck"))
    _put(src, "f1.json", [("old", 0), ("old", 1), ("old", 2)])
    _put(src, "f2.json", [("new", 400), ("mid", 200)])
    _put(src, "f3.json", [("new", 500)])
    for i, name in enumerate(("f1.json", "f2.json", "f3.json")):
        os.utime(os.path.join(src, name), (1_700_000_000 + i, 1_700_000_000 + i))
    q = speed.run_snapshot(spark, speed.read_events_stream(spark, src, max_files=1), snap,
                           ck, 300, 10, {"availableNow": True})
    speed.run_to_end(q)
    rows = [(r.wiki, r["count"]) for r in serving.read_snapshot(spark, snap, 10).collect()]
    assert rows == [("new", 2), ("mid", 1)]
    assert "old" not in {r.wiki for r in speed.state_panes(spark, ck).collect()}      # its panes have left the window
    assert len(publish.versions(spark, snap)) <= 2              # the newest version and the one before


def test_published_versions_do_not_disturb_readers(spark, tmp_dir):
    base = os.path.join(tmp_dir, "t")
    assert publish.current(spark, base) is None
    publish.publish(spark, spark.range(3), base)
    reader = publish.current(spark, base)
    publish.publish(spark, spark.range(5), base)
    assert reader.count() == 3 and publish.current(spark, base).count() == 5
    publish.publish(spark, spark.range(7), base)
    assert publish.versions(spark, base) == [1, 2]


def test_merge_keeps_keys_that_rank_low_in_both(spark, tmp_dir):
    n, views_dir, snap = 3, os.path.join(tmp_dir, "v"), os.path.join(tmp_dir, "s")
    batch = [(f"b{i}", 10) for i in range(n)] + [("both", 9)]
    speed_rows = [(f"s{i}", 10) for i in range(n)] + [("both", 9)]
    spark.createDataFrame(batch, "wiki string, edits long").write.parquet(views_dir)
    (table,) = serving.register_views(spark, "editlens_low", {"wiki_edits": views_dir}, os.path.join(tmp_dir, "db"))
    serving.write_snapshot(spark.createDataFrame(speed_rows, "wiki string, count long"), snap, 300)
    assert serving.merged_view(spark, table, snap, n).first().wiki == "both"
    assert [r.wiki for r in serving.merged_view(spark, table, snap + "-none", 1).collect()] == ["b0"]
    assert serving.merged_view(spark, "no.table", snap + "-none", 5).collect() == []
    assert serving.read_snapshot(spark, snap, 20).count() == 4


def test_union_merge_equals_outer_on_random_views(spark):
    import random
    rnd = random.Random(5)
    b = [(f"w{i}", rnd.randint(0, 50)) for i in range(30) if rnd.random() < .7]
    s = [(f"w{i}", rnd.randint(0, 50)) for i in range(30) if rnd.random() < .5]
    bd = spark.createDataFrame(b, "wiki string, edits long")
    sd = spark.createDataFrame(s, "wiki string, count long")
    for n in (1, 5, 40):
        assert merge.lambda_merge(bd, sd, n).collect() == merge.lambda_merge_outer(bd, sd, n).collect()
