import datetime as dt
import random

from pyspark.sql import functions as F

from editlens.operators import windows
from tests.conftest import edits_df

T0 = dt.datetime(2024, 7, 14, 23, 33, 20)


def at(s):
    return T0 + dt.timedelta(seconds=s)


def ev(spark, items):
    return edits_df(spark, [dict(id=str(i), wiki=w, type="edit", bot=False, event_time=at(s),
                                 arrival_time=at(s)) for i, (w, s) in enumerate(items)])


def top(spark, items, as_of_s, n, window_s, pane_s):
    df = ev(spark, items)
    return [tuple(r) for r in
            windows.trailing_topn(df, F.lit(at(as_of_s)), n, window_s, pane_s).collect()]


def test_basic(spark):
    assert top(spark, [("enwiki", 0), ("enwiki", 0), ("dewiki", 0)], 0, 3, 60, 5) == \
        [("enwiki", 2), ("dewiki", 1)]


def test_eviction(spark):
    got = top(spark, [("old_item", 0), ("new_item", 2)], 2, 5, 1, 1)
    assert got == [("new_item", 1)]


def test_top_n_ties_break_by_key(spark):
    got = top(spark, [(f"wiki_{i}", 0) for i in range(8)], 0, 3, 60, 5)
    assert got == [("wiki_0", 1), ("wiki_1", 1), ("wiki_2", 1)]


def test_window_size(spark):
    df = ev(spark, [("enwiki", 0)] * 10)
    assert windows.trailing_size(df, F.lit(at(0)), 60, 5).first()["size"] == 10


def test_out_of_order_event_goes_to_its_own_pane(spark):
    # an event stamped before the window start is not live, whatever its order
    got = top(spark, [("a", 100), ("b", 0), ("a", 101)], 101, 5, 60, 10)
    assert got == [("a", 2)]


def test_panes_equal_direct_hopping(spark):
    rnd = random.Random(7)
    items = [(rnd.choice("abcde"), rnd.randint(0, 3 * 3600)) for _ in range(600)]
    df = ev(spark, items)
    a = windows.sliding_edits(df)
    b = windows.pane_sliding(df)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_sliding_matches_brute_force(spark):
    rnd = random.Random(3)
    items = [(rnd.choice("xy"), rnd.randint(0, 1800)) for _ in range(80)]
    got = {(r.window_start, r.wiki): r.edits for r in windows.sliding_edits(ev(spark, items)).collect()}
    want = {}
    for w, s in items:
        t = at(s)
        m = t.replace(second=0, microsecond=0)
        for i in range(5):
            start = m - dt.timedelta(minutes=i)
            want[(start, w)] = want.get((start, w), 0) + 1
    assert got == want


def test_topn_per_window_uses_partial_group_limit(spark):
    df = ev(spark, [("a", 0), ("b", 0), ("b", 1), ("c", 70)])
    res = windows.topn_per_window(windows.sliding_edits(df), 1)
    rows = {(r.window_start, r.wiki, r.rank) for r in res.collect()}
    assert all(rank == 1 for _, _, rank in rows)
    assert (at(0).replace(second=0), "b", 1) in rows
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_pane_form_falls_back_when_not_aligned(spark):
    from editlens.operators.windows import duration_seconds, panes_are_exact
    assert duration_seconds("5 minutes") == 300 and duration_seconds("1 hour") == 3600
    assert panes_are_exact("5 minutes", "1 minute", 10)
    assert not panes_are_exact("5 minutes", "45 seconds", 10)
    rnd = random.Random(9)
    df = ev(spark, [(rnd.choice("ab"), rnd.randint(0, 1200)) for _ in range(200)])
    a = windows.sliding_edits(df, window="70 seconds", slide="35 seconds")
    b = windows.pane_sliding(df, window="70 seconds", slide="35 seconds", pane_s=10)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_trailing_window_prunes_date_partitions(spark, tmp_dir):
    from editlens.plans.batch import to_bronze
    items = [("a", 0), ("b", 3 * 86400), ("a", 3 * 86400 + 5)]
    to_bronze(ev(spark, items), tmp_dir)
    bronze = spark.read.parquet(tmp_dir)
    res = windows.trailing_topn(bronze, F.lit(at(3 * 86400 + 5)), 10, 60, 5)
    assert [tuple(r) for r in res.collect()] == [("a", 1), ("b", 1)]
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_latest_event_reads_the_newest_day_alone(spark, tmp_dir):
    from editlens.plans.batch import to_bronze
    items = [("a", 0), ("b", 3 * 86400), ("a", 3 * 86400 + 5), ("c", 86400)]
    to_bronze(ev(spark, items).union(ev(spark, [("d", 1)]).withColumn("event_time", F.lit(None).cast("timestamp"))), tmp_dir)
    bronze = spark.read.parquet(tmp_dir)
    newest = windows.newest_day(bronze)
    assert newest.count() == 2 and "PartitionFilters: [isnotnull(event_date" in newest._jdf.queryExecution().executedPlan().toString()
    row = spark.range(1).select(windows.as_of_literal(bronze, "event_time").alias("x"),
                                windows.as_of_literal(bronze.where("wiki = 'none'"), "event_time").alias("y")).first()
    assert row.x.replace(tzinfo=None) == at(3 * 86400 + 5) and row.y is None
