import datetime as dt

from pyspark.sql import functions as F

from editlens.operators import merge
from tests.conftest import edits_df


def views(spark):
    batch = spark.createDataFrame([("enwiki", 100), ("dewiki", 40)], "wiki string, edits long")
    speed = spark.createDataFrame([("enwiki", 5), ("frwiki", 12)], "wiki string, count long")
    return batch, speed


def test_merge_adds_both_layers(spark):
    b, s = views(spark)
    got = [tuple(r) for r in merge.lambda_merge(b, s, 10).collect()]
    assert got == [("enwiki", 105), ("dewiki", 40), ("frwiki", 12)]


def test_union_and_outer_join_agree(spark):
    b, s = views(spark)
    a = merge.lambda_merge(b, s, 10)
    o = merge.lambda_merge_outer(b, s, 10)
    assert sorted(a.collect()) == sorted(o.collect())


def test_degraded_modes(spark):
    b, s = views(spark)
    assert [tuple(r) for r in merge.lambda_merge(None, s, 10).collect()] == \
        [("frwiki", 12), ("enwiki", 5)]
    assert [tuple(r) for r in merge.lambda_merge(b, merge.empty_view(spark), 10,
                                                 speed_value="edits").collect()] == \
        [("enwiki", 100), ("dewiki", 40)]


def test_truncated_merge_can_lose_a_wiki_exact_merge_does_not(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    # 'c' is third in both layers; with n=2 the truncated merge drops it
    for w, n_batch, n_speed in (("a", 5, 0), ("b", 0, 5), ("c", 4, 4)):
        rows += [dict(id=f"{w}b{i}", wiki=w, type="edit", bot=False, event_time=t0)
                 for i in range(n_batch)]
        rows += [dict(id=f"{w}s{i}", wiki=w, type="edit", bot=False,
                      event_time=t0 + dt.timedelta(hours=2)) for i in range(n_speed)]
    df = edits_df(spark, rows)
    cutoff = F.lit(t0 + dt.timedelta(hours=1))
    exact = [tuple(r) for r in merge.lambda_merge_exact(df, cutoff, 2).collect()]
    assert exact == [("c", 8), ("a", 5)]
