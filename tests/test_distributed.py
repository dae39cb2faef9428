"""Same answers when the input is split over many tasks and one key is hot."""
from pyspark.sql import functions as F

from editlens.operators import merge, monitor, views, windows
from editlens.sources import dedupe_by_id, edit_events
from tests.conftest import SF_MID


def skewed(spark, tmp_dir):
    ev = edit_events(spark, SF_MID)
    # a third of all rows re-keyed onto one wiki
    hot = ev.withColumn("wiki", F.when((F.col("id").cast("long") % 3 == 0) &
                                       F.col("wiki").isNotNull(), F.lit("wiki_hot"))
                        .otherwise(F.col("wiki")))
    path = f"{tmp_dir}/split"
    hot.repartition(23).write.parquet(path)
    split = spark.read.parquet(path)
    assert split.rdd.getNumPartitions() > 1
    single = spark.createDataFrame(hot.collect(), hot.schema).coalesce(1)
    return split, single


def same(a, b):
    ra = sorted(map(repr, a.collect()))
    rb = sorted(map(repr, b.collect()))
    assert ra == rb


def test_operators_agree_across_splits_with_a_hot_key(spark, tmp_dir):
    split, single = skewed(spark, tmp_dir)
    hot_share = split.filter(F.col("wiki") == "wiki_hot").count() / split.count()
    assert hot_share > 0.3
    as_of = windows.as_of_literal(split, "event_time")
    for build in (
        lambda d: views.wiki_edits(d, 10),
        lambda d: views.keywords(d, 10),
        lambda d: views.views_single_pass(d),
        lambda d: windows.pane_sliding(d),
        lambda d: windows.topn_per_window(windows.sliding_edits(d), 3),
        lambda d: windows.trailing_topn(d, as_of, 10, 86400, 10),
        lambda d: merge.lambda_merge_exact(d, as_of - F.expr("INTERVAL 1 DAY"), 10),
        lambda d: monitor.sustained_alarm(monitor.lag_per_period(d), 60000.0, 2,
                                          value="max_lag_ms"),
        lambda d: dedupe_by_id(d.select("title", "event_time", "id"), "title",
                               ("event_time", "id")),
    ):
        same(build(split), build(single))
