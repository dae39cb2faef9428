import __spark_entry__ as E
from tests.conftest import SF_SMALL

BATCH = ["wiki_edits", "keywords", "doc_keywords", "hourly", "edit_types", "namespaces",
         "sliding_edits", "pane_sliding", "topn_per_window", "trailing_topn", "lambda_merge",
         "lambda_merge_exact", "records_per_min", "lag_alarm", "rate_alarm",
         "sentinel_latency", "views_single_pass", "dedupe_by_id", "fanout", "tokens"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_cross_joins_or_single_task_windows(spark):
    for name in BATCH:
        p = plan(E.queries()[name](spark, SF_SMALL))
        assert "EvalPython" not in p, name
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_topn_is_take_ordered(spark):
    p = plan(E.queries()["wiki_edits"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_scan_is_pruned(spark):
    df = E.queries()["wiki_edits"](spark, SF_SMALL)
    p = plan(df)
    schema = p[p.index("ReadSchema"):].split("\n")[0]
    assert "props" in schema and "user_id" in schema
    assert "value" not in schema and "event_type" not in schema


def test_alarm_is_not_a_global_window(spark):
    p = plan(E.queries()["rate_alarm"](spark, SF_SMALL))
    assert "SinglePartition" not in p


def test_dedupe_and_topn_per_window_reduce_before_shuffle(spark):
    p = plan(E.queries()["dedupe_by_id"](spark, SF_SMALL))
    assert "partial_min" in p
    p = plan(E.queries()["topn_per_window"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


TRAILING = ["trailing_topn", "trailing_size", "lambda_merge", "lambda_merge_outer", "lambda_merge_speed_only"]


def test_both_time_bounds_reach_the_scan(spark):
    for name in TRAILING:
        p = plan(E.queries()[name](spark, SF_SMALL))
        assert any("GreaterThanOrEqual(ts" in x and "LessThanOrEqual(ts" in x
                   for x in p.split("\n") if "PushedFilters" in x), name


def test_no_round_robin_and_no_window_over_unlimited_rows(spark):
    for name in BATCH + TRAILING:
        p = plan(E.queries()[name](spark, SF_SMALL))
        assert "RoundRobinPartitioning" not in p, name
        assert not ("Window [" in p and "SinglePartition" in p), name


def test_snapshot_is_ranked_after_its_limit(spark):
    p = plan(E.queries()["speed_view"](spark, SF_SMALL))
    assert p.index("Window [") < p.index("TakeOrderedAndProject")


def test_shared_folder_is_required_off_local():
    from types import SimpleNamespace

    import pytest

    from editlens.session import shared_root
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    off_local = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(RuntimeError):
        shared_root(off_local)
