import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

FAST = ["wiki_edits", "keywords", "hourly", "edit_types", "namespaces", "record_counts",
        "sliding_edits", "pane_sliding", "trailing_topn", "lambda_merge", "lambda_merge_exact",
        "records_per_min", "lag_alarm", "sentinel_latency", "views_single_pass", "dedupe_by_id",
        "fanout", "tokens", "should_count", "group_key", "log_records", "bytes_per_min",
        "keywords_strict", "throughput_summary", "rate_alarm", "trailing_topn_by_day"]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["wiki", "edits_merged"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def canon(rows):
    out = []
    for r in rows:
        out.append(tuple(round(v, 6) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", FAST)
def test_matches_duckdb_on_small(spark, name):
    con = duckdb.connect()
    for t in ("events", "documents", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    got = canon(tuple(r[c] for c in cols) for r in sdf.collect())
    o = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in o.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = canon(tuple(r[i] for i in idx) for r in o.fetchall())
    assert got == want
