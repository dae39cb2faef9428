import datetime as dt
import glob
import os

from editlens.sources import land_raw, raw_inventory
from tests.conftest import edits_df


def rows(n):
    t = dt.datetime(2024, 7, 14, 23, 0, 0)
    return [dict(wiki="enwiki", id=str(i), timestamp=0, event_time=t, arrival_time=t)
            for i in range(n)]


def files(path):
    return sorted(glob.glob(os.path.join(path, "yyyy=*", "mm=*", "dd=*", "HH=*", "*.json")))


def test_flush_on_size(spark, tmp_dir):
    land_raw(edits_df(spark, rows(3)), tmp_dir, max_records_per_file=3)
    fs = files(tmp_dir)
    assert len(fs) == 1 and sum(1 for _ in open(fs[0])) == 3
    assert "yyyy=2024/mm=07/dd=14/HH=23" in fs[0]


def test_pending_records_written(spark, tmp_dir):
    land_raw(edits_df(spark, rows(4)), tmp_dir, max_records_per_file=3)
    fs = files(tmp_dir)
    assert sorted(sum(1 for _ in open(f)) for f in fs) == [1, 3]
    inv = raw_inventory(spark, tmp_dir).first()
    assert inv.objects == 2 and inv.bytes > 0 and inv.truncated is False
