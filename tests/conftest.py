import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from editlens.session import build_session
    s = build_session("local[4]", app="editlens-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="editlens-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="editlens-test-")


def edits_df(spark, rows):
    """rows: dicts with any EVENT_SCHEMA keys + event_time/arrival_time."""
    from editlens.schema import EDIT_EVENT
    full = [{f.name: r.get(f.name) for f in EDIT_EVENT.fields} for r in rows]
    return spark.createDataFrame(full, EDIT_EVENT)
