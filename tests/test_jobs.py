"""The spark-submit mains, run as separate processes on landed files."""
import os
import subprocess
import sys

from editlens.operators import views, windows
from editlens.sources import edit_events, land_raw
from editlens.streaming import speed
from tests.conftest import ROOT, SF_SMALL


def run(*args):
    env = dict(os.environ, PYTHONPATH=ROOT)
    r = subprocess.run([sys.executable, "-m", *args], cwd=ROOT, env=env,
                       capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-3000:]


def test_batch_job_main(spark, tmp_dir):
    raw, out = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "out")
    ev = edit_events(spark, SF_SMALL)
    land_raw(ev, raw, max_records_per_file=200)
    run("editlens.plans.batch", raw, out, "--top-n", "10", "--bronze", os.path.join(tmp_dir, "bronze"))
    assert any(d.startswith("event_date=") for d in os.listdir(os.path.join(tmp_dir, "bronze")))
    assert sorted(d for d in os.listdir(out) if not d.startswith("_")) == \
        ["edit_types", "hourly", "keywords", "namespaces", "wiki_edits"]
    got = spark.read.parquet(os.path.join(out, "wiki_edits")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, views.wiki_edits(ev, 10).collect()))


def test_speed_job_main(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    ev = edit_events(spark, SF_SMALL)
    speed.land_events(ev, src)
    run("editlens.streaming.speed", "windowed", src, out, ck, "--available-now")
    got = windows.flatten_window(spark.read.parquet(out))
    want = windows.sliding_edits(ev)
    assert got.count() > 0 and got.exceptAll(want).count() == 0


def test_snapshot_and_serve_mains(spark, tmp_dir):
    src, out, ck, csv, raw, views_dir = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck", "csv", "raw", "views"))
    ev = edit_events(spark, SF_SMALL)
    land_raw(ev, raw)
    speed.land_events(ev, src)
    run("editlens.plans.batch", raw, views_dir, "--include-bots")
    run("editlens.streaming.speed", "snapshot", src, out, ck, "--available-now", "--window", "1 day")
    run("editlens.plans.serving", "serve", "nowhere.wiki_edits", f"{out}/snapshot", "--top-n", "3", "--csv", csv)
    from editlens.plans import serving
    got = [tuple(r) for r in serving.read_csv(spark, csv).collect()]
    top = serving.read_snapshot(spark, f"{out}/snapshot", 3).collect()
    assert got == [(r.wiki, r["count"]) for r in top] and len(got) == 3
    all_wikis = spark.read.parquet(os.path.join(views_dir, "wiki_edits"))
    assert all_wikis.count() == ev.filter("wiki is not null").select("wiki").distinct().count()
