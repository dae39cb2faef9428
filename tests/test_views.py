import collections
import datetime as dt
import re

from editlens.config import STOP_WORDS
from editlens.operators import views
from tests.conftest import edits_df

BASE = 1_721_000_000
SAMPLE = [
    ("enwiki", "Volcanic eruption of 1883", "edit", False, 0),
    ("enwiki", "River delta formation", "edit", False, 0),
    ("dewiki", "Schwarzwald und Bodensee", "edit", False, 0),
    ("frwiki", "Fête de la musique", "new", False, 2),
    ("enwiki", "The history of glassblowing", "edit", False, 0),
    ("enwiki", "River otter", "edit", True, 2),
    ("jawiki", "富士山 Fuji", "edit", False, 0),
    ("ruwiki", "Байкал", "categorize", False, 0),
    ("eswiki", "Río de la Plata", "edit", False, 0),
    ("ptwiki", "Pão de Açúcar", "edit", False, 0),
    ("enwiki", "River Thames", "edit", False, 0),
    ("dewiki", "Volcanic winter", "new", False, 0),
    ("enwiki", "Glacier retreat", "edit", False, None),
    ("enwiki", "Tidal energy", "edit", None, 0),
    (None, "Orphan page", "edit", False, 0),
    ("enwiki", "Lighthouse", "log", False, 0),
    ("dewiki", "Eisenbahn", "edit", False, 0),
    ("frwiki", "Côte d'Azur", "edit", False, 0),
    ("enwiki", "Coral reef", None, False, 0),
    ("enwiki", "Desert varnish", "edit", False, 0),
]


def sample(spark):
    rows = []
    for i, (w, t, ty, b, ns) in enumerate(SAMPLE):
        ts = BASE + i * 7
        e = dt.datetime.fromtimestamp(ts, dt.timezone.utc).replace(tzinfo=None)
        rows.append(dict(wiki=w, title=t, type=ty, bot=b, timestamp=ts, user=f"u{i}",
                         namespace=ns, id=str(i), event_time=e, arrival_time=e))
    return edits_df(spark, rows)


def kept():
    return [r for r in SAMPLE if r[3] is not True and r[0] is not None]


def test_wiki_edits(spark):
    want = collections.Counter(r[0] for r in kept())
    got = {r.wiki: r.edits for r in views.wiki_edits(sample(spark), 10).collect()}
    assert got == dict(want)


def test_keywords(spark):
    c = collections.Counter()
    for r in kept():
        c.update(w for w in re.findall(r"[a-zA-Z]{3,}", r[1].lower()) if w not in STOP_WORDS)
    want = sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[:10]
    got = [tuple(r) for r in views.keywords(sample(spark), 10).collect()]
    assert got == want


def test_edit_types_keep_null_group(spark):
    got = {r.type: r.edits for r in views.edit_types(sample(spark)).collect()}
    assert got == dict(collections.Counter(r[2] for r in kept()))
    nonnull = {r.type for r in views.edit_types(sample(spark), keep_null=False).collect()}
    assert None not in nonnull


def test_namespaces_and_hourly(spark):
    got = {r.namespace: r.edits for r in views.namespaces(sample(spark), 10).collect()}
    assert got == dict(collections.Counter(r[4] for r in kept()))
    hours = [tuple(r) for r in views.hourly(sample(spark)).collect()]
    assert hours == [("2024-07-14 23", len(kept()))]


def test_record_counts(spark):
    r = views.record_counts(sample(spark)).first()
    assert (r.total, r.after_bot_filter, r.kept) == (20, 19, len(kept()))


def test_views_single_pass_equals_separate_views(spark):
    df = sample(spark)
    sp = {(r.view, r.key): r.edits for r in views.views_single_pass(df).collect()}
    assert {k: v for (view, k), v in sp.items() if view == "wiki"} == \
        {r.wiki: r.edits for r in views.wiki_edits(df, None).collect()}
    assert {k: v for (view, k), v in sp.items() if view == "type"} == \
        {r.type: r.edits for r in views.edit_types(df).collect()}
    assert sum(v for (view, _), v in sp.items() if view == "hour") == len(kept())


def test_batch_job_single_pass_equals_per_view_scans(spark, tmp_dir):
    from editlens.plans import batch
    from editlens.sources import edit_events
    from tests.conftest import SF_SMALL
    ev = edit_events(spark, SF_SMALL)
    a = batch.run_batch(spark, ev, f"{tmp_dir}/a", 10, single_pass=True)
    b = batch.run_batch(spark, ev, f"{tmp_dir}/b", 10, single_pass=False)
    assert sorted(a) == sorted(b) == sorted(batch.VIEW_NAMES)
    for name in a:
        x, y = spark.read.parquet(a[name]), spark.read.parquet(b[name])
        assert x.schema == y.schema, name
        assert sorted(map(repr, x.collect())) == sorted(map(repr, y.collect())), name


def test_schema_guard_and_empty_input(spark, tmp_dir):
    import pytest
    from editlens.plans import batch
    df = sample(spark).drop("title", "namespace")
    assert sorted(batch.batch_views(df)) == ["edit_types", "hourly", "wiki_edits"]
    paths = batch.run_batch(spark, df, f"{tmp_dir}/g", 10)
    assert sorted(paths) == ["edit_types", "hourly", "wiki_edits"]
    with pytest.raises(SystemExit):
        batch.run_batch(spark, sample(spark).limit(0), f"{tmp_dir}/e", 10)
