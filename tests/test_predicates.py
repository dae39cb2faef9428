from pyspark.sql import functions as F

from editlens.functions import group_key, not_bot, partition_key, should_count
from tests.conftest import edits_df

# (wiki, title, type, bot) -> keep
TRUTH = [
    (("enwiki", None, "edit", False), True),
    (("enwiki", None, "edit", True), False),
    (("enwiki", None, "log", None), False),
    (("enwiki", None, None, None), True),
    (("enwiki", None, "", None), True),
    (("enwiki", None, "new", None), True),
    (("enwiki", None, "categorize", None), True),
    ((None, "T", "log", None), False),
    ((None, None, "Feature", None), True),
    ((None, None, "Feature", True), False),
]


def test_should_count_truth_table(spark):
    rows = [dict(id=str(i), wiki=w, title=t, type=ty, bot=b)
            for i, ((w, t, ty, b), _) in enumerate(TRUTH)]
    got = {r["id"]: r["keep"] for r in
           edits_df(spark, rows).select("id", should_count().alias("keep")).collect()}
    assert [got[str(i)] for i in range(len(TRUTH))] == [k for _, k in TRUTH]


def test_not_bot_is_null_safe(spark):
    df = edits_df(spark, [dict(id="1", bot=True), dict(id="2", bot=False), dict(id="3", bot=None)])
    assert sorted(r.id for r in df.filter(not_bot()).collect()) == ["2", "3"]


def test_group_key_fallbacks(spark):
    df = edits_df(spark, [dict(id="1", wiki="dewiki"), dict(id="2", wiki=""),
                          dict(id=None, wiki=None), dict(id="", wiki="")])
    got = [r.k for r in df.select(group_key().alias("k")).collect()]
    assert got == ["dewiki", "2", "unknown", "unknown"]


def test_partition_key_truncates_and_defaults(spark):
    long = "x" * 300
    df = edits_df(spark, [dict(wiki=long), dict(wiki=""), dict(wiki=None), dict(wiki="enwiki")])
    got = [r.k for r in df.select(partition_key("wiki").alias("k")).collect()]
    assert got == ["x" * 256, "default", "default", "enwiki"]
    assert df.select(F.length(partition_key("wiki"))).first()[0] == 256


# --- property checks against plain-Python twins (JSON null == absent field) ---

from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

WIKI = st.sampled_from([None, "", "enwiki", "x" * 300])
TITLE = st.sampled_from([None, "", "Page"])
TYPE = st.sampled_from([None, "", "edit", "new", "categorize", "log", "Feature", "EDIT"])
BOT = st.sampled_from([None, True, False])
IDS = st.sampled_from([None, "", "42"])


def py_should_count(r):
    if r["bot"] is True:
        return False
    t = r["type"]
    if t and t not in ("edit", "new", "categorize"):
        if r["wiki"] is not None or r["title"] is not None:
            return False
    return True


def py_group_key(r):
    return str(r["wiki"] or r["id"] or "unknown")


@settings(max_examples=25, deadline=None)
@given(st.lists(st.fixed_dictionaries(dict(wiki=WIKI, title=TITLE, type=TYPE, bot=BOT, id=IDS)),
                min_size=1, max_size=30))
def test_admission_and_key_match_python_twins(spark, recs):
    rows = [dict(r, user=str(i)) for i, r in enumerate(recs)]
    df = edits_df(spark, rows).select("user", should_count().alias("keep"),
                                      group_key().alias("key"))
    got = {r.user: (r.keep, r.key) for r in df.collect()}
    for i, r in enumerate(recs):
        assert got[str(i)] == (py_should_count(r), py_group_key(r)), r
