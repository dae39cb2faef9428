"""Filter audit, embedding whitening and quality classifier against brute force, odd rows included."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from editlens.llm import filter_audit, quality, whitening
from tests.conftest import SF_MID, SF_SMALL
from tests.llm import brute

RNG = random.Random(11)


def prose(n, words):
    return " ".join(RNG.choice(words) for _ in range(n))


# ------------------------------------------------------------------ filter audit

AUDIT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit_rows():
    many = [f"w{i}" for i in range(400)]
    rows = [(i, prose(RNG.choice([3, 150, 260]), many if RNG.random() < 0.5 else many[:40]), f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, rows[i % 4][1], "s0") for i in range(50)]                      # a hot source with copies
    rows += [(300 + i, None if i % 2 else "", None if i % 3 else "") for i in range(8)]
    rows += [(400, "A|B", "s1"), (401, "#" * 5000, "s1"), (402, "ÉÀ\x0bB \x1f x", "s1"), (403, "   ", "s2"),
             (None, rows[0][1], "s0"), (None, rows[0][1], "s0"), (None, None, None),
             (5, rows[9][1], "s2"), (5, rows[9][1], "s2"), (404, "word " * 30_000, "s2"), (405, "𝔸𝔹 Aa " * 80, "s2")]
    RNG.shuffle(rows)
    labels = [(i, RNG.choice([0, 1, None]), RNG.choice([0, 1, None])) for i in range(0, 160, 2)]
    labels += [(2, 1, 0), (2, 0, 1), (None, 1, 1), (9999, 1, 1)]
    return rows, labels


def frames(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    clash = {c: F.lit("x") for c in ("part", "mask", "digest", "n", "good", "toxic", "salt", "join_id", "f", "role", "quality",
                                     "held_out", "label_id", "first", "same", "score")}
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    return docs.withColumns(clash).repartition(5), labels.withColumns({c: F.lit(1) for c in ("part", "text", "good", "f")})


def test_audit(spark):
    rows, labels = audit_rows()
    got = filter_audit.audit(*frames(spark, rows, labels))
    assert tuple(got.columns) == AUDIT
    assert sorted(map(tuple, got.collect())) == sorted(brute.filter_audit(rows, labels))


def test_audit_of_nothing(spark):
    docs, labels = frames(spark, *audit_rows())
    assert filter_audit.audit(docs.where("false"), labels).collect() == []
    got = filter_audit.audit(docs, labels.where("false"))
    assert {(r.good_lost, r.toxic_lost) for r in got.collect()} == {(0, 0)}


def test_packed_fields_do_not_meet():
    words, n = filter_audit.packed(), (1 << 62) // 5
    total = sum(n * w for w in (words[0], words[-1], words[7], words[66], words[-1]))
    steps = filter_audit.unpack(total)
    assert len(steps) == 600 and max(map(max, steps)) <= 5 * n
    for w in (words[0], words[-1], words[66]):
        assert max(map(max, filter_audit.unpack(w))) <= 1
    with pytest.raises(OverflowError):
        filter_audit.unpack((1 << 63) * words[3])


def test_op12_twin(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(E.oracle_sql()["op12_filter_audit"])
    cols = [d[0] for d in want.description]
    got = E.queries()["op12_filter_audit"](spark, SF_SMALL).select(*cols)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


# ------------------------------------------------------------------ whitening

def check_whitened(got, ids, vectors, count=32):
    x = np.floor(64 * np.array(vectors, dtype=float)) + 1e6
    n, mean = len(x), x.mean(0)
    cov = (x - mean).T @ (x - mean) / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    count = min(count, int((e > 1e-9 * e[0]).sum()))
    by = {}
    for r in got:
        by.setdefault(r.component, {}).setdefault(r.vec_id, r)
    assert sorted(by) == list(range(1, count + 1)) and len(got) == count * n
    z = np.array([[by[c][i].whitened for c in range(1, count + 1)] for i in ids])
    assert np.abs((z - z.mean(0)).T @ (z - z.mean(0)) / n - np.eye(count)).max() < 1e-9
    for c in range(count):
        assert by[c + 1][ids[0]].explained == pytest.approx(e[c] / e.sum(), rel=1e-9)
        alone = min(abs(e[c] - e[k]) for k in range(len(e)) if k != c) > 1e-6 * e[0] if len(e) > 1 else True
        if alone:
            want = (x - mean) @ v[:, c] / np.sqrt(e[c])
            assert min(np.abs(want - z[:, c]).max(), np.abs(want + z[:, c]).max()) < 1e-6
    exact = np.array(x, dtype=np.int64).astype(object)
    dev = ((n * exact - exact.sum(0)) ** 2).sum(1)
    assert [by[1][i].deviation for i in ids] == [int(d) for d in dev]
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def vectors_frame(spark, rows, kind="array<float>"):
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding {kind}")
    return df.withColumns({c: F.lit("x") for c in ("id", "vec", "n", "component", "z", "label", "dim")}).repartition(3)


def test_whiten(spark):
    rng = np.random.default_rng(3)
    clean = [(i, [float(v) for v in rng.normal(size=6) * [3, 2, 1, 1, 0.5, 0.2]]) for i in range(80)]
    clean += [(i + 1000, clean[i % 7][1]) for i in range(30)] + [(1, clean[1][1])] * 3
    dirty = [(500, None), (501, []), (502, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (503, [float("nan")] * 6), (504, [float("-inf")] * 6),
             (505, [1.0, 2.0])]
    got = whitening.whiten(vectors_frame(spark, clean + dirty)).collect()
    ids = [i for i, _ in clean]
    check_whitened(got, ids, [np.float32(v) for _, v in clean])


def test_whiten_without_variance(spark):
    same = [(i, [0.5, 0.25, 1.0]) for i in range(5)]
    assert whitening.whiten(vectors_frame(spark, same)).collect() == []
    assert whitening.whiten(vectors_frame(spark, same).where("false")).collect() == []
    line = [(i, [float(i), float(2 * i), 7.0]) for i in range(9)]                     # rank one
    got = whitening.whiten(vectors_frame(spark, line, "array<double>")).collect()
    check_whitened(got, list(range(9)), [v for _, v in line])


def test_whiten_equal_eigenvalues(spark):
    rows = [(4 * i + s, [float((1 if s % 2 else -1) * (j == i)) for j in range(5)]) for i in range(5) for s in range(4)]
    got = whitening.whiten(vectors_frame(spark, rows)).collect()
    assert {r.component for r in got} == set(range(1, 6)) and max(r.identity_error for r in got) < 1e-9
    assert {round(r.explained, 12) for r in got} == {0.2}


def test_whiten_large_entries(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.integers(-10 ** 9, 10 ** 9, 3)]) for i in range(50)]
    got = whitening.whiten(vectors_frame(spark, rows, "array<double>")).collect()
    assert max(r.identity_error for r in got) < 1e-9 and {r.deviation for r in got} == {None}


def test_gram_is_exact():
    rng = np.random.default_rng(1)
    for top in (100, 1 << 30, 1 << 55):
        y = rng.integers(-top, top, (300, 4))
        assert (whitening.gram(y.astype(np.float64)) == y.astype(np.float64).astype(np.int64).astype(object).T
                @ y.astype(np.float64).astype(np.int64).astype(object)).all()


def test_polynomial_and_roots(spark):
    rng = np.random.default_rng(2)
    b = rng.integers(-9, 9, (4, 6)).astype(object)
    m = [[int(v) for v in line] for line in b.T @ b]                                  # rank 4: two zero roots
    poly = whitening.characteristic_polynomial(spark, m)
    assert poly[-2:] == [0, 0] and poly[1] == -sum(m[i][i] for i in range(6))
    for p in (3, 5, 2147483647):
        assert whitening.polynomial_mod(m, p) == [c % p for c in poly]
    roots = whitening.top_roots(poly, 6)
    want = np.linalg.eigvalsh(np.array(m, dtype=float))[::-1][:4]
    assert [r / 2 ** 128 for r, _ in roots] == pytest.approx(list(want))
    # (x - 2)**2 (x - 3) x: a double root
    assert whitening.top_roots([1, -7, 16, -12, 0], 4) == [(3 << 128, 1), (2 << 128, 2)]
    assert whitening.polynomial_mod([[0, 0], [0, 0]], 7) == [1, 0, 0]
    assert whitening.polynomial_mod([[5]], 7) == [1, 2]


# ------------------------------------------------------------------ quality

def area(good, bad):
    return np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])


def test_op13_held_out(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    got = E.queries()["op13_quality_classifier"](spark, SF_MID).collect()
    assert len(got) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    good, bad = ([r.score for r in held if labels[r.doc_id] == q] for q in (1, 0))
    assert area(good, bad) > 0.97
    assert sum(r.predicted == labels[r.doc_id] for r in held) > 0.93 * len(held)


def pu_rows():
    words = [f"{a}{b}" for a in ("lor", "ip", "do", "sit", "am", "con") for b in ("em", "sum", "lor", "et", "sec")]
    clean = lambda: ". ".join(prose(12, words).capitalize() for _ in range(RNG.randint(2, 8))) + "."
    junk = lambda: RNG.choice(["BUY NOW!!! $$$ ", "a | b | ", "spam spam spam "]) * RNG.randint(5, 40)
    rows = [(i, clean() if i % 4 else junk(), "s") for i in range(400)]
    rows += [(1000, None, None), (1001, "", None), (None, clean(), None), (None, None, None), (1002, "x" * 300_000, "s"),
             (7, rows[7][1], "s"), (7, rows[7][1], "s")]
    return rows, [(i, 1, None) for i in range(0, 400, 3) if i % 4] + [(None, 1, 0), (8, None, 1), (3, 1, 0)]


def test_quality_learns_from_positives_alone(spark):
    rows, labels = pu_rows()
    got = quality.score(*frames(spark, rows, labels)).collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(i for i, _, _ in rows if i is not None)
    score = {r.doc_id: r.score for r in got}
    good, bad = ([score[i] for i in range(400) if score[i] is not None and bool(i % 4) == q] for q in (True, False))
    assert area(good, bad) > 0.99
    assert len({r.score for r in got if r.doc_id == 7}) == 1 and all(0 <= r.score <= 1 for r in got)


def test_quality_does_not_read_labels_of_held_out_rows(spark):
    rows, labels = pu_rows()
    held = {i for i, _, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 4 == 2}
    docs, marks = frames(spark, rows, labels)
    flipped = spark.createDataFrame([(i, 1 - (q or 0) if i in held else q, t) for i, q, t in labels]
                                    + [(i, 1, 0) for i in held], marks.select("doc_id", "quality", "toxic").schema)
    one, two = (sorted((r.doc_id or -1, round(r.score, 9)) for r in quality.score(docs, m).collect()) for m in (marks, flipped))
    assert one == two


def test_quality_without_labels(spark):
    rows, labels = pu_rows()
    docs, marks = frames(spark, rows, labels)
    got = quality.score(docs, marks.where("false")).collect()
    assert {(r.score, r.predicted) for r in got} == {(0.5, 0)} and len(got) == len(rows)
    assert quality.score(docs.where("false"), marks).collect() == []
    full = spark.createDataFrame([(i, int(i is not None and i % 4 > 0), 0) for i, _, _ in rows],
                                 "doc_id bigint, quality int, toxic int")
    assert len(quality.score(docs.where("doc_id is not null"), full).collect()) == len(rows) - 2


def test_prior_is_the_share_of_good_texts(spark):
    rng = np.random.default_rng(4)
    n = 3000
    bad = rng.random(n) < 0.4
    x = np.zeros((2 * n, len(quality.FEATURES)))
    x[:, 0] = np.concatenate([rng.normal(2, 1, n), np.where(bad, rng.normal(-2, 1, n), rng.normal(2, 1, n))])
    rows = spark.createDataFrame([(1 if i < n else 0, [float(v) for v in f]) for i, f in enumerate(x)],
                                 "role int, f array<float>")
    model = quality.train(rows)
    assert model.prior == pytest.approx(0.6, abs=0.05)
    f = quality.basis(x[n:], model.grid) @ model.weights
    assert np.mean((f > 0) == ~bad) > 0.95


# ------------------------------------------------------------------ pipeline stages and columns of any name

STAGE_NAMES = ["_lang_id", "_mix_n", "_mix_id", "_key", "_many", "_bad_id", "row", "id", "from", "copies", "known", "key",
               "keep_id", "bad_key", "many", "a.b", "_row", "fp", "component_id", "col"]


@pytest.mark.parametrize("stage", range(4))
def test_stage_keeps_columns_of_any_name(spark, stage):
    import corpus_pipeline
    name, run = corpus_pipeline.STAGES[stage]
    words = [f"{a}{b}" for a in ("lor", "ip", "do", "sit", "am", "con") for b in ("em", "sum", "lor", "et", "sec")]
    rows = [(i, prose(40, words), "en" if i % 2 else "de", f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, rows[0][1], "en", "s0") for i in range(20)] + [(200, None, None, None), (None, "x y z", None, "s1"),
                                                                     (3, rows[3][1], "en", "s0"), (3, rows[3][1], "en", "s0")]
    plain = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    odd = plain.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) for c in STAGE_NAMES})
    got = run(spark, odd.repartition(3), SF_SMALL)
    assert got.columns == odd.columns
    want = run(spark, plain.repartition(3), SF_SMALL)
    back = got.collect()
    assert sorted(map(repr, (tuple(r)[:4] for r in back))) == sorted(map(repr, map(tuple, want.collect()))) and back
    assert all(r[c] == c + ("" if r.doc_id is None else str(r.doc_id)) for r in back for c in STAGE_NAMES)
    assert run(spark, odd.where("false"), SF_SMALL).collect() == []


def test_language_stage_needs_labels(spark):
    import corpus_pipeline
    docs = spark.createDataFrame([(1, "some text", None, "s")], "doc_id bigint, text string, lang string, source string")
    with pytest.raises(ValueError):
        corpus_pipeline.language_id(spark, docs, SF_SMALL)


def test_op6_bytes_are_near_equal(spark):
    """Every shard within the slack of its cuts and one text of the mean."""
    got = E.queries()["op6_sharding"](spark, SF_MID).collect()
    size = {}
    for r in got:
        size[r.shard] = size.get(r.shard, 0) + r.size
    mean, longest = sum(size.values()) / 16, max(r.size for r in got)
    assert len(size) == 16 and max(abs(s - mean) for s in size.values()) <= longest + 4 * mean / 64


# ------------------------------------------------------------------ pages of other shapes

STORY = "<p>Words of the story go on and on here, with a sentence that is long enough.</p>"
STORY_TEXT = "Words of the story go on and on here, with a sentence that is long enough."
PAGES = {
    "comments beside the article": (
        f"<body><article><h1>T</h1>{STORY}</article><section class=discussion><h2>Talk</h2>"
        + "<p>I do not agree with any of this at all.</p>" * 20 + "</section></body>", f"T {STORY_TEXT}"),
    "comments, adverts and a notice inside it": (
        f"<body><article><h1>T</h1>{STORY}<div class=reader-comments><p>nice one.</p></div><ol class=commentlist><li>hello</li></ol>"
        "<div class=ad-300x250>buy now</div><div class=google-ads>buy</div><div class=sponsored-content>paid</div>"
        f"<div class=notice>we use cookies</div>{STORY}</article></body>", f"T {STORY_TEXT} {STORY_TEXT}"),
    "a section named discussion": (
        f"<body><article>{STORY}<section class=discussion id=discussion><h2>Discussion</h2>{STORY}</section></article></body>",
        f"{STORY_TEXT} Discussion {STORY_TEXT}"),
    "a quote in an unquoted value": (f"<body><article><p>one <a href=it's>link</a> two</p>{STORY}</article><p>it's</p></body>",
                                     f"one link two {STORY_TEXT}"),
    "quotes around an angle": ('<body><article><p title="a > b" data-x=\'c > d\'>text</p></article></body>', "text"),
    "empty and odd comments": (f"<body><article><!-->{STORY}<!-- x --!><p>after</p><!---><p>end</p></article></body>",
                               f"{STORY_TEXT} after end"),
    "a long menu before a short article": (
        "<body><div>" + "<a href=x>Menu entry</a> " * 200 + "</div><article><h1>T</h1><p>Short story.</p></article></body>",
        "T Short story."),
    "no article, unmarked menu and imprint": (
        f"<body><div><a href=/>Home</a> <a href=/a>About</a></div><h1>Title</h1>{STORY * 4}<div>All rights reserved</div></body>",
        " ".join(["Title"] + [STORY_TEXT] * 4)),
}


@pytest.fixture(scope="module")
def page_scores(spark):
    from editlens.llm import html
    return html.learn(spark.read.parquet(f"{SF_SMALL}/pages.parquet"))


@pytest.mark.parametrize("name", PAGES)
def test_page_shapes(page_scores, name):
    from editlens.llm import html
    source, want = PAGES[name]
    assert html.extract(source, page_scores) == want


def test_unclosed_tags_are_read_in_linear_time(page_scores):
    import time

    from editlens.llm import html
    start = time.time()
    html.extract("<article><p " + "a=\"x' b='y\" " * 20_000, page_scores)
    html.extract("<article><p>" + "<a href='x" * 5_000, page_scores)
    assert time.time() - start < 20
