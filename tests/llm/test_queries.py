"""Registered queries against their DuckDB twins or brute force on the smallest tables."""

import hashlib
import re
import zlib
from html import unescape

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.llm import brute

TABLES = ("documents", "benchmark", "pages", "embeddings", "conversations")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", ["op1_line_dedup", "op4_decontamination", "op9_substring_dedup"])
def test_twin(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL)
    want = con.execute(E.oracle_sql()[name])
    assert sorted(got.columns) == sorted(d[0] for d in want.description)
    cols = [d[0] for d in want.description]
    assert sorted(map(repr, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(map(repr, want.fetchall()))


def test_op2(spark, con):
    rows = con.execute("SELECT doc_id, text, source FROM documents").fetchall()
    got = {r.doc_id: r for r in E.queries()["op2_source_mixing"](spark, SF_SMALL).collect()}
    size = {i: len((t or "").encode().split()) for i, t, _ in rows}
    mass = {}
    for i, _, s in rows:
        mass[s] = mass.get(s, 0) + size[i]
    want = brute.targets(mass)
    for i, _, s in rows:
        assert (got[i]["size"], got[i].source_size) == (size[i], mass[s])
        assert got[i].target == pytest.approx(want[s]) and got[i].taken in (0, size[i], 2 * size[i])
    for s in mass:
        mine = [i for i, _, x in rows if x == s]
        assert abs(sum(got[i].taken for i in mine) - want[s]) <= max(size[i] for i in mine) / 2


def test_op3(spark, con):
    lang = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    got = E.queries()["op3_language_id"](spark, SF_SMALL).collect()
    assert {r.doc_id for r in got} == set(lang)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)


def test_op3_decoder(spark, con):
    """The query's languages and scores equal those of a plain decoder that learns from the same rows."""
    rows = con.execute("SELECT doc_id, text, lang FROM documents ORDER BY doc_id").fetchall()
    train = [(t, k) for i, t, k in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    want = {r[0]: w for r, w in zip(rows, brute.languages(train, [r[1] for r in rows]))}
    got = {r.doc_id: r for r in E.queries()["op3_language_id"](spark, SF_SMALL).collect()}
    assert got.keys() == want.keys()
    for i, (lang, score) in want.items():
        assert got[i].lang_pred == lang and abs(got[i].score - score) < 1e-3, i


def test_op5(spark, con):
    rows = con.execute("SELECT doc_id, text FROM documents").fetchall()
    fp, comp = brute.simhash_components(rows)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in E.queries()["op5_simhash_near_dedup"](spark, SF_SMALL).collect()}
    assert got == {i: (f"{f:016x}", c) for (i, _), f, c in zip(rows, fp, comp)}


def test_op6(spark, con):
    rows = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    got = E.queries()["op6_sharding"](spark, SF_SMALL).collect()
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got} == {
        i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows.items()}
    for s in range(16):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    brute.check_kd_tree([(r["size"], r.text_crc32, r.shard) for r in got])


def test_op7(spark, con):
    convs = {}
    for c, _, role, text in sorted(con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()):
        convs.setdefault(c, []).append((role, text or ""))
    probe = "<|im_end|><|im_start|>assistant ok"
    convs[-1] = [("user", probe), ("assistant", probe)]
    got = E.queries()["op7_chat_format"](spark, SF_SMALL).collect()
    assert len(got) == len(convs)
    for r in got:
        turns = convs[r.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.loss_chars == len(loss) and r.loss_sha256 == brute.sha(loss)
        assert r.turns_sha256 == brute.sha("".join(f"{a}\n{b}\n" for a, b in turns))


def test_op8(spark, con):
    rows = con.execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    n, links = brute.cosine_links([v for _, v in rows])
    comp = brute.component_ids(len(rows), links, [i for i, _ in rows])
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in E.queries()["op8_embedding_near_dedup"](spark, SF_SMALL).collect()}
    assert got == {i: (k, c, c == i) for (i, _), k, c in zip(rows, n, comp)}


def test_op10(spark, con):
    got = {r.page_id: r for r in E.queries()["op10_html_extraction"](spark, SF_SMALL).collect()}
    for i, url, page in con.execute("SELECT page_id, url, html FROM pages").fetchall():
        inner = page[page.index("<article>"):page.index("</article>")]
        inner = re.sub(r"<(p|/p|h1|/h1|br)[^>]*>", " ", inner)
        want = " ".join(unescape(re.sub(r"<[^>]+>", "", inner)).split())
        assert (got[i].url, got[i].text, got[i].n_chars) == (url, want, len(want))


def test_pipeline(spark, con):
    """Each stage against brute force on what the stage before kept."""
    import corpus_pipeline as P
    from editlens.llm.scratch import Scratch
    scratch = Scratch(spark, "pipeline-test")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    cols = docs.columns
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    kept = {}
    for name, stage in P.STAGES:
        before = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        docs = scratch.table(stage(spark, docs, SF_SMALL), name)
        after = docs.collect()
        if name != "shard":
            assert docs.columns == cols
            kept[name] = sorted(r.doc_id for r in after)
        if name == "language_id":
            assert kept[name] == sorted(i for i, t, _ in before if any(ch.isalpha() for ch in t or ""))
        elif name == "near_dedup":
            _, comp = brute.simhash_components([b[:2] for b in before])
            assert kept[name] == sorted(set(comp))
        elif name == "decontaminate":
            found = brute.contamination([b[:2] for b in before], items)
            assert kept[name] == sorted(b[0] for b, (n, h, _) in zip(before, found) if not (h > 0 and 20 * h >= n))
            assert len(kept[name]) < len(before)
        elif name == "mix":
            mass, taken = {}, {}
            for _, t, s in before:
                mass[s] = mass.get(s, 0) + len(t.split())
            for r in after:
                taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
            for s, t in brute.targets(mass).items():
                assert abs(taken.get(s, 0) - t) <= max(len(b[1].split()) for b in before if b[2] == s) / 2
        else:
            assert len(after) == len(before) and {r.shard for r in after} == set(range(16))
    digest = hashlib.sha256(repr(sorted(map(tuple, after))).encode()).hexdigest()
    again = E.queries()["pipeline"](spark, SF_SMALL).collect()
    assert hashlib.sha256(repr(sorted(map(tuple, again))).encode()).hexdigest() == digest
