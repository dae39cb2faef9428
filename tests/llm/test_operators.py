"""Operators against brute force, on crafted rows that hold every odd case:
nulls, empty and long texts, ties, repeated rows, clashing extra columns, empty tables."""

import math
import random
import re
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from editlens.llm import (chat, covertree, decontam, html, langid, lines, mixing, sharding, simhash,
                          substrings)
from tests.llm import brute

RNG = random.Random(7)
VOCAB = ["".join(RNG.choice("abcdefgh") for _ in range(RNG.randint(2, 6))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCAB) for _ in range(n))


def documents():
    base = prose(120, 1)
    words = base.split()
    rows = [(i, prose(RNG.randint(5, 80), 100 + i), "en", f"s{i % 5}") for i in range(10, 50)]
    rows += [(60 + i, base, "en", "s0") for i in range(40)]                           # a hot group of copies
    for i in range(40):                                                               # near copies
        w = list(words)
        w[(7 * i) % len(w)] = f"x{i}"
        rows.append((200 + i, " ".join(w), "en", "s1"))
    rows += [(1, None, None, None), (2, "", "en", "s2"), (3, " \n\t ", "en", "s2"), (4, "one", "en", None),
             (5, "Two Words", "de", "s3"), (None, base, "en", "s3"), (None, None, None, None),
             (6, prose(6000, 9), "en", "s4"), (7, "ÉÀ ßü " * 20, "fr", "s4"), (8, base.upper(), "en", "s2"),
             (9, base, "en", "s1"), (9, base, "en", "s1"), (9, "same id other text " * 9, "en", "s1")]
    RNG.shuffle(rows)
    return rows


CLASH = ["fp", "component_id", "_id", "_key", "_text", "n", "u", "v", "key", "h", "size", "target", "copies", "kept",
         "seed", "at", "shard", "slot", "_w", "tok", "items", "wkey", "_doc", "_source", "mass"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(documents(), "doc_id bigint, text string, lang string, source string")
    return df.withColumns({c: F.lit("clash") for c in CLASH}).repartition(4).cache()


@pytest.fixture(scope="module")
def no_docs(docs):
    return docs.where("false")


def keyed(rows):
    return sorted(rows, key=repr)


# ------------------------------------------------------------------ lines

def test_lines(spark):
    rows = [(i, f"menu home\nbody {i}\n menu home \n\nunique {i}", f"site{i % 12}") for i in range(60)]
    rows += [(100 + i, f"nine sites\nx{i}", f"site{i % 9}") for i in range(30)]
    rows += [(200 + i, f"ten sites\ny{i}", f"site{i % 10}") for i in range(30)]
    rows += [(300, None, "site1"), (301, "", "site2"), (302, "menu home", None), (None, "menu home\na", "s"),
             (0, rows[0][1], "site0")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("h", F.lit(1))
    got = [tuple(r) for r in lines.dedup_lines(df).collect()]
    want = [(r[0], *w) for r, w in zip(rows, brute.line_dedup(rows, 10))]
    assert keyed(got) == keyed(want)
    assert lines.dedup_lines(df.where("false")).collect() == []


def test_lines_near_threshold_are_counted(spark):
    for sites, gone in ((9, 0), (10, 1), (11, 1), (200, 1)):
        df = spark.createDataFrame([(i, "the line", f"s{i}") for i in range(sites)], "doc_id int, text string, source string")
        assert {r.n_removed for r in lines.dedup_lines(df).collect()} == {gone}


# ------------------------------------------------------------------ mixing

def test_mix(docs):
    out = mixing.mix(docs).collect()
    rows = documents()
    assert len(out) == docs.count()
    mass = {}
    for _, t, _, s in docs.select("doc_id", "text", "lang", "source").collect():
        mass[s] = mass.get(s, 0) + len((t or "").encode().split())
    want = brute.targets(mass)
    taken = {}
    for r in out:
        assert r.source_size == mass[r._source] and r.target == pytest.approx(want[r._source])
        assert 0 <= r.copies <= 2
        taken[r._source] = taken.get(r._source, 0) + r.copies * r.size
    for s, t in want.items():
        biggest = max([r.size for r in out if r._source == s])
        assert abs(taken[s] - t) <= max(biggest, 0.05 * t), s
    assert len(rows) == len(out)
    again = mixing.mix(docs.repartition(3)).collect()
    key = lambda r: (str(r.doc_id), r._key, str(r._source), r.copies)
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_mix_empty_and_sizeless(spark, no_docs):
    assert mixing.mix(no_docs).collect() == []
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, None, None)], "doc_id int, text string, source string")
    assert {(r.doc_id, r.size, r.target) for r in mixing.mix(df).collect()} == {(1, 0, 0.0), (2, 0, 0.0), (3, 0, 0.0)}


def test_mix_copies_rows(docs):
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns
    total = sum(r.copies for r in mixing.mix(docs).collect())
    assert out.count() == total


def test_balance_two_dimensions(spark):
    from editlens.llm.scratch import Scratch
    cells = spark.createDataFrame([("a", "x", 10), ("a", "y", 30), ("b", "x", 40), ("b", "y", 20)], "s string, l string, mass long")
    ts = spark.createDataFrame([("a", 50.0), ("b", 50.0)], "value string, target double")
    tl = spark.createDataFrame([("x", 70.0), ("y", 30.0)], "value string, target double")
    r = mixing.balance(cells, {"s": ts, "l": tl}, Scratch(spark, "t")).collect()
    for d, want in (("s", {"a": 50, "b": 50}), ("l", {"x": 70, "y": 30})):
        for v, t in want.items():
            assert sum(x.mass * x.rate for x in r if x[d] == v) == pytest.approx(t)
    # exponentially tilted: the odds ratio of the cells stays
    rate = {(x.s, x.l): x.rate for x in r}
    assert rate["a", "x"] * rate["b", "y"] == pytest.approx(rate["a", "y"] * rate["b", "x"])


# ------------------------------------------------------------------ language

def test_language(spark):
    words = {"aa": ["kal", "tuk", "miro", "kalu"], "bb": ["schön", "für", "über", "straße"], "cc": ["élan", "où", "ça", "être"]}
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(words[k]) for _ in range(r.randint(1, 30))), k)
            for i, k in enumerate(r.choice(list(words)) for _ in range(300))]
    odd = [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 %% 45", "cc"), (1003, "kal tuk", None),
           (None, "für über", "bb"), (1004, "élan " * 60000, "cc")]
    df = spark.createDataFrame(rows + odd + rows[:5], "doc_id bigint, text string, lang string")
    held = langid.held_out(F.col("doc_id"))
    model = langid.train(df.where(~held))
    out = df.select("doc_id", "lang", held.alias("held"), langid.predict(F.col("text"), model).alias("p")).collect()
    by = {r.doc_id: r for r in out}
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out if r.doc_id is not None)
    test = [r for r in out if r.held and r.lang and r.p.lang_pred != "und"]
    assert sum(r.p.lang_pred == r.lang for r in test) >= 0.97 * len(test)
    assert all(by[i].p.lang_pred == "und" and by[i].p.score == 0 for i in (1000, 1001, 1002))
    assert by[1003].p.lang_pred == "aa" and by[1004].p.lang_pred == "cc" and by[None].p.lang_pred == "bb"
    assert all(0 <= r.p.score <= 1 for r in out)


def test_language_without_labels(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id int, text string, lang string")
    model = langid.train(df)
    assert df.select(langid.predict(F.col("text"), model).alias("p")).first().p.lang_pred == "und"
    one = langid.train(spark.createDataFrame([(1, "abc", "xx")], "doc_id int, text string, lang string"))
    assert df.select(langid.predict(F.col("text"), one).alias("p")).first().p.lang_pred == "xx"


def test_codes_correct_errors():
    for n in (2, 3, 4, 7, 12, 60):
        c = langid.codewords(n)
        assert len({tuple(r) for r in c}) == n
        least = min((a != b).sum() for a, b in combinations(c, 2))
        assert least >= (2 ** (n - 2) if n <= 7 else 5)


# ------------------------------------------------------------------ decontamination

def test_decontaminate(spark, docs):
    texts = {d[0]: d[1] for d in documents() if d[0] in (6, 20, 60)}
    w = texts[6].split()
    items = [(1, " ".join(w[50:80])), (2, texts[60][:200]), (10, "one"), (11, "Two WORDS"), (12, None), (13, "..."),
             (14, " ".join(w[60:90])), (1, " ".join(w[50:80])), (None, " ".join(w[100:113])), (15, prose(40, 777)), (16, "ÉÀ ßü ÉÀ"),
             (17, "éà ßü éà")]
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("tok", F.lit(0)).withColumn("_w", F.lit(0))
    out = decontam.decontaminate(docs, bench).collect()
    src = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = [(i, n, h, its, h > 0 and 20 * h >= n) for (i, _), (n, h, its) in zip(src, brute.contamination(src, items))]
    assert keyed((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in out) == keyed(want)
    assert sum(x[4] for x in want) > 5


def test_decontaminate_by_shuffle(monkeypatch, spark, docs):
    """Sides too large to broadcast take the shuffled path, with equal results."""
    bench = spark.createDataFrame([(1, documents()[3][1]), (2, "one"), (3, prose(120, 1)[:300])], "item_id int, text string")
    small = keyed(map(repr, decontam.decontaminate(docs, bench).collect()))
    monkeypatch.setattr("editlens.llm.scratch.BROADCAST_BYTES", -1)
    assert keyed(map(repr, decontam.decontaminate(docs, bench).collect())) == small


def test_decontaminate_cuts_each_text_once_a_pass(spark, docs):
    """No filter below the projection repeats the cutting of texts into words."""
    rows = docs.select(decontam.words("text").alias("_w"))
    for heads in (False, True):
        for ks in ([3], [1, 2, 3]):
            plan = decontam._doc_shingles(rows, ks, heads)._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("split(") + plan.count("regexp_extract_all(") == 1


def test_decontamination_words_are_those_of_the_pattern(spark):
    """Every ASCII character, other scripts, letters whose lower case is ASCII only in Unicode, pairs of surrogates."""
    texts = ["".join(map(chr, range(128))), "".join(f"a{chr(c)}B" for c in range(128)), " x  y ", "\0\0", "", None,
             "K Å İ ΣΑΣ. ΟΔΟΣ'Σ", "𝔸𝔹 Aa\u00a0b\u2028c", "a\\b|c.d$e^f[g]"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select(
        "i", decontam.words("text").alias("w")).collect()
    lower = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    assert {r.i: r.w for r in got} == {i: re.findall(pattern, (t or "").translate(lower)) for i, t in enumerate(texts)}


def test_decontaminate_empty(docs, no_docs, spark):
    bench = spark.createDataFrame([(1, "one")], "item_id int, text string")
    assert decontam.decontaminate(no_docs, bench).collect() == []
    out = decontam.decontaminate(docs, bench.where("false"))
    assert out.count() == docs.count() and out.where("n_hit > 0 or contaminated").isEmpty()
    kept = decontam.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1


# ------------------------------------------------------------------ SimHash

def test_golay_keys_meet():
    r = np.random.default_rng(1)
    fp = r.integers(-2**63, 2**63, 500, dtype=np.int64)
    for bits in (0, 1, 2):
        other = fp.copy()
        for k in range(len(fp)):
            for b in r.choice(64, bits, replace=False):
                other[k] = np.int64(int(other[k]) ^ (1 << int(b)) if b < 63 else int(other[k]) ^ -(1 << 63))
        (ra, ka), (rb, kb) = simhash.golay_keys(fp), simhash.golay_keys(other)
        for k in range(len(fp)):
            assert set(ka[ra == k].tolist()) & set(kb[rb == k].tolist())


@pytest.mark.parametrize("crowded", [1, 32])
def test_simhash(docs, crowded, monkeypatch):
    monkeypatch.setattr(simhash.links, "__defaults__", (simhash.MAX_BITS, crowded))
    src = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    fp, comp = brute.simhash_components(src)
    got = simhash.near_duplicates(docs).select("doc_id", simhash.hex_fingerprint(), "component_id").collect()
    assert keyed(tuple(r) for r in got) == keyed((i, f"{f:016x}", c) for (i, _), f, c in zip(src, fp, comp))


def test_simhash_keep_one(docs, no_docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    src = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    fp, comp = brute.simhash_components(src)
    groups = {}
    for (i, t), f in zip(src, fp):
        groups.setdefault(f, []).append(i)
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(x for x in ids if x is not None) == sorted(set(c for c in comp if c is not None))
    assert simhash.near_duplicates(no_docs).collect() == [] and simhash.keep_one(no_docs).collect() == []


# ------------------------------------------------------------------ sharding

@pytest.mark.parametrize("shards", [16, 5])
def test_shard(docs, shards):
    out = sharding.shard(docs, shards=shards).collect()
    src = docs.select("text").collect()
    size = lambda t: len((t or "").encode()) + 1
    assert sorted(r.size for r in out) == sorted(size(r.text) for r in src)
    assert sorted(r.text_crc32 for r in out) == sorted(zlib.crc32((r.text or "").encode()) for r in src)
    total, most = sum(r.size for r in out), max(r.size for r in out)
    for s in range(shards):
        mine = [r for r in out if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        assert abs(sum(r.size for r in mine) - total / shards) <= max(most, 0.1 * total / shards) + most


def test_shard_empty_and_same(spark, no_docs):
    assert sharding.shard(no_docs).collect() == []
    same = spark.createDataFrame([(i, "equal text") for i in range(1600)], "doc_id int, text string")
    per = [r["count"] for r in sharding.shard(same).groupBy("shard").count().collect()]
    assert len(per) == 16 and max(per) <= 1.3 * min(per)


# ------------------------------------------------------------------ chat

def test_chat_round_trip(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", r"<\|im_end|>", r"<\\|", "<", "<|", "\n", "", None, "a<|b|>\\", "%0A%3C|", "x\ny\n"]
    rows, want = [], {}
    r = random.Random(5)
    for c in range(40):
        turns = [(k, r.choice(["user", "assistant", "system", "we\nird%3C|<|", "", None]), r.choice(nasty)) for k in range(r.randint(1, 6))]
        rows += [(c, *t) for t in turns]
        want[c] = [((b or ""), (t or "")) for _, b, t in turns]
    df = spark.createDataFrame(r.sample(rows, len(rows)), "conv_id int, turn int, role string, text string").withColumn("segments", F.lit(1))
    out = chat.format_chat(df)
    got = out.select("conv_id", "n_turns", "formatted", "segments", chat.read_back(F.col("formatted")).alias("back"),
                     chat.loss_text(F.col("segments")).alias("loss")).collect()
    assert len(got) == 40
    for g in got:
        assert [(t.role, t.text) for t in g.back] == want[g.conv_id] and g.n_turns == len(want[g.conv_id])
        assert g.loss == "".join(t for role, t in want[g.conv_id] if role == "assistant")
        assert "".join(s.text for s in g.segments) == g.formatted
    assert chat.format_chat(df.where("false")).collect() == []


def test_chat_machine(spark):
    cases = {1: ("user assistant", None), 2: ("system user assistant user assistant", None), 3: ("assistant", 0),
             4: ("user user assistant", 1), 5: ("user", 1), 6: ("user assistant robot", 2), 7: ("system assistant", 1)}
    rows = [(c, k, role, "t") for c, (roles, _) in cases.items() for k, role in enumerate(roles.split())]
    out = chat.format_chat(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()
    assert {r.conv_id: r.bad_turn for r in out} == {c: bad for c, (_, bad) in cases.items()}
    assert all(r.valid == (r.bad_turn is None) for r in out)
    # ties, repeated rows and a null conversation have one order
    tied = [(None, 1, "user", "b"), (None, 1, "user", "a"), (None, 1, "user", "a"), (None, None, "user", "z")]
    one = chat.format_chat(spark.createDataFrame(tied, "conv_id int, turn int, role string, text string")).collect()
    assert len(one) == 1 and [s.text for s in one[0].segments][1::3] == ["z", "a", "a", "b"]


# ------------------------------------------------------------------ embeddings

def test_covertree(spark, monkeypatch):
    monkeypatch.setattr(covertree, "BLOCK", 40)
    r = np.random.default_rng(2)
    rows = [r.normal(size=12).tolist() for _ in range(150)]
    for c in range(6):
        centre = r.normal(size=12)
        rows += [(centre + r.normal(scale=0.09 * (c + 1), size=12)).tolist() for _ in range(30)]
    rows += [rows[0]] * 5 + [(3 * np.array(rows[1])).tolist(), [0.0] * 12, [float("nan")] * 12, [None] + [1.0] * 11, None, [],
                             [float("inf")] + [1.0] * 11, [1.0, 0.0], [1.0, 0.01], [1e-300] * 12, [1e300] * 12, [-0.0] * 12]
    data = [(i if i % 50 else None, v, 0) for i, v in enumerate(rows)] + [(7, rows[7], 0)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>, root int")
    n, links = brute.cosine_links([[float(x) / 1e300 for x in v] if v and v[0] == 1e300 else [1.0] * 12 if v and v[0] == 1e-300 else v
                                   for _, v, _ in data])
    comp = brute.component_ids(len(data), links, [d[0] for d in data])
    got = covertree.near_duplicates(df).collect()
    assert keyed(tuple(x) for x in got) == keyed((d[0], k, c) for d, k, c in zip(data, n, comp))
    assert max(n) > 20
    assert covertree.near_duplicates(df.where("false")).collect() == []


def test_covertree_whole_nodes():
    """Counts and components of the dual traversal equal those of all pairs, for one tree and for two, where
    clusters lie wholly within the threshold, across it and beyond it."""
    import numpy as np
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(6, 8))
    for spread in (0.01, 0.1, 0.25):
        raw = [covertree.unit(np.repeat(middles, 20, axis=0) + spread * rng.normal(size=(120, 8))) for _ in range(2)]
        weights = [rng.integers(1, 5, 120) for _ in range(2)]
        trees = [covertree.Tree.build(p) for p in raw]
        for same in (True, False):
            points = raw[0] if same else np.concatenate(raw)
            w = weights[0] if same else np.concatenate(weights)
            near = points @ points.T >= 0.95
            if same:
                np.fill_diagonal(near, False)
            else:
                near[:120, :120] = near[120:, 120:] = False
            n, u, v = covertree.dual(trees[0], trees[0 if same else 1], weights[0], weights[0 if same else 1], 0.95, same)
            assert n.tolist() == (near @ w).tolist()
            x, y = np.nonzero(near)
            assert covertree.roots(len(w), u, v).tolist() == covertree.roots(len(w), x, y).tolist()


def test_covertree_dense_block():
    """4000 near copies: whole nodes are linked, no pair of single vectors is made."""
    import numpy as np
    rng = np.random.default_rng(6)
    points = covertree.unit(rng.normal(size=(1, 64)) + 0.004 * rng.normal(size=(4000, 64)))
    tree, one = covertree.Tree.build(points), np.ones(4000, np.int64)
    n, u, v = covertree.dual(tree, tree, one, one, 0.95, True)
    assert (n == 3999).all() and len(u) < 10_000 and not covertree.roots(4000, u, v).any()


def test_covertree_pairs_of_blocks_grow_with_the_vectors(spark, monkeypatch, tmp_path):
    """Tight clusters, more than the pivots can tell apart: pairs of blocks that meet grow with the number of
    vectors, not with its square; counts are those of the clusters."""
    monkeypatch.setattr(covertree, "BLOCK", 64)
    r = np.random.default_rng(8)
    middles = r.normal(size=(500, 64))
    seen = []
    for copies in (4, 16):
        points = np.repeat(middles, copies, axis=0) + 0.02 * r.normal(size=(500 * copies, 64))
        rows = [(i, v.tolist(), 1) for i, v in enumerate(points)]
        df = spark.createDataFrame(rows, "_key bigint, _v array<double>, _m bigint").repartition(8).cache()
        scratch = covertree.Scratch(spark, "growth")
        blocks = covertree._blocks(df, 0.95, scratch)
        links = covertree._links(blocks, 0.95, scratch).groupBy("_key").sum("n").collect()
        assert len(links) == len(rows) and {x[1] for x in links} == {copies - 1}
        near = spark.read.parquet(f"{scratch.base}/near")
        seen.append((blocks.count(), near.where("b is not null").count()))
        assert near.count() < 4 * len(rows)
        df.unpersist()
    (few, pairs), (many, more) = seen
    assert pairs < 4 * few and more < 4 * many and many > 2 * few, seen


def test_covertree_distributed_levels(spark, monkeypatch):
    """Nodes with more than a block are divided until they fit; a tight ball that no pivot can part is cut by hash."""
    monkeypatch.setattr(covertree, "BLOCK", 32)
    monkeypatch.setattr(covertree, "DEAL", 50)
    monkeypatch.setattr(covertree, "NODE_SAMPLE", 100)
    r = np.random.default_rng(9)
    ball = r.normal(size=(1, 16)) + 0.002 * r.normal(size=(200, 16))
    points = np.concatenate([ball, r.normal(size=(400, 16))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "vec_id bigint, embedding array<double>")
    met = []
    near = covertree._near
    monkeypatch.setattr(covertree, "_near", lambda *a: met.append(near(*a)) or met[-1])
    n, links = brute.cosine_links(points.tolist())
    comp = brute.component_ids(len(points), links, list(range(len(points))))
    assert sorted(tuple(x) for x in covertree.near_duplicates(df).collect()) == list(zip(range(len(points)), n, comp))
    # blocks of the ball are linked by their upper nodes: they do not meet
    assert met[0].where("b is null").count() >= 200 / 32 and met[0].where("b is not null").count() < 400


def test_covertree_joined():
    """Links of a mask connect what its cells connect."""
    r = np.random.default_rng(1)
    for share in (0.02, 0.1, 0.6):
        mask = r.random((30, 40)) < share
        u, v = covertree._joined(mask, 5, 100)
        i, j = np.nonzero(mask)
        assert len(u) <= 70 and covertree.roots(140, u, v).tolist() == covertree.roots(140, i + 5, j + 100).tolist()


# ------------------------------------------------------------------ substrings

@pytest.mark.parametrize("group,stream", [(256, 4096), (1, 1), (2, 3)])
def test_substrings(spark, docs, group, stream, monkeypatch):
    monkeypatch.setattr(substrings, "GROUP", group)
    monkeypatch.setattr(substrings, "STREAM", stream)
    shared, line = prose(60, 55), prose(6, 56)
    rows = [tuple(x) for x in docs.select("doc_id", "text").collect()]
    rows += [(500 + i, f"{prose(30, 900 + i)} {shared} {prose(20, 950 + i)} {line} {prose(15, 990 + i)} {line}") for i in range(30)]
    rows += [(600, shared + " " + shared), (601, "a " * 100), (602, "a " * 50), (603, prose(12, 4)), (604, prose(12, 4)),
             (605, prose(13, 4)), (606, prose(13, 4))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("seed", F.lit(1)).withColumn("_id", F.lit(2))
    got = substrings.dedup(df).collect()
    want = [(r[0], n, n - len(k), " ".join(k)) for r, (n, k) in zip(rows, brute.substring_dedup(rows))]
    assert keyed(tuple(r) for r in got) == keyed(want)


def test_substring_runs():
    """Windows of equal words have the same phrase, wherever they are; documents do not mix."""
    texts = [prose(40, 3).encode().split(), [], prose(12, 5).encode().split(), ("p q " + prose(40, 3)).encode().split(),
             [b"a"] * 60]
    seed, at, counts = substrings.runs(texts)
    assert counts[1] == counts[2] == 0 and (at & 15).max() <= substrings.REACH
    phrase = {}
    ends = counts.cumsum()
    for d, (lo, hi) in enumerate(zip(ends - counts, ends)):
        starts = []
        for s, a in zip(seed[lo:hi].tolist(), at[lo:hi].tolist()):
            for k in range(a >> 4, (a >> 4) + (a & 15)):
                starts.append(k)
                assert phrase.setdefault(tuple(texts[d][k:k + 13]), s) == s
        assert starts == list(range(max(0, len(texts[d]) - 12)))


def test_substring_automaton_decides():
    """What a piece's windows are found to be comes from the automaton over the owned windows alone: pieces carry no
    digest, and a piece beside an owner of other windows finds nothing."""
    import pyarrow as pa
    a, b = prose(20, 70), prose(20, 71)
    near = " ".join(a.split()[:13] + b.split()[:7])
    rows = [(1, 0, 0, 0b101, True, 1, 1, a, 10), (1, 0, 0, 0, True, 2, 2, near, 20), (1, 0, 0, 0, True, 3, 3, b, 30),
            (1, 0, 1, 0, True, 4, 4, a, 40), (2, 0, 0, 0b1, False, 5, 5, b, 50), (2, 0, 0, 0, True, 6, 6, b, 60)]
    names = ["seed", "part", "salt", "bits", "reads", "p1", "p2", "piece", "low"]
    whole = pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows])
    for batches in ([whole], [whole.slice(i, 1) for i in range(len(rows))]):
        got = [tuple(r.values()) for out in substrings._stream(iter(batches)) for r in out.to_pylist()]
        assert got == [(1, 1, [{"off": 0, "low": 10}, {"off": 2, "low": 10}]), (2, 2, [{"off": 0, "low": 10}]),
                       (6, 6, [{"off": 0, "low": 50}])]


def test_substrings_empty(no_docs):
    assert substrings.dedup(no_docs).collect() == []


# ------------------------------------------------------------------ HTML

PAGE = """<html><head><title>T</title></head><body class="has-sidebar"><header><h1>Site</h1></header>
<div id="cookie-notice">We use cookies</div><nav><a href=x>Home</a></nav><aside>side text</aside>
<main><article class="post"><header><h1>Real title</h1></header><p>Para <i>one</i> with&nbsp;text &amp; more.<div class="ad">BUY</div>
<p>Second<br>para</p><table><tr><td>cell a<td>cell b</table><form><label>Name</label><input></form>
<section id="comments"><p>first! a long comment by somebody on the internet</p></section></article></main>
<div class=sidebar><p>popular posts</p></div><footer>foot</footer><script>var x="<p>no</p>";</script></body></html>"""
MAIN = "Real title Para one with text & more. Second para cell a cell b"


def test_html(spark):
    plain = PAGE.replace("<main>", "").replace("</main>", "").replace('<article class="post"><header>', "<div>").replace(
        "</h1></header><p>Para", "</h1><p>Para").replace("</article>", "</div>")
    pages = [(1, PAGE, MAIN), (2, None, ""), (3, "", ""), (4, plain, MAIN), (5, "only words", "only words"),
             (6, "<nav>a b c</nav>", ""), (7, "<p>a < b &lt; c<p>d", "a < b < c d"), (8, PAGE[:700], None), (1, PAGE, MAIN),
             (9, "<article>" + "<p>word word</p>" * 20000 + "</article>", " ".join(["word word"] * 20000)),
             (10, "<article><p>kept<script>if (a</b) '</p>'</script> on</p><!-- gone --><p>x</article><footer>f", "kept on x")]
    df = spark.createDataFrame([(i, h, 0) for i, h, _ in pages], "page_id int, html string, text int")
    weights = html.learn(df)
    got = df.select("page_id", html.main_text(F.col("html"), weights).alias("t")).collect()
    by = {r.page_id: r.t for r in got}
    assert len(got) == len(pages)
    for i, _, want in pages:
        if want is not None:
            assert by[i] == want, i
    assert html.learn(df.where("false")) == {}


def test_html_wrappers():
    """A furniture mark around the page's text does not empty the page."""
    text = " ".join(f"word{i}" for i in range(60))
    body = f"<main><article><h1>Title</h1><p>{text}</p></article></main>"
    side = "<div class=sidebar><p>popular posts</p></div>"
    for source in (f"<head><title>t</title><meta charset=utf-8><body>{body}", f"<head><title>t</title>{body}",
                   f'<body><div class="layout has-sidebar">{body}{side}</div>', f'<form id="aspnetForm">{body}{side}</form>',
                   f'<div class="layout has-sidebar"><article class="post has-comments"><h1>Title</h1><p>{text}</article>{side}</div>',
                   f'<main><div class=with-sidebar><article><h1>Title</h1><p>{text}</article>{side}</div></main>',
                   f'<div class="layout has-sidebar"><div id=c><h1>Title</h1><p>{text}</div>{side}</div>'):
        assert html.extract(source, {}) == f"Title {text}", source
    assert html.extract(f"<head><title>t</title>{text}", {}) == text
    # furniture longer than the text stays out
    for name in ("comments", "ad", "related-posts"):
        assert html.extract(f"<div id=c><p>{text}</p></div><div class={name}><p>{text} {text}</p></div>", {}) == text
        assert html.extract(f"<article><p>{text}</p></article><div class=x-{name}><p>{text} {text}</p></div>", {}) == text
    assert html.extract(f"<div id=c><p>{text}</p></div><div class=sidebar><article>a teaser</article></div>", {}) == text


def test_html_names_inside_article():
    """Anchors and parts of names drop nothing from the article; math and xmp are text."""
    long = " ".join(f"word{i}" for i in range(30))
    parts = ['<h2 id="related-work">Related work</h2>', '<h2 id="social-policy">Social policy</h2>',
             f'<section id="search-methods"><h3>Search</h3><p>{long}</p></section>',
             '<p id="reply-of-the-court">The reply</p>', '<div class="section" id="advertising"><p>On adverts</p></div>',
             '<div class="has-sidebar"><p>wide</p></div>',
             "<p>so <math><semantics><mi>x</mi><mo>=</mo><mn>1</mn><annotation>TeX</annotation></semantics></math> holds</p>",
             "<xmp><b>as it is</b> &amp;</xmp>"]
    want = ["Related work", "Social policy", f"Search {long}", "The reply", "On adverts", "wide", "so x=1 holds",
            "<b>as it is</b> &amp;"]
    gone = (f'<div class="notice"><p>{long}</p></div>'      # notices go, whatever their length
            '<div class="ad">BUY</div><div class="advert-box">BUY</div><section id="comments"><p>first</p></section>'
            '<div class="share-buttons"><a href=x>Post</a><a href=y>Mail</a></div><p>end <a class=reply>Reply</a></p>')
    assert html.extract(f"<article><p>{long}</p>{''.join(parts)}{gone}</article>", {}) == " ".join([long, *want, "end"])
    for part, text in zip(parts, want):
        assert html.extract(f"<main><p>{long}</p>{part}<p>{long}</p></main>", {}) == f"{long} {text} {long}"
    # without an article too: ids of headings and paragraphs
    assert html.extract(f"<div><p>{long}</p>{parts[0]}{parts[3]}<p>{long}</p></div>", {}) == f"{long} {want[0]} {want[3]} {long}"


def test_html_sections_without_article():
    """Sections around long furniture are one text; what is beyond the page's footer is not."""
    def words(n, name):
        return " ".join(f"{name}{i}" for i in range(n))

    a, b, ad = words(20, "a"), words(60, "b"), words(300, "ad")
    for gap in (f"<div class=ad>{ad}</div>", f"<nav>{ad}</nav><div class=ad>{ad}</div>", f"<aside><footer>{ad}</footer></aside>"):
        first, last = f"<section><p>{a}</p></section>", f"<section><p>{b}</p></section>"
        for inner in (f"<h1>The title here</h1>{first}{gap}{last}", f"<h1>The title here</h1><div>{first}</div>{gap}<div>{last}{gap}</div>"):
            for page in ("<div id=content>%s</div>", "<body>%s</body>", "<table><tr><td>%s</table>",
                         "<div>Tag line of the site</div><header>x</header><div id=content>%s</div><footer>y</footer><div>All rights reserved here</div>"):
                assert html.extract(page % inner, {}) == f"The title here {a} {b}", page % inner
        assert html.extract(f"<div id=content>{last}{gap}{first}{gap}{last}</div>", {}) == f"{b} {a} {b}"


def test_block_pairs(spark):
    """All pairs within the blocks' bound, from surviving pairs of pivots; no list of all blocks."""
    r = random.Random(2)
    rows = [(d * 100 + p * 10 + k, d, p, [p % 4 + r.random() / 9 for _ in range(d)], r.random() / 5)
            for d in (2, 3) for p in range(6) for k in range(5)]
    meta = spark.createDataFrame(rows, "block long, dims int, pivot int, centre array<double>, far double")
    pairs = covertree.block_pairs(meta, 0.3)
    want = sorted((a, b) for a, d, _, x, s in rows for b, e, _, y, t in rows if d == e and a <= b and math.dist(x, y) <= s + t + 0.3)
    assert sorted((p.a, p.b) for p in pairs.collect()) == want
    assert "collect_list" not in pairs._jdf.queryExecution().toString()


def test_best_run():
    r = random.Random(1)
    for _ in range(200):
        s = [r.choice([-3, -1, 0, 1, 2]) for _ in range(r.randint(0, 15))]
        best = max([(sum(s[i:j])) for i in range(len(s)) for j in range(i + 1, len(s) + 1)], default=0)
        i, j = html.best_run(s)
        assert sum(s[i:j]) == max(best, 0)
