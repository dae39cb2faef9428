"""Plain-Python versions of the operators, for small inputs."""

import hashlib
import math
import re
from itertools import permutations

import numpy as np
import xxhash


def xxh64_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hs) > len(hs))


def component_ids(n, links, ids):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    low = {}
    for i in range(n):
        if ids[i] is not None:
            r = find(i)
            low[r] = min(low.get(r, ids[i]), ids[i])
    return [low.get(find(i)) for i in range(n)]


def simhash_components(rows):
    """rows: (id, text)"""
    fp = [xxh64_fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp)) if bin(fp[i] ^ fp[j]).count("1") <= 2]
    return fp, component_ids(len(fp), links, [i for i, _ in rows])


def bench_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contamination(docs, items):
    """docs: (id, text), items: (id, text) -> [(n_words, n_hit, sorted items)]"""
    windows = {}
    for item, text in items:
        w = bench_words(text)
        for s in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[s:s + 13]), set()).add("" if item is None else str(item))
    sizes = {len(k) for k in windows}
    out = []
    for _, text in docs:
        w = bench_words(text)
        hit, found = set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                got = windows.get(tuple(w[s:s + n]))
                if got:
                    hit |= set(range(s, s + n))
                    found |= got
        out.append((len(w), len(hit), sorted(found)))
    return out


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """sizes: source -> mass"""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, over = share * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in over]
        if not free:
            return {s: float(cap * sizes[s]) for s in order}
        level = (total - sum(cap * sizes[s] for s in over)) / sum(w[s] for s in free)
        new = {s for s in free if level * w[s] > cap * sizes[s]}
        if not new:
            return {s: float(cap * sizes[s]) if s in over else level * w[s] for s in order}
        over |= new


def cosine_links(vectors, least=0.95):
    def fine(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    n = [0] * len(vectors)
    links = []
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if fine(v) else None for v in vectors]
    for i in range(len(vectors)):
        for j in range(i + 1, len(vectors)):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                n[i] += 1
                n[j] += 1
                links.append((i, j))
    return n, links


def substring_dedup(rows, window=13):
    """rows: (id, text) -> [(n_words, kept words)]"""
    words = [(t or "").encode().split() for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words):
        for s in range(len(w) - window + 1) if i is not None else ():
            k = tuple(w[s:s + window])
            first[k] = min(first.get(k, i), i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for s in range(len(w) - window + 1) if i is not None else ():
            if first[tuple(w[s:s + window])] < i:
                gone |= set(range(s, s + window))
        out.append((len(w), [x.decode() for p, x in enumerate(w) if p not in gone]))
    return out


def line_dedup(rows, min_sites):
    """rows: (id, text, site) -> [(n_lines, n_removed, kept)]"""
    sites = {}
    for _, t, s in rows:
        for line in (t or "").split("\n") if t is not None else ():
            if line.strip(" ") and s is not None:
                sites.setdefault(line.strip(" "), set()).add(s)
    bad = {k for k, v in sites.items() if len(v) >= min_sites}
    out = []
    for _, t, _ in rows:
        ls = t.split("\n") if t is not None else []
        keep = [x for x in ls if x.strip(" ") not in bad]
        out.append((len(ls), len(ls) - len(keep), "\n".join(keep) if t is not None else None))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def filter_audit(rows, labels):
    """rows: (doc_id, text, source); labels: (doc_id, quality, toxic). Rows of the audit."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    parts = {}
    for i, t, s in rows:
        t = t or ""
        words = [w.decode() for w in t.encode().split()]
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), "D": any(c in "#$%&*|" for c in t),
                 "E": i is not None and i > first[t]}
        parts.setdefault(s or "", []).append((fails, i in good, i in toxic))
    out = []
    for part, docs in parts.items():
        steps, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(docs)
            for n, f in enumerate(order):
                here = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                shapley[f] += len(here)
                steps.append((part, "".join(order), n + 1, len(left), len(here),
                              sum(d[0][f] for d in docs) - len(here),
                              sum(d[0][f] and sum(d[0].values()) == 1 for d in docs),
                              sum(d[1] for d in here), sum(d[2] for d in here), f))
        out += [s[:-1] + (shapley[s[-1]],) for s in steps]
    return out


def text_ngrams(text, buckets=1 << 14):
    """Hashed 1- to 3-grams of the letters, words set off by one blank; None without a letter."""
    words, word = [], ""
    for c in (text or "").lower():
        if c.isalpha():
            word += c
        elif word:
            words.append(word)
            word = ""
    line = " " + "".join(w + " " for w in words) + word
    if not line.strip():
        return None
    grams, out = {}, {}
    for n in (1, 2, 3):
        for i in range(len(line) - n + 1):
            g = line[i:i + n]
            grams[g] = grams.get(g, 0) + 1
    for g, k in grams.items():
        h = len(g)
        for c in g:
            h = (h + ord(c)) * 0x9E3779B97F4A7C15 % 2 ** 64
            h ^= h >> 29
        out[h % buckets] = out.get(h % buckets, 0) + k
    return out


def languages(train, texts, evidence=40, buckets=1 << 14):
    """(language, score) of each text: one classifier a split of the languages in two (all splits), decoded
    by the sum of logistic losses; ``train`` are (text, language)."""
    counts = {}
    for text, lang in train:
        g = text_ngrams(text, buckets)
        if lang is not None and g is not None:
            mine = counts.setdefault(lang, {})
            for b, k in g.items():
                mine[b] = mine.get(b, 0) + k
    langs = sorted(counts)
    share = {}
    for k in langs:
        total = sum(counts[k].values()) + 0.5 * buckets
        share[k] = [(counts[k].get(b, 0) + 0.5) / total for b in range(buckets)]
    bits = []                                           # (side of each language, weight by bucket, trust)
    for mask in range(1, 2 ** (len(langs) - 1)):
        side = {k: mask >> i & 1 for i, k in enumerate(langs)}
        one = [k for k in langs if side[k]]
        zero = [k for k in langs if not side[k]]
        w = [math.log(sum(share[k][b] for k in one) / len(one)) - math.log(sum(share[k][b] for k in zero) / len(zero))
             for b in range(buckets)]
        mean = {k: sum(x * y for x, y in zip(share[k], w)) for k in langs}
        bits.append((side, w, max(1e-3, min(mean[k] if side[k] else -mean[k] for k in langs))))
    whole = sum(b[2] for b in bits) / len(bits)
    out = []
    for text in texts:
        g = text_ngrams(text, buckets)
        if g is None:
            out.append(("und", 0.0))
            continue
        n = sum(g.values())
        loss = dict.fromkeys(langs, 0.0)
        for side, w, trust in bits:
            margin = sum(k * w[b] for b, k in g.items()) / n * min(n, evidence)
            for k in langs:
                loss[k] += trust / whole * math.log1p(math.exp(-margin if side[k] else margin))
        best = min(langs, key=lambda k: loss[k])
        out.append((best, 1 / sum(math.exp(loss[best] - loss[k]) for k in langs)))
    return out


def check_kd_tree(rows, shards=16, slack=1 / 64):
    """``rows``: (size, crc, shard). Every node of the tree is parted along the dimension its rows spread
    furthest in, all of the left side at or before all of the right one, near its weighted median."""
    points = [((math.log2(s), float(c)), s, k) for s, c, k in rows]
    span = [max(p[0][d] for p in points) - min(p[0][d] for p in points) for d in (0, 1)]
    room = slack * sum(p[1] for p in points) / shards + max(p[1] for p in points)

    def node(part, lo, hi):
        if hi - lo == 1 or not part:
            return
        assert all(lo <= p[2] < hi for p in part)
        mid = lo + (hi - lo) // 2
        ends = [(min(p[0][d] for p in part), max(p[0][d] for p in part)) for d in (0, 1)]
        wide = [(b - a) / s if s else 0.0 for (a, b), s in zip(ends, span)]
        d = 0 if wide[0] >= wide[1] else 1
        left, right = [p for p in part if p[2] < mid], [p for p in part if p[2] >= mid]
        step = (ends[d][1] - ends[d][0]) / ((1 << 24) - 1)      # values are told apart in so many steps
        if left and right:
            assert max(p[0][d] for p in left) <= min(p[0][d] for p in right) + step * 1.0001, (lo, hi, d)
        aim = sum(p[1] for p in part) * (mid - lo) / (hi - lo)
        assert abs(sum(p[1] for p in left) - aim) <= room, (lo, hi)
        node(left, lo, mid)
        node(right, mid, hi)

    node(points, 0, shards)
