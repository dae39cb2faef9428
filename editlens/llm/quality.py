"""Quality classifier from positive and unlabelled texts.

Trusted positives are training rows labelled good; the unlabelled sample is the web text of
training rows without any label. Bad labels teach nothing. With class prior ``pi`` and logistic
loss ``l`` the model minimises the non-negative risk

    pi E_P[l(f)] + max(0, E_U[l(-f)] - pi E_P[l(-f)]) + ridge

by damped Newton steps; where the estimate of the negatives' risk falls below zero, a step
raises that estimate again instead. The prior comes from a first classifier of positives against
unlabelled texts: the least ratio, over its thresholds, of the unlabelled share above to the
positive share above, each widened by its sampling error (best bin estimation).

``f`` is additive: every feature of a text (lengths, character classes, repetition of words and
lines, compressibility) goes through a piecewise linear curve between the corpus's quantiles.

Distribution: texts are read once, by a map that writes a few dozen numbers a text. Quantiles,
histograms and every Newton step are aggregations over all those rows; a task sends one
partial gradient and Hessian, whose size depends on the features alone.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editlens.llm.langid import held_out
from editlens.llm.reduce import fold, mark
from editlens.llm.scratch import Scratch

THRESHOLD = 0.7          # predicted good from this score on
KNOTS = 8                # quantiles a feature's curve bends at
RIDGE = 1e-3            # plus one over the number of positives
STEPS = 12               # Newton steps at most
TOLERANCE = 1e-5
SPLIT_FROM = 10          # rows of each kind in each half
BINS = 1000              # of the first classifier's scores
CONFIDENCE = 0.1
CHUNK = 1 << 20
UNKNOWN = 0.5            # score where there is nothing to learn from

CLASSES = ("lower", "upper", "digit", "space", "newline", "stop", "mark", "other")
FEATURES = ("chars", "words", *CLASSES, "word_length", "long_words", "types", "pairs", "twins", "top_word", "top_five",
            "word_ends", "shouted", "lines", "line_types", "line_length", "line_ends", "packed")
POSITIVE, UNLABELLED, OTHER = 1, 0, -1
SUMS = "n array<double>, v array<double>, h array<double>"


# ------------------------------------------------------------------ features

@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of every code point, an index into CLASSES."""
    out = np.full(0x110000, CLASSES.index("other"), np.uint8)
    for i in range(0x30000):                               # letters beyond have no case and stay "other"
        c = chr(i)
        kind = ("newline" if c == "\n" else "space" if c.isspace() else "upper" if c.isupper() else
                "lower" if c.isalpha() else "digit" if c.isdigit() else "stop" if c in ".,;:?'\"-()" else
                "mark" if i < 0x80 else "other")
        out[i] = CLASSES.index(kind)
    return out


def features(text: str | None) -> list[float]:
    """Numbers that describe a whole text; a null text counts as the empty one."""
    t = text or ""
    n, kinds, size, pressed = len(t), np.zeros(len(CLASSES), np.int64), 0, 0
    press = zlib.compressobj(1)
    for at in range(0, n, CHUNK):
        part = t[at:at + CHUNK]
        kinds += np.bincount(_classes()[np.frombuffer(part.encode("utf-32-le", "replace"), np.uint32)],
                             minlength=len(CLASSES))
        raw = part.encode("utf-8", "replace")
        size += len(raw)
        pressed += len(press.compress(raw))
    pressed += len(press.flush())
    words, lines = t.split(), t.split("\n")
    many, seen = max(len(words), 1), Counter(words)
    top = [c for _, c in seen.most_common(5)]
    full = [line for line in lines if line.strip()]
    rows = max(len(full), 1)
    return [np.log1p(n), np.log1p(len(words)), *(kinds / max(n, 1)),
            sum(map(len, words)) / many, sum(len(w) > 12 for w in words) / many,
            len(seen) / many, len(set(zip(words, words[1:]))) / max(len(words) - 1, 1),
            sum(map(eq, words, words[1:])) / many, (top[0] if top else 0) / many, sum(top) / many,
            sum(w[-1].isalnum() for w in words) / many, sum(map(str.isupper, words)) / many,
            np.log1p(len(full)), len(set(full)) / rows, np.log1p(sum(map(len, full)) / rows),
            sum(line.rstrip().endswith((".", "!", "?")) for line in full) / rows, pressed / max(size, 1)]


def describe(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, f) of every row; the only pass over the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = [features(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(f, pa.list_(pa.float32()))],
                                             ["doc_id", "held_out", "f"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, f array<float>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, len(FEATURES))


def knots(rows: DataFrame) -> list[list[float]]:
    """Distinct quantiles of every feature, over all rows."""
    at = [i / (KNOTS - 1) for i in range(KNOTS)]
    got = rows.agg(*[F.percentile_approx(F.get("f", F.lit(i)), at, 10_000).alias(f"q{i}") for i in range(len(FEATURES))])
    return [sorted({float(v) for v in q or []}) for q in got.first()]


def basis(x: np.ndarray, grid: list[list[float]]) -> np.ndarray:
    """A constant, and for every feature the weights of its knots but the first (linear
    between knots, constant outside)."""
    out = [np.ones((len(x), 1))]
    for j, at in enumerate(grid):
        if len(at) < 2:
            continue
        at = np.array(at)
        v = np.clip(x[:, j], at[0], at[-1])
        i = np.clip(np.searchsorted(at, v, "right") - 1, 0, len(at) - 2)
        share = (v - at[i]) / (at[i + 1] - at[i])
        hat = np.zeros((len(x), len(at)))
        rows = np.arange(len(x))
        hat[rows, i] = 1 - share
        hat[rows, i + 1] = share
        out.append(hat[:, 1:])
    return np.hstack(out)


def _width(grid: list[list[float]]) -> int:
    return 1 + sum(max(len(g) - 1, 0) for g in grid)


# ------------------------------------------------------------------ risk

def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return np.exp(-_softplus(-z))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for b in batches:
        for i in range(b.num_rows):
            part = [c[i].values.to_numpy() for c in b.columns]
            total = part if total is None else [s + p for s, p in zip(total, part)]
    if total is not None:
        yield _row(total)


def _row(parts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([np.ravel(p)], pa.list_(pa.float64())) for p in parts], ["n", "v", "h"])


@dataclass
class Moments:
    """Means over positives (p) and unlabelled (u): losses of being called good (plus)
    or bad (minus), gradients, and the weighted Hessian."""
    plus_p: float
    minus_p: float
    minus_u: float
    x_p: np.ndarray
    s_p: np.ndarray          # sigmoid(f) x
    s_u: np.ndarray
    hessian: np.ndarray


def moments(rows: DataFrame, grid, w: np.ndarray, n_p: int, n_u: int, share_p: float, share_u: float) -> Moments:
    """One pass over (role, f); the Hessian weighs positives by ``share_p``, unlabelled by ``share_u``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v, h = np.zeros(3), np.zeros((3, len(w))), np.zeros((len(w), len(w)))
        for b in batches:
            x, p = basis(_matrix(b.column(1)), grid), b.column(0).to_numpy(zero_copy_only=False) == POSITIVE
            f = x @ w
            s = _sigmoid(f)
            n += [_softplus(-f[p]).sum() / n_p, _softplus(f[p]).sum() / n_p, _softplus(f[~p]).sum() / n_u]
            v += [x[p].sum(0) / n_p, s[p] @ x[p] / n_p, s[~p] @ x[~p] / n_u]
            h += (x * (s * (1 - s) * np.where(p, share_p / n_p, share_u / n_u))[:, None]).T @ x
        yield _row([n, v, h])

    row = fold(rows.select("role", "f").mapInArrow(run, SUMS), _merge, SUMS).collect()[0]
    v = np.array(row.v).reshape(3, -1)
    return Moments(*row.n, *v, np.array(row.h).reshape(len(w), -1))


def _minimise(start: np.ndarray, visit, steps: int = STEPS) -> np.ndarray:
    """Damped Newton. ``visit(w)`` gives (objective, direction); a step that does not lower the
    objective is halved."""
    best = w = start
    value, step = visit(w)
    rate = 1.0
    for _ in range(steps):
        w = best + rate * step
        got, ahead = visit(w)
        if got < value:
            gain, best, value, step, rate = value - got, w, got, ahead, min(1.0, 2 * rate)
            if gain < TOLERANCE:
                break
        else:
            rate /= 4
            if rate < 1e-3:
                break
    return best


def _solve(h: np.ndarray, g: np.ndarray, w: np.ndarray, ridge: float) -> np.ndarray:
    keep = np.full(len(w), ridge)
    keep[0] = 1e-9                                         # the constant is free
    return -np.linalg.solve(h + np.diag(keep), g + keep * w)


def separate(rows: DataFrame, grid, n_p: int, n_u: int, width: int, ridge: float) -> np.ndarray:
    """Logistic regression of positives against unlabelled rows, both weighing half."""
    def visit(w):
        m = moments(rows, grid, w, n_p, n_u, 0.5, 0.5)
        value = (m.plus_p + m.minus_u + ridge * w[1:] @ w[1:]) / 2
        return value, _solve(m.hessian, (m.s_p - m.x_p + m.s_u) / 2, w, ridge)

    return _minimise(np.zeros(width), visit, 6)


def class_prior(rows: DataFrame, grid, ridge: float) -> float:
    """Share of good texts among the unlabelled ones, by best bin estimation. One half of the rows
    (by a hash of their features, so that copies stay together) separates positives from
    unlabelled texts, the other half is counted; with too few rows for that, all do both."""
    grid = [[g[0], g[len(g) // 2], g[-1]] if len(g) > 3 else g for g in grid]      # few bends separate well enough
    width = _width(grid)
    rows = rows.withColumn("half", F.pmod(F.xxhash64("f"), F.lit(2)))
    size = {(r.half, r.role): r["count"] for r in rows.groupBy("half", "role").count().collect()}
    halves = [[size.get((h, role), 0) for role in (POSITIVE, UNLABELLED)] for h in (0, 1)]
    if min(map(min, halves)) >= SPLIT_FROM:
        fitted, counted = rows.where("half = 0"), rows.where("half = 1")
        (fit_p, fit_u), (n_p, n_u) = halves
    else:
        fitted = counted = rows
        fit_p, fit_u = n_p, n_u = [a + b for a, b in zip(*halves)]
    w = separate(fitted, grid, fit_p, fit_u, width, ridge)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BINS), np.int64)
        for b in batches:
            s = _sigmoid(basis(_matrix(b.column(1)), grid) @ w)
            at = np.minimum((s * BINS).astype(int), BINS - 1)
            p = b.column(0).to_numpy(zero_copy_only=False) == POSITIVE
            counts += [np.bincount(at[~p], minlength=BINS), np.bincount(at[p], minlength=BINS)]
        role, bin_ = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(role), pa.array(bin_), pa.array(counts[role, bin_])],
                                         ["role", "bin", "n"])

    got = (counted.select("role", "f").mapInArrow(run, "role long, bin long, n long")
           .groupBy("role", "bin").agg(F.sum("n").alias("n")).collect())          # 2 * BINS rows at most
    counts = np.zeros((2, BINS))
    for r in got:
        counts[r.role, r.bin] = r.n
    above_u, above_p = (np.cumsum(c[::-1]) / n for c, n in zip(counts, (n_u, n_p)))
    error = np.sqrt(np.log(4 / CONFIDENCE) / 2) * (n_u ** -0.5 + n_p ** -0.5)
    usable = above_p > 0
    bound = np.where(usable, (above_u + error) / np.where(usable, above_p, 1), np.inf)
    at = int(np.argmin(bound))
    return float(np.clip(above_u[at] / above_p[at], 0.01, 0.99))


@dataclass
class Model:
    grid: list[list[float]]
    weights: np.ndarray
    prior: float


def non_negative(rows: DataFrame, grid, prior: float, n_p: int, n_u: int, width: int, ridge: float) -> np.ndarray:
    """Minimises the non-negative risk."""
    def visit(w):
        m = moments(rows, grid, w, n_p, n_u, 0.0, 1.0)
        negatives = m.minus_u - prior * m.minus_p
        value = prior * m.plus_p + max(0.0, negatives) + ridge / 2 * w[1:] @ w[1:]
        if negatives >= 0:                                 # the P terms add up to -prior E_P[f]
            return value, _solve(m.hessian, m.s_u - prior * m.x_p, w, ridge)
        return value, -_solve(m.hessian, m.s_u - prior * m.s_p, 0 * w, ridge)

    start = np.zeros(width)
    start[0] = np.log(prior / (1 - prior))
    return _minimise(start, visit)


def train(rows: DataFrame, ridge: float = RIDGE) -> Model | None:
    """From described rows with a role; None without positives or without unlabelled rows."""
    counts = {r.role: r["count"] for r in rows.groupBy("role").count().collect()}
    n_p, n_u = counts.get(POSITIVE, 0), counts.get(UNLABELLED, 0)
    if not n_p or not n_u:
        return None
    rows = rows.where(F.col("role") != OTHER)
    grid = knots(rows)
    ridge += 1 / n_p
    prior = class_prior(rows, grid, ridge)
    return Model(grid, non_negative(rows, grid, prior, n_p, n_u, _width(grid), ridge), prior)


def score(docs: DataFrame, labels: DataFrame, ridge: float = RIDGE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``, whole texts.

    Needs doc_id and text, and doc_id and quality of ``labels``; other columns are
    ignored whatever their names. Held-out rows teach nothing. A null text is scored as the empty one.
    Rows that repeat are scored alike and count as often as they stand there; a
    null id is never labelled and never held out. A document is a positive if any of its
    label rows says 1. If every training row is labelled, all of them serve as unlabelled. Without any positive there
    is nothing to learn: every score is 0.5, predicted 0. No documents give no rows.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    rows = scratch.table(describe(docs), "described")
    rows = mark(rows, labels, {"good": F.col("quality") == 1}, F.xxhash64("f"))
    role = (F.when(F.col("held_out"), OTHER).when(F.col("good"), POSITIVE).when(F.col("good").isNull(), UNLABELLED)
            .otherwise(OTHER).cast("int"))
    rows = scratch.table(rows.select("doc_id", "held_out", role.alias("role"), "f"), "rows")
    known = rows
    if not rows.where(F.col("role") == UNLABELLED).head(1):
        whole = rows.where(~F.col("held_out"))
        known = whole.where(F.col("role") == POSITIVE).unionByName(whole.withColumn("role", F.lit(UNLABELLED)))
    model = train(known, ridge)
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("score"), F.lit(0).alias("predicted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = _sigmoid(basis(_matrix(b.column(2)), model.grid) @ model.weights)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s)], ["doc_id", "held_out", "score"])

    out = rows.select("doc_id", "held_out", "f").mapInArrow(run, "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
