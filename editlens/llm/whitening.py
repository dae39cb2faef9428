"""Embedding whitening from the exact characteristic polynomial of the scatter.

Entries become integers, so the scatter ``M = n * sum(y y') - S S'`` (n squared times the
covariance) is an integer matrix, summed exactly. Its characteristic polynomial is found
modulo many primes (Hessenberg form, then a recurrence) and put together by Chinese
remaindering. All its roots are real, so the sign changes of the polynomial shifted
by ``a`` count the roots above ``a`` exactly (Descartes), multiple ones included; bisection on
a grid of 2**-128 isolates them. Each root's components come from inverse iteration on
``M - root`` in 90-digit arithmetic: its null space up to the root's last bits.

Distribution: vectors are read by tasks that each send one partial scatter on; partials are
added in two levels. Primes and roots are rows of small DataFrames, worked on in parallel.
The driver holds the scatter and the polynomial alone, whose size depends on the dimension,
not on the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editlens.llm.reduce import fold
from editlens.llm.scratch import Scratch

SCALE = 64               # an entry c counts as floor(64 c) + OFFSET
OFFSET = 1_000_000       # shifts every entry alike: the scatter does not see it
COMPONENTS = 32
GRID_BITS = 128          # roots are isolated to multiples of 2**-GRID_BITS
DIGITS = 90
LIMB = 20                # bits; products of two limbs over CHUNK rows are exact in a double
CHUNK = 4096
INT_BYTES = 32           # of a stored partial sum
PARTIAL = "n long, sums binary, gram binary"
SPREAD = "n long, mean array<double>, m2 array<double>"


# ------------------------------------------------------------------ exact sums

def finite(vec: Column) -> Column:
    """Vectors without null or non-finite entries, all of which fit a long when scaled."""
    return vec.isNotNull() & (F.size(vec) > 0) & F.forall(
        vec, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < float(1 << 56)), F.lit(False)))


def matrix(values: pa.ListArray, dim: int) -> np.ndarray:
    """(rows, dim) of floor(64 c) as doubles (exact)."""
    return np.floor(SCALE * values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(-1, dim)


def gram(y: np.ndarray) -> np.ndarray:
    """``y' y`` as Python integers, exact for any integers."""
    dim = y.shape[1]
    out = np.zeros((dim, dim), dtype=object)
    for at in range(0, len(y), CHUNK):
        part = y[at:at + CHUNK]
        top = float(np.abs(part).max(initial=0.0))
        if top * top * len(part) < 2.0 ** 53:
            out += (part.T @ part).astype(np.int64).astype(object)
            continue
        whole, limbs = part.astype(np.int64), []
        while np.any(whole):                               # signed limbs, lowest first
            low = ((whole + (1 << LIMB - 1)) & ((1 << LIMB) - 1)) - (1 << LIMB - 1)
            limbs.append(low.astype(np.float64))
            whole = (whole - low) >> LIMB
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                out += (a.T @ b).astype(np.int64).astype(object) * (1 << LIMB * (i + j))
    return out


def _pack(ints) -> bytes:
    return b"".join(int(v).to_bytes(INT_BYTES, "little", signed=True) for v in ints)


def _unpack(raw: bytes) -> np.ndarray:
    return np.array([int.from_bytes(raw[i:i + INT_BYTES], "little", signed=True)
                     for i in range(0, len(raw), INT_BYTES)], dtype=object)


def _partial(n: int, sums: np.ndarray, upper: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([n], pa.int64()), pa.array([_pack(sums)], pa.binary()), pa.array([_pack(upper)], pa.binary())],
        ["n", "sums", "gram"])


@dataclass
class Scatter:
    n: int
    sums: list[int]              # of floor(64 c), by dimension
    matrix: list[list[int]]      # n * sum(y y') - S S'


def scatter(vectors: DataFrame, dim: int) -> Scatter:
    upper = np.triu_indices(dim)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dim, dtype=object), np.zeros((dim, dim), dtype=object)
        for b in batches:
            y = matrix(b.column(0), dim)
            n += len(y)
            for at in range(0, len(y), 256):               # 256 entries below 2**44: an exact double
                part = y[at:at + 256]
                small = np.abs(part).max(initial=0.0) < 2.0 ** 44
                sums = sums + (part.sum(0).astype(np.int64).astype(object) if small
                               else part.astype(np.int64).astype(object).sum(0))
            products = products + gram(y)
        if n:
            yield _partial(n, sums, products[upper])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, 0, 0
        for b in batches:
            for i in range(b.num_rows):
                n += b.column(0)[i].as_py()
                sums = sums + _unpack(b.column(1)[i].as_py())
                products = products + _unpack(b.column(2)[i].as_py())
        if n:
            yield _partial(n, sums, products)

    row = fold(vectors.mapInArrow(collect, PARTIAL), merge, PARTIAL).collect()[0]
    sums, flat = _unpack(bytes(row.sums)), _unpack(bytes(row.gram))
    full = np.zeros((dim, dim), dtype=object)
    full[upper] = flat
    full = full + np.triu(full, 1).T
    m = row.n * full - np.outer(sums, sums)
    return Scatter(row.n, [int(v) for v in sums], [[int(v) for v in line] for line in m])


# ------------------------------------------------------------------ polynomial

def primes_below(top: int) -> Iterator[int]:
    """Odd primes below ``top`` (at most 2**31), largest first."""
    for p in range(top - 1 - top % 2, 2, -2):
        d, r = p - 1, 0
        while d % 2 == 0:
            d, r = d // 2, r + 1
        for base in (2, 3, 5, 7):                          # decides every number below 3.2e9
            x = pow(base, d, p)
            if base % p == 0 or x in (1, p - 1):
                continue
            if not any((x := x * x % p) == p - 1 for _ in range(r - 1)):
                break
        else:
            yield p


def polynomial_mod(m: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(x - m) modulo a prime below 2**31, highest power first."""
    a = np.array([[v % p for v in line] for line in m], dtype=np.int64)
    d = len(a)
    for k in range(d - 2):                                 # similarity to Hessenberg form
        at = np.nonzero(a[k + 1:, k])[0]
        if not len(at):
            continue
        i = k + 1 + int(at[0])
        if i != k + 1:
            a[[k + 1, i]] = a[[i, k + 1]]
            a[:, [k + 1, i]] = a[:, [i, k + 1]]
        u = a[k + 2:, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2:] = (a[k + 2:] - u[:, None] * a[k + 1] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2:] * u % p).sum(1)) % p
    poly = np.zeros((d + 1, d + 1), dtype=np.int64)        # row k: polynomial of the leading k x k block
    poly[0, 0] = 1                                         # lowest power first
    below = np.ones(0, dtype=np.int64)                     # products of sub-diagonal entries down to row k
    for k in range(d):
        step = np.zeros(d + 1, dtype=np.int64)
        step[1:] = poly[k, :-1]
        step = (step - int(a[k, k]) * poly[k]) % p
        if k:
            below = np.append(below, 1) * int(a[k, k - 1]) % p
            weight = below * a[:k, k] % p
            step = (step - (weight[:, None] * poly[:k] % p).sum(0)) % p
        poly[k + 1] = step
    return [int(v) for v in poly[d][::-1]]


def remainders(spark: SparkSession, m: list[list[int]], primes: list[int]) -> list[tuple[int, list[int]]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ps = b.column(0).to_pylist()
            if ps:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ps, pa.int64()), pa.array([polynomial_mod(m, p) for p in ps], pa.list_(pa.int64()))],
                    ["p", "c"])

    tasks = min(len(primes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks).mapInArrow(run, "p long, c array<long>")
    return [(r.p, list(r.c)) for r in rows.collect()]


def characteristic_polynomial(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """Exact coefficients of det(x - m), highest power first, for a positive semidefinite
    integer matrix. Its k-th coefficient is (-1)**k times the k-th elementary symmetric
    function of roots >= 0, so its size is at most (1 + trace / d)**d."""
    d, trace = len(m), sum(m[i][i] for i in range(len(m)))
    bound, primes, product = (2 + trace // d) ** d, [], 1
    for p in primes_below(1 << 31):
        primes.append(p)
        product *= p
        if product > bound:
            break
    size = [0] * (d + 1)
    for p, c in remainders(spark, m, primes):
        rest = product // p
        share = rest * pow(rest, -1, p)
        for k in range(d + 1):
            size[k] += (c[k] if k % 2 == 0 else -c[k]) % p * share
    return [(s % product) * (1 if k % 2 == 0 else -1) for k, s in enumerate(size)]


# ------------------------------------------------------------------ roots

def roots_above(poly: list[int], a: int) -> int:
    """Roots above ``a`` of a polynomial with real roots only, with multiplicity: sign changes
    of the polynomial in x + a."""
    c = list(poly)
    for stop in range(len(c), 1, -1):
        for i in range(1, stop):
            c[i] += a * c[i - 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _sign(poly: list[int], at: int) -> int:
    v = 0
    for c in poly:
        v = v * at + c
    return (v > 0) - (v < 0)


def _refine(poly: list[int], lo: int, hi: int) -> int:
    """The one root in (lo, hi], to the grid."""
    above = _sign(poly, hi)
    if above == 0:
        return hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        s = _sign(poly, mid)
        if s == 0:
            return mid
        lo, hi = (lo, mid) if s == above else (mid, hi)
    return hi


def top_roots(poly: list[int], count: int) -> list[tuple[int, int]]:
    """(root * 2**GRID_BITS, multiplicity) of the largest positive roots, falling, until at
    least ``count`` are covered. Roots that agree on the grid count as one multiple root."""
    grid = [c << GRID_BITS * k for k, c in enumerate(poly)]
    hi = (-poly[1] + 1) << GRID_BITS                       # the trace bounds every root
    todo, out, got = [(0, hi, roots_above(grid, 0), 0)], [], 0
    while todo and got < count:                            # rightmost interval last
        lo, hi, above_lo, above_hi = todo.pop()
        m = above_lo - above_hi
        if m == 0:
            continue
        if m == 1 or hi - lo == 1:
            out.append((_refine(grid, lo, hi) if m == 1 else hi, m))
            got += m
            continue
        mid = (lo + hi) // 2
        above = roots_above(grid, mid)
        todo += [(lo, mid, above_lo, above), (mid, hi, above, above_hi)]
    return out


# ------------------------------------------------------------------ components

def null_space(m: list[list[int]], root: int, count: int) -> list[list[float]]:
    """``count`` orthonormal vectors v with m v = root / 2**GRID_BITS v, by inverse iteration."""
    d = len(m)
    with localcontext() as ctx:
        ctx.prec = DIGITS
        scale = Decimal(sum(m[i][i] for i in range(d)))
        tiny = Decimal(10) ** (20 - DIGITS)
        a = np.array([[Decimal(v) / scale for v in line] for line in m], dtype=object)
        shift = Decimal(root) / Decimal(1 << GRID_BITS) / scale
        for i in range(d):
            a[i, i] -= shift
        order = list(range(d))
        for k in range(d):                                 # LU with row pivots
            p = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
            if p != k:
                a[[k, p]] = a[[p, k]]
                order[k], order[p] = order[p], order[k]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            if k + 1 < d:
                a[k + 1:, k] /= a[k, k]
                a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k, k + 1:])
        found: list[np.ndarray] = []
        for c in range(count):
            seed = np.random.default_rng(c).integers(1, 1 << 20, d)
            v = np.array([Decimal(int(s)) for s in seed], dtype=object)
            for _ in range(4):
                v = v[order].copy()
                for i in range(1, d):
                    v[i] -= a[i, :i] @ v[:i]
                for i in range(d - 1, -1, -1):
                    v[i] = (v[i] - (a[i, i + 1:] @ v[i + 1:] if i + 1 < d else 0)) / a[i, i]
                for _ in range(2):
                    for u in found:
                        v = v - u * (u @ v)
                    v = v / (v @ v).sqrt()
            found.append(v)
        out = [[float(x) for x in v] for v in found]
    return [[-x for x in v] if v[int(np.argmax(np.abs(v)))] < 0 else v for v in out]


def components(spark: SparkSession, m: list[list[int]], roots: list[tuple[int, int]]) -> list[list[float]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, root, count in zip(*(b.column(i).to_pylist() for i in range(3))):
                vs = null_space(m, int(root), count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at] * count, pa.int32()), pa.array(range(count), pa.int32()),
                     pa.array(vs, pa.list_(pa.float64()))], ["at", "i", "v"])

    rows = spark.createDataFrame([(i, str(r), c) for i, (r, c) in enumerate(roots)], "at int, root string, many int")
    got = rows.repartition(len(roots)).mapInArrow(run, "at int, i int, v array<double>").collect()
    return [list(r.v) for r in sorted(got, key=lambda r: (r.at, r.i))]


# ------------------------------------------------------------------ whitening

@dataclass
class Whitener:
    """What turns a vector into its whitened one."""
    n: int
    sums: list[int]
    axes: np.ndarray             # (dim, components)
    values: list[float]          # eigenvalues of the covariance
    explained: list[float]


def fit(vectors: DataFrame, dim: int, count: int = COMPONENTS) -> Whitener:
    """``vectors``: one column of finite vectors of ``dim`` entries. Components of eigenvalue
    zero are left out: nothing can be scaled to unit variance there."""
    spark, s = vectors.sparkSession, scatter(vectors, dim)
    trace = sum(s.matrix[i][i] for i in range(dim))
    if not trace:
        return Whitener(s.n, s.sums, np.zeros((dim, 0)), [], [])
    roots = top_roots(characteristic_polynomial(spark, s.matrix), min(count, dim))
    axes = components(spark, s.matrix, roots)[:count]
    exact = [Fraction(r, 1 << GRID_BITS) for r, m in roots for _ in range(m)][:len(axes)]
    return Whitener(s.n, s.sums, np.array(axes).T, [float(r / s.n ** 2) for r in exact],
                    [float(r / trace) for r in exact])


def deviations(y: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """sum((n x - S)**2) by row, exact; None where it does not fit a long."""
    reach = n * int(np.abs(y).max(initial=0.0)) + max(abs(v) for v in sums)
    if reach * reach * y.shape[1] < 1 << 63:
        d = n * y.astype(np.int64) - np.array(sums, dtype=np.int64)
        return (d * d).sum(1).tolist()
    d = n * y.astype(np.int64).astype(object) - np.array(sums, dtype=object)
    return [v if v < 1 << 63 else None for v in (int(x) for x in (d * d).sum(1))]


def project(vectors: DataFrame, w: Whitener, dim: int) -> DataFrame:
    """(id, vec) -> (id, deviation, whitened array)."""
    mean = np.array([float(Fraction(v, w.n)) for v in w.sums])
    axes = w.axes / np.sqrt(np.array(w.values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            y = matrix(b.column(1), dim)
            z = (y - mean) @ axes
            at = pa.array(np.arange(0, z.size + 1, z.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(deviations(y, w.n, w.sums), pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(z.ravel()))], ["id", "deviation", "z"])

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id {kind}, deviation long, z array<double>")


def identity_error(rows: DataFrame, count: int) -> float:
    """Largest absolute entry of cov(z) - I, each part centred on its own mean before
    multiplying and parts merged with the means' difference."""
    def merged(parts):
        n, mean, m2 = 0, np.zeros(count), np.zeros((count, count))
        for k, mu, s in parts:
            gap = mu - mean
            m2 += s + np.outer(gap, gap) * (n * k / (n + k))
            n, mean = n + k, mean + gap * (k / (n + k))
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), pa.array([mean.tolist()], pa.list_(pa.float64())),
                 pa.array([m2.ravel().tolist()], pa.list_(pa.float64()))], ["n", "mean", "m2"])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for b in batches:
                z = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, count)
                if len(z):
                    mu = z.mean(0)
                    yield len(z), mu, (z - mu).T @ (z - mu)
        return merged(parts())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return merged((b.column(0)[i].as_py(), np.array(b.column(1)[i].as_py()),
                       np.array(b.column(2)[i].as_py()).reshape(count, count))
                      for b in batches for i in range(b.num_rows))

    row = fold(rows.select("z").mapInArrow(collect, SPREAD), merge, SPREAD).collect()[0]
    return float(np.abs(np.array(row.m2).reshape(count, count) / row.n - np.eye(count)).max())


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           count: int = COMPONENTS) -> DataFrame:
    """A row per usable vector and component: ``id_col``, component (from 1, by falling
    eigenvalue), n, deviation, whitened, explained, identity_error.

    Null vectors, empty ones and those with null or non-finite entries (or entries of 2**56
    and more, whose integers do not fit a long) are left out of fit and result. Where
    lengths differ, the most frequent one (the longer at a tie) counts, the rest is left out. Repeated
    rows count as often as they stand there; a null id is kept. Equal eigenvalues get an orthonormal
    basis of their space. Components of eigenvalue zero have no whitened value and no
    rows: constant or too few vectors, and an empty table, give fewer or none. ``deviation`` is null
    where it does not fit a long. Other columns are ignored whatever their names.
    """
    spark = embeddings.sparkSession
    vectors = embeddings.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).where(finite(F.col("vec")))
    size = F.size("vec")
    lengths = vectors.groupBy(size.alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    schema = (f"{id_col} {vectors.schema['id'].dataType.simpleString()}, component int, n long, deviation long, "
              "whitened double, explained double, identity_error double")
    if lengths is None:
        return spark.createDataFrame([], schema)
    vectors = vectors.where(size == lengths.dim)
    w = fit(vectors.select("vec"), lengths.dim, count)
    if not w.values:
        return spark.createDataFrame([], schema)
    rows = Scratch(spark, "whitening").table(project(vectors, w, lengths.dim), "rows")
    error = identity_error(rows, len(w.values))
    share = F.array(*[F.lit(v) for v in w.explained])
    out = rows.select("id", "deviation", F.posexplode("z").alias("i", "whitened"))
    return out.select(F.col("id").alias(id_col), (F.col("i") + 1).alias("component"), F.lit(w.n).cast("long").alias("n"),
                      "deviation", "whitened", F.get(share, F.col("i")).alias("explained"),
                      F.lit(error).alias("identity_error"))
