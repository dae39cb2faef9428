"""Embedding near-dedup: exact threshold pairs by dual traversal of cover trees.

Vectors are scaled to length 1, where cosine >= c means distance <= t =
sqrt(2 - 2c). The upper levels are distributed: vectors go to the nearest of a
few pivots, and while a node holds more than a block its vectors go to the nearest of
pivots of its own, which cover it within half its radius or are as many as it needs blocks.
Below that every block holds a cover tree with nested levels whose radii halve: each
node of a level lies within that level's radius of its parent, and its real covering
radius is kept.

A pair of nodes is dropped if its centres are further apart than t plus both
covering radii. That bound prunes pairs of pivots, then pairs of packs (the upper nodes of
neighbouring blocks, without their vectors), then pairs of those nodes; only blocks
that hold a pair left over meet, and the dual traversal of their trees goes on below
those pairs, level by level. Pairs of single vectors that are left are compared by
cosine in double precision. A pair whose centres are so close that distance plus both
radii stay within t links whole nodes at once, by their weights.

Equal vectors are one vector with a multiplicity. A task meets two packs or two blocks
at a time; it emits bounded portions of node pairs, then one row per linked vector (its
number of links and its root within the two blocks), never the pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editlens.llm.graph import components
from editlens.llm.ranking import bucket_count, number_in_groups
from editlens.llm.scratch import Scratch

MIN_COSINE = 0.95
BLOCK = 4096                    # vectors in a block at most, about
PIVOT_SAMPLE = 4096             # vectors among which pivots are chosen
MAX_PIVOTS = 512
NODE_SAMPLE = 2048              # vectors of a node among which its own pivots are chosen, about
DEPTH = 6                       # distributed levels below the first; what is larger then is cut by hash
DEAL = 8192                     # vectors of a node that one task sends to its pivots, about
RADII = (1.0, 0.5, 0.25, 0.125)
UPPER = 1                       # level of a block's tree whose nodes are packed
NODE_PAIRS = 1 << 19            # node pairs in a row at most, about
NEAR = ["a", "b", "x", "y", "node", "gain", "own", "key", "root"]
GUARD = 1e-9                    # on distance bounds, far above rounding errors
ROWS = 512


def unit(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, without overflow or underflow."""
    m = m.astype(np.float64)
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


def net(points: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Greedy cover: numbers of the centres, and for each point the place of a
    centre within ``radius``. A point is a centre if no earlier centre covers it."""
    centres: list[int] = []
    owner = np.full(len(points), -1, np.int64)
    for lo in range(0, len(points), ROWS):
        part = points[lo:lo + ROWS]
        if centres:
            d = _distances(part, points[centres])
            near = d.argmin(axis=1)
            owner[lo:lo + ROWS] = np.where(d[np.arange(len(part)), near] <= radius, near, -1)
        own = _distances(part, part)
        for i in np.nonzero(owner[lo:lo + ROWS] < 0)[0]:
            if owner[lo + i] < 0:
                take = np.nonzero((own[i] <= radius) & (owner[lo:lo + ROWS] < 0))[0]
                owner[lo + take] = len(centres)
                owner[lo + i] = len(centres)
                centres.append(lo + i)
    return np.array(centres, np.int64), owner


class Tree:
    """levels[l]: (centre, radius, parent) arrays; the last level has every point
    as a node of radius 0. ``parent`` are places in the level above, sorted."""

    def __init__(self, points: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.points, self.levels = points, levels
        # spans[l]: first place on the last level under each node, and one past its last
        ends = np.arange(len(levels[-1][0]))
        spans = [(ends, ends + 1)]
        for level in range(len(levels) - 1, 0, -1):
            nodes = np.arange(len(levels[level - 1][0]))
            parent, (lo, hi) = levels[level][2], spans[0]
            spans.insert(0, (lo[np.searchsorted(parent, nodes, "left")], hi[np.searchsorted(parent, nodes, "right") - 1]))
        self.spans = spans

    @classmethod
    def build(cls, points: np.ndarray) -> Tree:
        levels = []
        members = [np.arange(len(points))]          # of each node of the level above
        for radius in RADII:
            centre, parent, held = [], [], []
            for p, m in enumerate(members):
                if len(m) == 1:
                    c, owner = np.array([0]), np.array([0])
                else:
                    c, owner = net(points[m], radius)
                order = np.argsort(owner, kind="stable")
                cuts = np.searchsorted(owner[order], np.arange(1, len(c)))
                held += np.split(m[order], cuts)
                centre += m[c].tolist()
                parent += [p] * len(c)
            centre = np.array(centre, np.int64)
            of = np.repeat(np.arange(len(centre)), [len(h) for h in held])
            flat = np.concatenate(held)
            gap = points[flat] - points[centre[of]]
            far = np.zeros(len(centre))
            np.maximum.at(far, of, np.sqrt((gap * gap).sum(axis=1)))
            levels.append((centre, far, np.array(parent, np.int64)))
            members = held
        flat = np.concatenate(members)
        levels.append((flat, np.zeros(len(flat)),
                       np.repeat(np.arange(len(members)), [len(h) for h in members])))
        return cls(points, levels)


def dual(a: Tree, b: Tree, weight_a: np.ndarray, weight_b: np.ndarray, min_cosine: float, same: bool,
         start: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n, u, v) of the points of ``a``, then those of ``b`` unless both are the same tree: for each point the
    weight of the points it links with (cosine >= ``min_cosine``), and links enough to join what is
    connected. ``start`` are the node pairs of level ``UPPER`` to go on from (none: all pairs of the top level).
    Holds a row per point, node pair or pair of single points, never the pairs of whole nodes."""
    t = np.sqrt(max(2.0 - 2.0 * min_cosine, 0.0))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    last = len(a.levels) - 1
    shift = 0 if same else len(a.points)
    trees = ((a, weight_a), (b, weight_b))
    sums = [np.append(0, np.cumsum(w[x.levels[-1][0]])) for x, w in trees]      # weights before a place
    gain = [np.zeros(len(x.points) + 1, np.int64) for x, _ in trees]            # steps of what whole nodes add
    joined = [np.zeros(len(x.points) + 1, np.int64) for x, _ in trees]          # steps: place and next are connected
    inside = np.zeros(len(a.points) + 1, np.int64)                              # steps: place lies in a node linked with itself

    def include(level: int, x: np.ndarray, y: np.ndarray) -> None:
        """All points under x link with all under y."""
        (xl, xr), (yl, yr) = [(c.spans[level][0][k], c.spans[level][1][k]) for c, k in ((a, x), (b, y))]
        for side, lo, hi, total in ((0, xl, xr, sums[1][yr] - sums[1][yl]), (1, yl, yr, sums[0][xr] - sums[0][xl])):
            own = (x == y) if same else np.zeros(len(x), bool)
            if side and same:                   # a node with itself counts once
                lo, hi, total, own = lo[~own], hi[~own], total[~own], own[~own]
            np.add.at(gain[side], lo, total)
            np.add.at(gain[side], hi, -total)
            np.add.at(joined[side], lo, 1)
            np.add.at(joined[side], hi - 1, -1)
            np.add.at(inside, lo[own], 1)
            np.add.at(inside, hi[own], -1)
        whole.append((a.levels[-1][0][xl], b.levels[-1][0][yl] + shift))

    whole: list[tuple[np.ndarray, np.ndarray]] = []

    def close(level: int, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ca, ra, _ = a.levels[level]
        cb, rb, _ = b.levels[level]
        gap = a.points[ca[x]] - b.points[cb[y]]
        d = np.sqrt((gap * gap).sum(axis=1))
        reach = ra[x] + rb[y] + GUARD
        keep = d <= t + reach
        if level < last:
            all_of = d + reach <= t
            include(level, x[all_of], y[all_of])
            keep &= ~all_of
        return x[keep], y[keep]

    def children(parents: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.searchsorted(parents, nodes, "left"), np.searchsorted(parents, nodes, "right")

    def descend(level: int, x: np.ndarray, y: np.ndarray) -> None:
        """x, y: pairs of nodes of ``level`` that passed the bound."""
        if not len(x):
            return
        if level == last:
            i, j = a.levels[level][0][x], b.levels[level][0][y]
            ok = (a.points[i] * b.points[j]).sum(axis=1) >= min_cosine
            found.append((i[ok], j[ok]))
            return
        xl, xr = children(a.levels[level + 1][2], x)
        yl, yr = children(b.levels[level + 1][2], y)
        size = (xr - xl) * (yr - yl)
        # child pairs in portions of bounded size
        ends = np.cumsum(size)
        for lo in range(0, int(ends[-1]), 1 << 18):
            k = np.arange(lo, min(lo + (1 << 18), int(ends[-1])))
            p = np.searchsorted(ends, k, "right")
            r = k - (ends[p] - size[p])
            width = (yr - yl)[p]
            cx, cy = xl[p] + r // width, yl[p] + r % width
            if same:                                # each pair once: places below a node stay in its order
                once = cx < cy if level + 1 == last else cx <= cy
                cx, cy = cx[once], cy[once]
            descend(level + 1, *close(level + 1, cx, cy))

    top_a, top_b = a.levels[0], b.levels[0]
    if start is not None:
        descend(UPPER, *close(UPPER, *start))
    for lo in range(0, len(top_a[0]) if start is None else 0, ROWS):        # the top level as matrix products
        x = np.arange(lo, min(lo + ROWS, len(top_a[0])))
        d = _distances(a.points[top_a[0][x]], b.points[top_b[0]])
        i, y = np.nonzero(d <= t + top_a[1][x][:, None] + top_b[1][None, :] + 1e-7)
        x = x[i]
        if same:
            x, y = x[x <= y], y[x <= y]
        descend(0, *close(0, x, y))
    n = np.zeros(len(a.points) + (0 if same else len(b.points)), np.int64)
    links = [(i, j + shift) for i, j in found]
    for i, j in found:
        np.add.at(n, i, weight_b[j])
        np.add.at(n, j + shift, weight_a[i])
    for side, (tree, _) in enumerate(trees):
        leaf = tree.levels[-1][0] + (shift if side else 0)
        n[leaf] += np.cumsum(gain[side])[:-1]
        chain = np.nonzero(np.cumsum(joined[side])[:-1] > 0)[0]
        links.append((leaf[chain], leaf[np.minimum(chain + 1, len(leaf) - 1)]))
    own = a.levels[-1][0]
    n[own] -= np.cumsum(inside)[:-1] * weight_a[own]
    links += whole
    return n, np.concatenate([u for u, _ in links]), np.concatenate([v for _, v in links])


def roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest node reachable, for nodes 0 .. n-1 and links (u, v)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, u, label[v])
        np.minimum.at(new, v, label[u])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _clean(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows that link, others): others are null, empty or zero vectors and
    those with a null or non-finite component."""
    v = F.transform(F.col(vec_col).cast("array<double>"), lambda x: x + F.lit(0.0))
    rows = vectors.select(F.col(id_col).alias("_id"), v.alias("_v"))
    fine = (F.col("_v").isNotNull() & F.exists("_v", lambda x: x != 0) &
            F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    fine = F.coalesce(fine, F.lit(False))
    return rows.where(fine), rows.where(~fine)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    min_cosine: float = MIN_COSINE) -> DataFrame:
    """One row per input row: id, n_links (other rows linked directly),
    component_id (smallest id reachable, its own included).

    Null, empty, zero and non-finite vectors link with nothing: n_links 0,
    component_id their own id. Vectors of different lengths never link.
    Repeated rows are rows: they link with each other. Null ids link
    too; a component without any id has component_id null.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "covertree")
    good, rest = _clean(vectors, id_col, vec_col)
    copies = good.groupBy("_v").agg(F.min("_id").alias("_low"), F.count(F.lit(1)).alias("_m"))
    # numbers are fixed by writing them
    points = scratch.table(copies.withColumn("_key", F.monotonically_increasing_id()), "points")
    blocks = _blocks(points, min_cosine, scratch)
    links = scratch.table(_links(blocks, min_cosine, scratch), "links")
    counts = links.groupBy("_key").agg(F.sum("n").alias("_n"))
    rooted = components(links.select(F.col("_key").alias("u"), F.col("root").alias("v")), scratch)
    point = points.select("_key", "_v", "_low", "_m").join(
        rooted.select(F.col("node").alias("_key"), "root"), "_key", "left").join(counts, "_key", "left")
    point = scratch.table(point.select("_v", "_low", F.coalesce("root", "_key").alias("root"),
                                       (F.coalesce("_n", F.lit(0)) + F.col("_m") - 1).alias("n_links")), "point")
    lows = point.groupBy("root").agg(F.min("_low").alias("component_id"))
    point = scratch.table(point.join(lows, "root").select("_v", "n_links", "component_id"), "labels")
    linked = good.join(point, "_v").select("_id", "n_links", "component_id")
    alone = rest.select("_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"))
    return linked.union(alone).select(F.col("_id").alias(id_col), "n_links", "component_id")


def farthest(points: np.ndarray, most: int, radius: float) -> np.ndarray:
    """Numbers of points chosen one after the other, each the farthest from those before it, until
    they cover all within ``radius`` or are ``most``."""
    chosen, near = [0], _distances(points, points[:1])[:, 0]
    while len(chosen) < min(most, len(points)) and near.max() > radius:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, _distances(points, points[chosen[-1:]])[:, 0])
    return np.array(chosen)


PLACED = "_key bigint, _v array<double>, _m bigint, _h bigint, _d int, _pivot int, _path string, _done boolean"


def _place(points: DataFrame, n: int, scratch: Scratch) -> DataFrame:
    """The first level: every vector with the nearest pivot of a bounded sample, which only shapes the tree."""
    wanted = int(min(MAX_PIVOTS, max(1, n // BLOCK)))
    sample = points.select("_v").orderBy(F.xxhash64("_v")).limit(PIVOT_SAMPLE)
    rows = sample.toPandas()["_v"] if n else []
    pivots: dict[int, np.ndarray] = {}
    for d in {len(r) for r in rows}:
        m = unit(np.array([r for r in rows if len(r) == d], dtype=np.float64))
        pivots[d] = m[farthest(m, wanted, 0.0)]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = np.zeros(len(b), np.int32)
            sizes = b["_v"].map(len).to_numpy()
            for d in np.unique(sizes):
                at = np.nonzero(sizes == d)[0]
                if d in pivots:
                    out[at] = _distances(unit(np.stack(b["_v"].iloc[at])), pivots[d]).argmin(axis=1)
            yield b.assign(_d=sizes.astype(np.int32), _pivot=out, _path=out.astype(str), _done=False)

    return scratch.table(points.select("_key", "_v", "_m", F.xxhash64("_key").alias("_h")).mapInPandas(place, PLACED), "placed_0")


def _deepen(placed: DataFrame, min_cosine: float, scratch: Scratch) -> DataFrame:
    """Levels below the first: nodes with more than ``BLOCK`` vectors are divided among pivots of their own.
    A node within a quarter of the threshold distance stays whole (``_done``): no bound could part it.
    A large node's vectors are dealt over tasks, each with a copy of its pivots."""
    floor = float(np.sqrt(max(2.0 - 2.0 * min_cosine, 0.0))) / 4
    node = ["_d", "_path"]

    def choose(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["_n"].iloc[0])
        m = unit(np.stack(pdf["_v"]))
        reach = float(_distances(m, m[:1]).max())
        found = m[farthest(m, min(MAX_PIVOTS, max(2, 2 * n // BLOCK)), reach / 2)] if reach > floor else m[:0]
        return pd.DataFrame({"_d": [key[0]], "_path": [key[1]], "_n": [n], "_pivots": [found.tobytes()]})

    def assign(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return rows.assign(_done=False)
        rows = rows.drop(columns=["_salt"])
        m = np.frombuffer(pivots["_pivots"].iloc[0] if len(pivots) else b"").reshape(-1, rows["_d"].iloc[0])
        if len(m) < 2:
            return rows.assign(_done=True)
        to = _distances(unit(np.stack(rows["_v"])), m).argmin(axis=1)
        return rows.assign(_path=rows["_path"].iloc[0] + "/" + pd.Series(to, index=rows.index).astype(str))

    for depth in range(1, DEPTH + 1):
        crowded = scratch.table(placed.where("not _done").groupBy(node).agg(F.count(F.lit(1)).alias("_n"))
                                .where(F.col("_n") > BLOCK), f"crowded_{depth}")
        if crowded.isEmpty():
            break
        large = placed.where("not _done").join(crowded, node)
        rest = placed.where("not _done").join(crowded, node, "left_anti").select(*placed.columns).union(placed.where("_done"))
        sample = large.where(F.pmod("_h", F.ceil(F.col("_n") / NODE_SAMPLE)) == 0).select(*node, "_n", "_v")
        pivots = sample.groupBy(node).applyInPandas(choose, "_d int, _path string, _n bigint, _pivots binary")
        last = F.floor((F.col("_n") - 1) / DEAL)
        pivots = scratch.table(pivots, f"pivots_{depth}").select(*node, "_pivots", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_salt"))
        dealt = large.withColumn("_salt", F.pmod(F.shiftrightunsigned("_h", 24), last + 1)).drop("_n")
        moved = dealt.groupBy(*node, "_salt").cogroup(pivots.groupBy(*node, "_salt")).applyInPandas(assign, PLACED)
        placed = scratch.table(rest.union(moved.select(*placed.columns)), f"placed_{depth}")
        scratch.drop(f"placed_{depth - 1}")
    return placed


def _blocks(points: DataFrame, min_cosine: float, scratch: Scratch) -> DataFrame:
    """One row per block: its vectors and the tree's arrays as bytes (keys, weights, points, sizes, nodes), and
    apart from them the nodes of level ``UPPER`` (u_points, u_radii, u_alone: one vector only, u_weights, u_keys: of the centre)."""
    n = points.count()
    placed = _deepen(_place(points, n, scratch), min_cosine, scratch)
    # rows of a node are numbered and cut into blocks of BLOCK: more than one only where no pivot parted them
    numbered = number_in_groups(placed, ["_d", "_path"], [], "_h", "_at", bucket_count(n))
    numbered = numbered.withColumn("_part", F.floor(F.col("_at") / BLOCK).cast("int"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        raw = np.stack(pdf["_v"]).astype(np.float64)
        points_ = unit(raw)
        tree = Tree.build(points_)
        single = raw.astype(np.float32)
        whole = bool((single == raw).all())          # single precision holds them exactly
        stored = single if whole else raw
        upper, radii, _ = tree.levels[UPPER]
        lo, hi = tree.spans[UPPER]
        keys, weights = pdf["_key"].to_numpy(np.int64), pdf["_m"].to_numpy(np.int64)
        upto = np.append(0, np.cumsum(weights[tree.levels[-1][0]]))
        out = {"dims": raw.shape[1], "pivot": int(pdf["_pivot"].iloc[0]), "path": pdf["_path"].iloc[0], "single": whole,
               "keys": keys.tobytes(), "weights": weights.tobytes(), "points": stored.tobytes(),
               "sizes": [[len(lv[0]) for lv in tree.levels]],
               "nodes": b"".join(lv[1].tobytes() + lv[0].astype(np.int32).tobytes() + lv[2].astype(np.int32).tobytes()
                                 for lv in tree.levels),
               "u_n": len(upper), "u_points": stored[upper].tobytes(), "u_radii": radii.tobytes(),
               "u_alone": (hi - lo == 1).tobytes(), "u_weights": (upto[hi] - upto[lo]).tobytes(), "u_keys": keys[upper].tobytes()}
        return pd.DataFrame({k: v if isinstance(v, list) else [v] for k, v in out.items()})

    schema = ("dims int, pivot int, path string, single boolean, keys binary, weights binary, points binary, "
              "sizes array<int>, nodes binary, u_n int, u_points binary, u_radii binary, u_alone binary, u_weights binary, u_keys binary")
    built = numbered.groupBy("_d", "_path", "_part").applyInPandas(build, schema)
    return scratch.table(built.withColumn("block", F.monotonically_increasing_id()), "blocks")


def _packs(blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per pack: upper nodes of neighbouring blocks of a pivot, a block's always together, up to two
    blocks' worth; with a centre and the radius that covers what is under the nodes. Where vectors gather
    there are far fewer packs than blocks."""
    before = Window.partitionBy("dims", "pivot").orderBy("path", "block").rowsBetween(Window.unboundedPreceding, -1)
    upper = blocks.select("block", "dims", "pivot", "path", "u_n")          # one narrow row a block
    upper = upper.select("block", F.floor(F.coalesce(F.sum("u_n").over(before), F.lit(0)) / BLOCK).alias("part"))
    rows = blocks.select("block", "dims", "pivot", "single", "u_points", "u_radii", "u_alone", "u_weights", "u_keys").join(upper, "block")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        dims = int(pdf["dims"].iloc[0])
        raw = [np.frombuffer(p, np.float32 if s else np.float64).reshape(-1, dims) for p, s in zip(pdf["u_points"], pdf["single"])]
        counts = [len(r) for r in raw]
        whole = bool(pdf["single"].all())
        raw = np.concatenate(raw).astype(np.float32 if whole else np.float64)
        points = unit(raw)
        radii = np.concatenate([np.frombuffer(r) for r in pdf["u_radii"]])
        mean = points.mean(axis=0)
        far = float((np.sqrt(((points - mean) ** 2).sum(axis=1)) + radii).max())
        return pd.DataFrame({
            "dims": [dims], "pivot": [int(pdf["pivot"].iloc[0])], "centre": [mean.tolist()], "far": [far], "single": [whole],
            "of": [np.repeat(pdf["block"].to_numpy(np.int64), counts).tobytes()],
            "node": [np.concatenate([np.arange(c, dtype=np.int32) for c in counts]).tobytes()],
            "points": [raw.tobytes()], "radii": [radii.tobytes()], "alone": [b"".join(pdf["u_alone"])],
            "weights": [b"".join(pdf["u_weights"])], "keys": [b"".join(pdf["u_keys"])]})

    built = rows.groupBy("dims", "pivot", "part").applyInPandas(
        build, "dims int, pivot int, centre array<double>, far double, single boolean, of binary, node binary, "
               "points binary, radii binary, alone binary, weights binary, keys binary")
    return scratch.table(built.withColumn("block", F.monotonically_increasing_id()), "packs")


def _tree(row: dict) -> tuple[np.ndarray, np.ndarray, Tree]:
    points = unit(np.frombuffer(row["points"], np.float32 if row["single"] else np.float64).reshape(-1, row["dims"]))
    levels, at = [], 0
    for n in row["sizes"]:
        far = np.frombuffer(row["nodes"], np.float64, n, at)
        centre = np.frombuffer(row["nodes"], np.int32, n, at + 8 * n)
        parent = np.frombuffer(row["nodes"], np.int32, n, at + 12 * n)
        levels.append((centre, far, parent))
        at += 16 * n
    return np.frombuffer(row["keys"], np.int64), np.frombuffer(row["weights"], np.int64), Tree(points, levels)


def _gap(x: str, y: str) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(x, y, lambda u, v: (u - v) * (u - v)), F.lit(0.0), lambda s, u: s + u))


def block_pairs(meta: DataFrame, t: float) -> DataFrame:
    """(a, b), a <= b: pairs of packs that may hold vectors within ``t``. Pairs of
    pivots (few, whatever the input) are bounded first, by a centre and the radius
    that covers their packs; only those left are joined out to packs."""
    first = meta.groupBy("dims", "pivot").agg(F.min_by("centre", "block").alias("pc"))
    pivots = meta.join(first, ["dims", "pivot"]).groupBy("dims", "pivot").agg(
        F.first("pc").alias("pc"), F.max(_gap("pc", "centre") + F.col("far")).alias("pr"))
    other = pivots.select("dims", F.col("pivot").alias("qivot"), F.col("pc").alias("qc"), F.col("pr").alias("qr"))
    near = pivots.join(other, "dims").where(_gap("pc", "qc") <= F.col("pr") + F.col("qr") + t + 2 * GUARD) \
        .select("dims", "pivot", "qivot")
    left = meta.select("dims", "pivot", F.col("block").alias("a"), F.col("centre").alias("ca"), F.col("far").alias("ra"))
    right = meta.select("dims", F.col("pivot").alias("qivot"), F.col("block").alias("b"), F.col("centre").alias("cb"),
                        F.col("far").alias("rb"))
    return near.join(left, ["dims", "pivot"]).join(right, ["dims", "qivot"]).where(
        (F.col("a") <= F.col("b")) & (_gap("ca", "cb") <= F.col("ra") + F.col("rb") + t + GUARD)).select("a", "b")


def _near(blocks: DataFrame, t: float, scratch: Scratch) -> DataFrame:
    """Two kinds of rows. (a, b, x, y), a <= b: upper nodes x of block a and y of block b, place by place, that may
    hold vectors within ``t``; one row per pair of blocks, more only beyond ``NODE_PAIRS``. (a, node, gain, own,
    key, root), b null: all vectors under the node of block a link with others of weight ``gain`` (``own``: with each
    other as well, in ``gain`` too), and its centre ``key`` is connected to ``root``; one row per node and pair of packs,
    however many nodes it is whole with."""
    packs = _packs(blocks, scratch)
    pairs = scratch.table(block_pairs(packs.select("block", "dims", "pivot", "centre", "far"), t), "pack_pairs")
    data = ["dims", "single", "of", "node", "points", "radii", "alone", "weights", "keys"]
    schema = "a bigint, b bigint, x binary, y binary, node int, gain bigint, own boolean, key bigint, root bigint"
    first = packs.select(F.col("block").alias("a"), *[F.col(c).alias(f"a_{c}") for c in data])
    other = packs.select(F.col("block").alias("b"), *[F.col(c).alias(f"b_{c}") for c in data])

    def unpack(row: dict, side: str) -> tuple:
        points = np.frombuffer(row[f"{side}_points"], np.float32 if row[f"{side}_single"] else np.float64)
        return (np.frombuffer(row[f"{side}_of"], np.int64), np.frombuffer(row[f"{side}_node"], np.int32),
                unit(points.reshape(-1, row[f"{side}_dims"])), np.frombuffer(row[f"{side}_radii"]),
                np.frombuffer(row[f"{side}_alone"], bool), np.frombuffer(row[f"{side}_weights"], np.int64),
                np.frombuffer(row[f"{side}_keys"], np.int64))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def portion(block: int, i: np.ndarray, j: np.ndarray):
            order = np.argsort(of_b[j], kind="stable")
            i, j = node_a[i[order]], j[order]
            partner, at = np.unique(of_b[j], return_index=True)
            ends = np.append(at[1:], len(j))
            rows = [(block, p, i[u:v], node_b[j[u:v]]) if block <= p else (p, block, node_b[j[u:v]], i[u:v])
                    for p, u, v in zip(partner.tolist(), at, ends)]
            n = len(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2].tobytes() for r in rows], pa.binary()), pa.array([r[3].tobytes() for r in rows], pa.binary()),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.int64()),
                 pa.nulls(n, pa.int64())], NEAR)

        def gains(of, node, gain, own, key, root):
            at = np.nonzero(gain)[0]
            n = len(at)
            return pa.RecordBatch.from_arrays(
                [pa.array(of[at]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()), pa.array(node[at]),
                 pa.array(gain[at]), pa.array(own[at]), pa.array(key[at]), pa.array(root[at])], NEAR)

        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(m)[k].as_py() for m, c in enumerate(batch.schema.names)}
                same = row["a"] == row["b"]
                of_a, node_a, points_a, radii_a, alone_a, weight_a, key_a = unpack(row, "a")
                of_b, node_b, points_b, radii_b, _, weight_b, key_b = unpack(row, "b")
                shift = 0 if same else len(of_a)            # nodes of b come after those of a
                gain = np.zeros(shift + len(of_b), np.int64)
                own = np.zeros(len(gain), bool)
                links: list[tuple[np.ndarray, np.ndarray]] = []
                cuts = np.append(np.unique(of_a, return_index=True)[1], len(of_a))
                for lo, hi in zip(cuts[:-1], cuts[1:]):
                    held: list[tuple[np.ndarray, np.ndarray]] = []
                    for r in range(lo, hi, ROWS):
                        part = slice(r, min(r + ROWS, hi))
                        d = _distances(points_a[part], points_b)
                        reach = radii_a[part, None] + radii_b[None, :] + 1e-7
                        left, whole = d <= t + reach, d + reach <= t
                        if same:            # each pair once; a single vector has nothing to do with itself
                            at = np.arange(part.start, part.stop)
                            once = at[:, None] < np.arange(len(of_b))[None, :]
                            itself = whole[at - r, at] & ~alone_a[at]
                            own[at] = itself
                            gain[at[itself]] += weight_a[at[itself]]
                            left[at - r, at] &= ~(alone_a[at] | itself)
                            left &= once | (at[:, None] == np.arange(len(of_b))[None, :])
                            whole &= once
                        if whole.any():     # linked here, by their weights
                            left &= ~whole
                            gain[part] += np.rint(whole @ weight_b.astype(np.float64)).astype(np.int64)
                            gain[shift:] += np.rint(weight_a[part].astype(np.float64) @ whole).astype(np.int64)
                            links.append(_joined(whole, r, shift))
                        i, j = np.nonzero(left)
                        i = i + r
                        for u in range(0, len(i), NODE_PAIRS):
                            held.append((i[u:u + NODE_PAIRS], j[u:u + NODE_PAIRS]))
                            if sum(len(h[0]) for h in held) >= NODE_PAIRS:
                                yield portion(int(of_a[lo]), *map(np.concatenate, zip(*held)))
                                held = []
                    if held:
                        yield portion(int(of_a[lo]), *map(np.concatenate, zip(*held)))
                if gain.any():
                    key = key_a if same else np.concatenate([key_a, key_b])
                    u, v = map(np.concatenate, zip(*links)) if links else (np.empty(0, np.int64),) * 2
                    yield gains(*((of_a, node_a) if same else (np.concatenate([of_a, of_b]), np.concatenate([node_a, node_b]))),
                                gain, own, key, key[roots(len(key), u, v)])

    both = pairs.join(first, "a").join(other, "b")
    return scratch.table(both.mapInArrow(run, schema), "near")


def _joined(mask: np.ndarray, first: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Links enough to join what ``mask`` connects: its rows are nodes from ``first`` on, its columns nodes from
    ``shift`` on. At most one link per row and column."""
    none = len(mask)
    row = np.where(mask.any(axis=1), np.arange(none), none)
    while True:
        col = np.where(mask, row[:, None], none).min(axis=0)
        new = np.minimum(row, np.where(mask, col[None, :], none).min(axis=1))
        if (new == row).all():
            break
        row = new
    i, j = np.nonzero(row < none)[0], np.nonzero(col < none)[0]
    return np.concatenate([i + first, j + shift]), np.concatenate([row[i], col[j]]) + first


def _links(blocks: DataFrame, min_cosine: float, scratch: Scratch) -> DataFrame:
    """(_key, n, root): for each pair of blocks that may hold links, each linked
    vector's weight of links and its root among the two blocks."""
    t = float(np.sqrt(max(2.0 - 2.0 * min_cosine, 0.0)))
    near = _near(blocks, t, scratch)
    data = ["dims", "single", "keys", "weights", "points", "sizes", "nodes"]
    first = blocks.select(F.col("block").alias("a"), *[F.col(c).alias(f"a_{c}") for c in data])
    other = blocks.select(F.col("block").alias("b"), *[F.col(c).alias(f"b_{c}") for c in data])
    both = near.where("b is not null").select("a", "b", "x", "y").join(first, "a").join(other, "b")
    # what whole nodes add, summed before any vector is read
    whole = near.where("b is null").groupBy("a", "node").agg(F.sum("gain").alias("gain"), F.max("own").alias("own"))
    whole = whole.groupBy("a").agg(F.collect_list(F.struct("node", "gain", "own")).alias("whole"))    # nodes of one block
    apart = near.where("b is null and key != root").select(F.col("key").alias("_key"), F.lit(0).cast("long").alias("n"), "root")

    def spread(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(k)[i].as_py() for k, c in enumerate(batch.schema.names)}
                keys, weights, tree = _tree({c: row[f"a_{c}"] for c in data})
                node = np.array([w["node"] for w in row["whole"]])
                lo, hi = (x[node] for x in tree.spans[UPPER])
                at = tree.levels[-1][0][np.concatenate([np.arange(x, y) for x, y in zip(lo, hi)])]
                each = [np.repeat(x, hi - lo) for x in ([w["gain"] for w in row["whole"]], [w["own"] for w in row["whole"]],
                                                        keys[tree.levels[UPPER][0][node]])]
                yield pa.RecordBatch.from_arrays([pa.array(keys[at]), pa.array(each[0] - each[1] * weights[at]), pa.array(each[2])],
                                                 ["_key", "n", "root"])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(k)[i].as_py() for k, c in enumerate(batch.schema.names)}
                same = row["a"] == row["b"]
                ka, wa, ta = _tree({c: row[f"a_{c}"] for c in data})
                kb, wb, tb = (ka, wa, ta) if same else _tree({c: row[f"b_{c}"] for c in data})
                start = tuple(np.frombuffer(row[c], np.int32).astype(np.int64) for c in "xy")
                n, x, y = dual(ta, tb, wa, wb, min_cosine, same, start)
                if not n.any():
                    continue
                key = ka if same else np.concatenate([ka, kb])
                label = roots(len(key), x, y)
                at = np.nonzero(n)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[at]), pa.array(n[at]), pa.array(key[label[at]])], ["_key", "n", "root"])

    schema = "_key bigint, n bigint, root bigint"
    return both.mapInArrow(run, schema).union(whole.join(first, "a").mapInArrow(spread, schema)).union(apart)
