"""K-d tree sharding by bytes, SQL functions only.

A node of the tree is split where its weighted quantile (the median, for an even
number of shards) lies along its widest dimension: the one whose values spread
furthest, as a share of that dimension's range over all rows. Each dimension's
order is (value, text hash, row hash) in one 63-bit key: equal texts lie side by
side and are cut apart only where they outweigh ``SLACK`` of a shard.

The quantile of all nodes of a level is found by radix descent: an
aggregate over (node, 13-bit digit), then the next digit inside the digit
that holds the quantile, until that holds too little weight to matter. Only one
row per node reaches the driver (fewer than there are shards).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editlens.llm.ranking import bucket_count, number_in_groups
from editlens.llm.scratch import Scratch

SHARDS = 16
SLACK = 1 / 64             # of a shard's target bytes
VALUE_BITS, TEXT_BITS, ROW_BITS = 24, 20, 19
DIGITS = (11, 13, 13, 13, 13)  # of the 63-bit key, from the top


@dataclass
class Split:
    node: int              # heap index: children are 2n and 2n + 1
    dim: int
    low: float
    width: float
    key: int               # rows with key < this go left


def _position(dim_values: list[Column], dim: Column, low: Column, width: Column) -> Column:
    """63-bit key of a row along the dimension ``dim``."""
    v = F.element_at(F.array(*dim_values), dim + 1)
    top = F.lit((1 << VALUE_BITS) - 1)
    scaled = F.when(width > 0, F.floor((v - low) / width * top)).otherwise(0).cast("long")
    scaled = F.greatest(F.least(scaled, top.cast("long")), F.lit(0).cast("long"))
    text = F.shiftright(F.col("_text_hash"), 64 - TEXT_BITS).bitwiseAND(F.lit((1 << TEXT_BITS) - 1).cast("long"))
    row = F.shiftright(F.col("_row_hash"), 64 - ROW_BITS).bitwiseAND(F.lit((1 << ROW_BITS) - 1).cast("long"))
    return F.shiftleft(scaled, TEXT_BITS + ROW_BITS).bitwiseOR(F.shiftleft(text, ROW_BITS)).bitwiseOR(row)


def _table(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """Literal rows, at most one per node."""
    fields = [f.split() for f in schema.split(", ")]
    literals = [F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(r, fields)]) for r in rows]
    one = df.sparkSession.range(1).select(F.explode(F.array(*literals)).alias("r"))
    return F.broadcast(one.select("r.*"))


def kd_splits(rows: DataFrame, dims: list[str], shards: int) -> tuple[list[list[Split]], dict[int, int]]:
    """rows: dims, _w (weight), _text_hash, _row_hash, _root (1). Returns the splits by level
    and the shard number of each leaf node."""
    whole = rows.agg(F.sum("_w"), *[F.max(d) - F.min(d) for d in dims]).first()
    span = [float(x or 0) for x in whole[1:]]
    slack = float(whole[0] or 0) / shards * SLACK
    values = [F.coalesce(F.col(d).cast("double"), F.lit(0.0)) for d in dims]
    want, levels, leaves = {1: shards}, [], {}
    while want:
        leaves |= {n: k for n, k in want.items() if k == 1}
        want = {n: k for n, k in want.items() if k > 1}
        if not want:
            break
        placed = assign(rows, levels, dims)
        spread = {r[0]: r for r in placed.groupBy("_node").agg(
            F.sum("_w"), *[x for d in values for x in (F.min(d), F.max(d))]).collect() if r[0] in want}
        todo = {}
        for n, k in want.items():
            r = spread.get(n)
            sides = [(r[2 + 2 * i], r[3 + 2 * i]) for i in range(len(dims))] if r else [(0.0, 0.0)] * len(dims)
            share = [(hi - lo) / s if s else 0.0 for (lo, hi), s in zip(sides, span)]
            dim = max(range(len(dims)), key=lambda i: (share[i], -i))
            lo, hi = sides[dim]
            todo[n] = {"dim": dim, "low": lo, "width": hi - lo, "aim": (float(r[1]) if r else 0.0) * (k // 2) / k,
                       "below": 0.0, "prefix": 0, "key": None}
        depth = 0
        for digit in DIGITS:
            open_ = {n: t for n, t in todo.items() if t["key"] is None}
            if not open_:
                break
            rest = 63 - depth - digit
            t = _table(rows, [(n, t["dim"], t["low"], t["width"], t["prefix"], t["aim"], t["below"]) for n, t in open_.items()],
                       "_n int, _dim int, _low double, _width double, _prefix long, _aim double, _below double")
            pos = placed.join(t, placed["_node"] == t["_n"]).withColumn(
                "_pos", _position(values, F.col("_dim"), F.col("_low"), F.col("_width")))
            pos = pos.where(F.shiftright("_pos", 63 - depth) == F.col("_prefix")) if depth else pos
            hist = pos.groupBy("_n", "_aim", "_below", F.shiftright("_pos", rest).alias("_digit")).agg(F.sum("_w").alias("_d"))
            run = Window.partitionBy("_n").orderBy("_digit")     # at most 2^13 digits of a node
            hist = hist.withColumn("_upto", F.sum("_d").over(run) + F.col("_below"))
            first = hist.where("_upto >= _aim").groupBy("_n").agg(F.min(F.struct("_digit", "_d", "_upto")).alias("_c"))
            got = {r[0]: r[1] for r in first.collect()}
            depth += digit
            for n, t in open_.items():
                if n not in got:                                 # an empty node
                    t["key"] = 0
                    continue
                d, weight, upto = got[n]
                before = upto - weight
                if weight <= slack or rest == 0:
                    nearer_end = upto - t["aim"] < t["aim"] - before
                    t["key"] = (d + 1 if nearer_end else d) << rest
                else:
                    t["prefix"], t["below"] = d, float(before)
        levels.append([Split(n, t["dim"], t["low"], t["width"], t["key"]) for n, t in todo.items()])
        want = {c: k for n, k0 in want.items() for c, k in ((2 * n, k0 // 2), (2 * n + 1, k0 - k0 // 2))}
    order = sorted(leaves, key=lambda n: f"{n:b}")               # left to right
    return levels, {n: i for i, n in enumerate(order)}


def assign(rows: DataFrame, levels: list[list[Split]], dims: list[str]) -> DataFrame:
    """Adds ``_node``: the heap index of the leaf a row falls in."""
    values = [F.coalesce(F.col(d).cast("double"), F.lit(0.0)) for d in dims]
    out = rows.withColumn("_node", F.col("_root"))
    for level in levels:
        t = _table(rows, [(s.node, s.dim, s.low, s.width, s.key) for s in level],
                   "_n int, _dim int, _low double, _width double, _cut long")
        out = out.join(t, out["_node"] == t["_n"], "left").withColumn("_node", F.when(F.col("_n").isNull(), F.col("_node"))
            .otherwise(2 * F.col("_node") + (_position(values, F.col("_dim"), F.col("_low"), F.col("_width")) >= F.col("_cut")).cast("int"))) \
            .drop("_n", "_dim", "_low", "_width", "_cut")
    return out


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per input row: id, size, text_crc32, shard, slot.

    Size is the text's UTF-8 bytes plus 1 (null text: 1). Dimensions: size, text
    hash. Both follow from the text, so equal texts share a place. Slots
    are gapless from 0 within a shard. Null ids and repeated rows are rows like any other.
    """
    scratch = Scratch(docs.sparkSession, "shard")
    text = F.col(text_col).cast("string")
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    rows = scratch.table(docs.select(
        F.col(id_col).alias("_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(1)).cast("long").alias("_w"),
        crc.alias("_crc"), F.xxhash64(text).alias("_text_hash"))
        .withColumn("_size", F.log2("_w")).withColumn("_row_hash", F.xxhash64("_id", "_text_hash", "_w"))
        .withColumn("_root", F.lit(1)), "rows")
    dims = ["_size", "_crc"]
    levels, leaf = kd_splits(rows, dims, shards)
    names = _table(rows, list(leaf.items()), "_leaf int, shard int")
    placed = assign(rows, levels, dims)
    placed = scratch.table(placed.join(names, placed["_node"] == names["_leaf"]).select(
        "_id", "_w", "_crc", "shard", "_row_hash"), "placed")
    out = number_in_groups(placed, ["shard"], [], "_row_hash", "slot", bucket_count(placed.count()))
    return out.select(F.col("_id").alias(id_col), F.col("_w").alias("size"), F.col("_crc").alias("text_crc32"), "shard", "slot")
