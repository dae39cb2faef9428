"""Mixing sources to target token weights by entropy balancing, SQL functions only.

Rates of documents are the ones nearest (in relative entropy over tokens) to
"take everything once" that meet every token constraint. Their form is
exp(sum of the multipliers of the constraints a document is in); the
multipliers solve the convex dual, by Newton steps. Documents enter the dual
only through cells (combinations of constraint values) and their token mass, so
an iteration is an aggregate over cells. The categories of one dimension
exclude each other, so the Hessian block of a dimension is diagonal: with
several dimensions the blocks take turns.

Rates become whole copies by systematic rounding along the documents of a
source, ordered by size class and hash, so that the error is spread over all
sizes; of ``PHASES`` starting phases each source takes the one whose token total
lies nearest its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editlens.llm.ranking import bucket_count, number_all, number_in_groups
from editlens.llm.scratch import Scratch, whole_rows

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
PHASES = 32
TOLERANCE = 1e-12
MAX_ROUNDS = 80


def word_count(text: str) -> Column:
    # \S is [^\x20\x09-\x0D] in Java
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"\S+")), F.lit(0)).cast("long")


def weighted_targets(sources: DataFrame, scratch: Scratch, weights=WEIGHTS, share: float = SHARE,
                     cap: int = CAP) -> DataFrame:
    """(source, mass) -> + target double. Sources in code point order, null
    last, take the weights in turn; ``share`` of all mass is divided by
    weight, no target above ``cap`` times its mass, the excess reshared."""
    seq = number_all(sources.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "_i", scratch)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod("_i", F.lit(len(weights))) + 1).cast("int"))
    seq = scratch.table(seq.select("source", "mass", w.alias("w")), "weights")
    total = share * float(seq.agg(F.coalesce(F.sum("mass"), F.lit(0))).first()[0])
    # each round fixes the sources above their cap; two sums reach the driver
    level, fixed = None, -1
    while True:
        over = F.lit(False) if level is None else (F.lit(level) * F.col("w") > cap * F.col("mass"))
        capped, free, n = seq.agg(F.sum(F.when(over, cap * F.col("mass")).otherwise(0)).cast("double"),
                                  F.sum(F.when(~over, F.col("w")).otherwise(0.0)),
                                  F.count(F.when(over, 1))).first()
        if n == fixed or not free:
            break
        level, fixed = max(total - (capped or 0.0), 0.0) / free, n
    target = F.least(F.lit(level or 0.0) * F.col("w"), cap * F.col("mass").cast("double"))
    return seq.select("source", "mass", target.alias("target"))


def balance(cells: DataFrame, constraints: dict[str, DataFrame], scratch: Scratch) -> DataFrame:
    """cells: (one column per dimension, mass). constraints: dimension ->
    (value, target) covering its values. Returns cells with ``rate``.

    Minimises sum(mass * (rate * log(rate) - rate + 1)) subject to sum(mass * rate)
    = target for each value of each dimension. A target of 0 (or a value without
    mass) gives rate 0. Raises if the targets contradict each other.
    """
    dims = list(constraints)
    cur = cells
    for d in dims:
        t = constraints[d].select(F.col("value").alias(f"_v_{d}"), F.col("target").cast("double").alias(f"_t_{d}"))
        cur = cur.join(t, F.col(d).eqNullSafe(F.col(f"_v_{d}")), "left").drop(f"_v_{d}")
    open_ = F.lit(True)
    for d in dims:
        open_ = open_ & (F.coalesce(f"_t_{d}", F.lit(0.0)) > 0)
    cur = scratch.table(cur.withColumn("_eta", F.when(open_ & (F.col("mass") > 0), F.lit(0.0))), "dual_0")
    for step in range(MAX_ROUNDS):
        d = dims[step % len(dims)]
        # gradient of the dual in this block is g - target, its Hessian g (diagonal)
        g = cur.groupBy(d).agg(F.sum(F.col("mass") * F.exp("_eta")).alias("_g"), F.first(f"_t_{d}").alias("_t"))
        newton = F.greatest(F.least((F.col("_t") - F.col("_g")) / F.col("_g"), F.lit(2.0)), F.lit(-2.0))
        g = g.where("_g > 0").select(F.col(d).alias("_v"), newton.alias("_step"))
        nxt = cur.join(g, F.col(d).eqNullSafe(F.col("_v")), "left").withColumn(
            "_eta", F.col("_eta") + F.col("_step")).drop("_v", "_step")
        nxt = scratch.table(nxt, f"dual_{step + 1}")
        scratch.drop(f"dual_{step}")
        cur = nxt
        worst = 0.0
        for e in dims:
            off = cur.groupBy(e).agg(F.sum(F.col("mass") * F.exp("_eta")).alias("_g"), F.first(f"_t_{e}").alias("_t"))
            w = off.where("_g > 0").agg(F.max(F.abs(F.col("_g") - F.col("_t")) / F.col("_t"))).first()[0]
            worst = max(worst, w or 0.0)
        if worst <= TOLERANCE:
            break
    if worst > 1e-6:
        raise ValueError(f"the token constraints cannot all be met (off by {worst:.3g})")
    return cur.select(*cells.columns, F.coalesce(F.exp("_eta"), F.lit(0.0)).alias("rate"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """One row per input row: id, _key, _source, size, source_size, target, rate, copies.

    Null and blank texts have size 0; a source of size 0 has target 0. Rows that
    repeat in id, source and text share one decision. Null sources are one source.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_key"),
                       F.col(source_col).cast("string").alias("source"), word_count(text_col).alias("size"))
    units = scratch.table(rows.groupBy("_id", "_key", "source", "size").agg(F.count(F.lit(1)).alias("_m")), "units")
    n = units.count()
    cells = scratch.table(units.groupBy("source").agg(F.sum(F.col("size") * F.col("_m")).alias("mass")), "cells")
    targets = scratch.table(weighted_targets(cells, scratch, weights, share, cap), "targets")
    rates = balance(cells, {"source": targets.select(F.col("source").alias("value"), "target")}, scratch)
    plan = rates.join(targets.select(F.col("source").alias("_src"), "target"),
                      F.col("source").eqNullSafe(F.col("_src"))).drop("_src")
    hashed = units.withColumn("_h", F.xxhash64("_id", "_key", "source"))
    strata = [-F.floor(4 * F.log2(F.col("size") + F.lit(1.0))).cast("int")]
    placed = number_in_groups(hashed, ["source"], strata, "_h", "_rank", bucket_count(n))
    plan = plan.select(F.col("source").alias("_src"), F.col("mass").alias("source_size"), "target", "rate")
    placed = scratch.table(placed.join(plan, F.col("source").eqNullSafe(F.col("_src"))).drop("_src"), "placed")

    def copies(phase: Column) -> Column:
        upto = F.floor(F.col("rate") * (F.col("_rank") + 1) + phase)
        return F.greatest(F.least(upto - F.floor(F.col("rate") * F.col("_rank") + phase), F.lit(cap)), F.lit(0))

    phases = [(2 * i + 1) / (2 * PHASES) for i in range(PHASES)]
    totals = placed.groupBy("source").agg(
        F.first("target").alias("_t"),
        *[F.sum(F.col("size") * F.col("_m") * copies(F.lit(p))).alias(f"_p{i}") for i, p in enumerate(phases)])
    best = F.array_min(F.array(*[F.struct(F.abs(F.col(f"_p{i}") - F.col("_t")).alias("off"), F.lit(p).alias("phase"))
                                 for i, p in enumerate(phases)]))["phase"]
    totals = totals.select(F.col("source").alias("_src"), best.alias("_phase"))
    out = placed.join(totals, F.col("source").eqNullSafe(F.col("_src"))).withColumn("copies", copies(F.col("_phase")).cast("int"))
    return out.withColumn("_r", F.explode(F.array_repeat(F.lit(0), F.col("_m").cast("int")))).select(
        F.col("_id").alias(id_col), "_key", F.col("source").alias("_source"), "size", "source_size", "target",
        "rate", "copies")


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Documents of the mix, each as often as it is taken; all columns of ``docs``, of any name.

    Rows that repeat in id, text and source are taken equally often. Null and blank texts weigh
    nothing and are taken as often as their source's rate says; an empty table gives none.
    """
    take = mix(docs, id_col, text_col, source_col).where("copies > 0").select(
        F.col(id_col).alias("id"), "_key", F.col("_source").alias("from"), "copies").distinct()
    row = F.col("row")
    same = (row[id_col].eqNullSafe(F.col("id")) & (F.xxhash64(row[text_col]) == F.col("_key")) &
            row[source_col].cast("string").eqNullSafe(F.col("from")))
    joined = whole_rows(docs).join(take, same)
    return joined.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")
