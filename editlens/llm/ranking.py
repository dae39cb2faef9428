"""Numbering rows without putting a whole group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editlens.llm.scratch import Scratch

#: Rows per bucket aimed at; the number of buckets follows the input.
BUCKET_ROWS = 1 << 17
MIN_BUCKETS = 64


def bucket_count(n_rows: int) -> int:
    n = MIN_BUCKETS
    while n * BUCKET_ROWS < n_rows:
        n *= 2
    return n


def number_in_groups(df: DataFrame, group: list[str], strata: list[Column], hash_col: str,
                     out: str, buckets: int) -> DataFrame:
    """Adds ``out``: 0, 1, 2, ... within ``group``, in the order (strata, hash).

    Rows are dealt over cells (group, strata, hash bucket). Counts of the cells,
    summed in order, say where each cell starts; only rows of one cell are
    sorted together. ``df`` must be a stored table (it is read twice) and
    ``hash_col`` a 64-bit hash of the row's content.
    """
    strata_cols = [f"_s{i}" for i in range(len(strata))]
    cells = df.withColumns({c: e for c, e in zip(strata_cols, strata)}).withColumn(
        "_b", F.pmod(F.shiftrightunsigned(F.col(hash_col), 8), F.lit(buckets)).cast("int"))
    key = [*group, *strata_cols, "_b"]
    order = [*strata_cols, "_b"]
    start = Window.partitionBy(*group).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    starts = (cells.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_start", F.coalesce(F.sum("_n").over(start), F.lit(0)))
              .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], "_start"))
    inside = Window.partitionBy(*key).orderBy(hash_col)
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(key)]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return (cells.withColumn("_in", F.row_number().over(inside) - 1)
            .join(starts, cond, "left")
            .withColumn(out, (F.col("_start") + F.col("_in")).cast("long"))
            .select(*df.columns, out))


def number_all(df: DataFrame, order: list[str], out: str, scratch: Scratch) -> DataFrame:
    """Adds ``out``: 0, 1, 2, ... over the whole table in the given order, by a
    range partitioning whose partitions are numbered separately."""
    laid = scratch.table(
        df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), f"laid_{out}")
    # one row per range partition
    parts = laid.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_p").orderBy(*order)
    return (laid.withColumn("_in", F.row_number().over(inside) - 1)
            .join(parts, "_p")
            .withColumn(out, (F.col("_start") + F.col("_in")).cast("long"))
            .select(*df.columns, out))
