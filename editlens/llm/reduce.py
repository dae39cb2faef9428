"""Folding one partial result a task into one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIDDLE = 32              # tasks of the first level
NULL_SALTS = 4096        # rows without an id are spread over so many join keys


def fold(rows: DataFrame, merge: Callable, schema: str) -> DataFrame:
    """One row from one row a task, in two levels; ``merge`` streams its rows, so a task holds
    two partial results however many there are."""
    middle = min(MIDDLE, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(middle).mapInArrow(merge, schema).repartition(1).mapInArrow(merge, schema)


def mark(rows: DataFrame, labels: DataFrame, marks: dict[str, Column], spread: Column) -> DataFrame:
    """Adds the boolean columns ``marks`` to rows with a ``doc_id``: true if it holds for any label row of
    that id, null without a label row. Rows without an id match nothing and are spread
    over the join's tasks by the hash ``spread``."""
    sides = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("label_id"))
             .agg(*[F.max(F.coalesce(c, F.lit(False))).alias(name) for name, c in marks.items()])
             .withColumn("label_salt", F.lit(0)))
    salt = F.when(F.col("doc_id").isNull(), 1 + F.pmod(spread, F.lit(NULL_SALTS)).cast("int")).otherwise(0)
    rows = rows.withColumns({"join_id": F.coalesce("doc_id", F.lit(0)), "salt": salt})
    on = (F.col("join_id") == F.col("label_id")) & (F.col("salt") == F.col("label_salt"))
    return rows.join(sides, on, "left").drop("join_id", "salt", "label_id", "label_salt")
