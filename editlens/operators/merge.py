"""Serving-layer merge of the batch view and the speed view.

The merge is a bag union followed by one aggregate on wiki -- a single
shuffle of two small views, no join and no broadcast. The full-outer-join
form is kept as a cross-check and gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from editlens.config import DEFAULTS
from editlens.functions import group_key, has_wiki, not_bot, should_count
from editlens.operators.views import top_n

VIEW_SCHEMA = StructType([StructField("wiki", StringType(), True),
                          StructField("edits", LongType(), True)])


def as_view(df: DataFrame, value: str) -> DataFrame:
    """(wiki, <value>) -> (wiki string, edits bigint)."""
    return df.select(F.col("wiki").cast("string").alias("wiki"),
                     F.col(value).cast("long").alias("edits"))


def empty_view(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], VIEW_SCHEMA)


def lambda_merge(batch: DataFrame | None, speed: DataFrame | None, n: int = DEFAULTS.top_n,
                 batch_value: str = "edits", speed_value: str = "count") -> DataFrame:
    """merged = batch + speed per wiki (a missing side counts 0), then top-N.

    Either side may be None (degraded mode: that layer is unavailable).
    """
    parts = []
    if batch is not None:
        parts.append(as_view(batch, batch_value))
    if speed is not None:
        parts.append(as_view(speed, speed_value))
    if not parts:
        raise ValueError("lambda_merge needs at least one view")
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    merged = u.groupBy("wiki").agg(F.sum("edits").cast("long").alias("edits_merged"))
    return top_n(merged, "edits_merged", "wiki", n)


def lambda_merge_outer(batch: DataFrame, speed: DataFrame, n: int = DEFAULTS.top_n,
                       batch_value: str = "edits", speed_value: str = "count") -> DataFrame:
    b = as_view(batch, batch_value).withColumnRenamed("edits", "b")
    s = as_view(speed, speed_value).withColumnRenamed("edits", "s")
    j = b.join(s, "wiki", "full_outer")
    merged = j.select("wiki", (F.coalesce("b", F.lit(0)) + F.coalesce("s", F.lit(0)))
                      .cast("long").alias("edits_merged"))
    return top_n(merged, "edits_merged", "wiki", n)


def lambda_merge_exact(events: DataFrame, cutoff: Column, n: int = DEFAULTS.top_n,
                       exclude_bots: bool = DEFAULTS.exclude_bots) -> DataFrame:
    """Exact merge: batch counts of events at or before ``cutoff`` plus speed
    counts strictly after it, both untruncated, then top-N. No event is
    counted twice and no wiki is lost to an early limit.

    The two populations are disjoint in time, so this is one scan and one
    aggregate: each row is keyed the way its layer keys it (batch: wiki;
    speed: wiki, else id, else 'unknown') and counted once.
    """
    before = F.col("event_time") <= cutoff
    in_batch = before & has_wiki() & (not_bot() if exclude_bots else F.lit(True))
    in_speed = ~before & should_count()
    key = F.when(in_batch, F.col("wiki")).otherwise(group_key())
    merged = (events.filter(in_batch | in_speed)
              .groupBy(key.alias("wiki"))
              .agg(F.count(F.lit(1)).alias("edits_merged")))
    return top_n(merged, "edits_merged", "wiki", n)
