"""Panes that open at events: the consumer's own window as keyed state.

A log shard is consumed in order. A pane opens at the first event that comes ``pane_s`` or more
after the last pane's start, and takes every event until the next one opens; so pane
starts depend on the data and cannot be computed row by row. The start of the open pane is
the state of a shard; event-time timers drop it when the shard has been silent
for a window. Pane counts go to an append-only table, and the trailing window is
read from it: panes that start at or after ``as_of - window_s``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from editlens.config import DEFAULTS
from editlens.functions import group_key, partition_key, should_count
from editlens.operators import views
from editlens.streaming.speed import start_query

SECOND = 1_000_000
PANE_ROWS = "shard int, pane_start timestamp, wiki string, count bigint"


def shard_of(key: Column, shards: int) -> Column:
    """Shard whose hash range holds ``key``: ranges of equal width over the first 32 bits of MD5."""
    h = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.shiftright(h * F.lit(int(shards)), 32).cast("int")


def assign(times: np.ndarray, start: int | None, pane_us: int) -> tuple[np.ndarray, int]:
    """Pane start of each of the sorted ``times``, given the open pane's start, and the pane that is
    open afterwards. An event before the open pane counts in it."""
    out, i = np.empty_like(times), 0
    while i < len(times):
        if start is None or times[i] - start >= pane_us:
            start = int(times[i])
        j = max(int(np.searchsorted(times, start + pane_us, "left")), i + 1)
        out[i:j] = start
        i = j
    return out, start


def event_panes(events: DataFrame, shards: int = 4, window_s: int = DEFAULTS.window_seconds,
                pane_s: int = DEFAULTS.pane_seconds, delay: str = DEFAULTS.watermark) -> DataFrame:
    """Streaming pane counts (shard, pane_start, wiki, count) of the admitted events, in pieces: a pane
    that spans micro-batches has a row in each; readers add them up.

    A micro-batch's events of a shard are sorted by time before they are counted; events below
    the watermark are dropped. A task holds one micro-batch's distinct (time, key) pairs of a
    shard, so ``maxFilesPerTrigger`` (or the log's rate limit) over the number of shards bounds it.
    """
    pane_us = pane_s * SECOND

    def run(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        parts = [c.groupby(["t", "wiki"], as_index=False).size() for c in chunks]
        rows = pd.concat(parts).sort_values(["t", "wiki"], kind="stable")
        pane, start = assign(rows["t"].to_numpy(np.int64), state.get[0] if state.exists else None, pane_us)
        state.update((start,))
        state.setTimeoutTimestamp(max(start // 1000 + window_s * 1000, state.getCurrentWatermarkMs() + 1))
        out = rows.assign(pane_start=pane).groupby(["pane_start", "wiki"], as_index=False)["size"].sum()
        yield pd.DataFrame({"shard": np.int32(key[0]), "pane_start": pd.to_datetime(out["pane_start"], unit="us", utc=True),
                            "wiki": out["wiki"], "count": out["size"]})

    rows = (events.withWatermark("event_time", delay).filter(should_count())
            .select(shard_of(partition_key(), shards).alias("shard"), group_key().alias("wiki"), "event_time",
                    F.unix_micros("event_time").alias("t")))
    return rows.groupBy("shard").applyInPandasWithState(
        run, PANE_ROWS, "start bigint", "append", GroupStateTimeout.EventTimeTimeout)


def run_event_panes(events: DataFrame, out: str, checkpoint: str, trigger: dict | None = None, **kw) -> StreamingQuery:
    return start_query(event_panes(events, **kw), checkpoint, "append", "parquet", out, trigger)


def read_panes(spark: SparkSession, out: str) -> DataFrame:
    """(shard, pane_start, wiki, count), a row per pane and key."""
    return (spark.read.schema(PANE_ROWS).parquet(out).groupBy("shard", "pane_start", "wiki")
            .agg(F.sum("count").alias("count")))


def live_counts(panes: DataFrame, as_of: Column, window_s: int = DEFAULTS.window_seconds) -> DataFrame:
    """(wiki, count) over the panes that are live at ``as_of``; the bound reaches the scan."""
    return (panes.filter((F.col("pane_start") >= as_of - F.make_interval(secs=F.lit(window_s)))
                         & (F.col("pane_start") <= as_of))
            .groupBy("wiki").agg(F.sum("count").alias("count")))


def live_topn(panes: DataFrame, as_of: Column, n: int = DEFAULTS.top_n,
              window_s: int = DEFAULTS.window_seconds) -> DataFrame:
    return views.top_n(live_counts(panes, as_of, window_s), "count", "wiki", n)
