"""Event-time window operators (batch form; the streaming twins reuse them).

Hopping windows expand every row into ``window / slide`` copies. The pane
form first counts per (pane, key) -- tumbling, no expansion -- and only
then expands the pane counts, so the expansion works on at most
#panes x #keys rows instead of all events. Because hop boundaries are
multiples of the pane, both forms give identical windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editlens.config import DEFAULTS
from editlens.functions import group_key, should_count, to_ntz
from editlens.operators.views import batch_population, top_n


def _secs(s: int) -> str:
    return f"{int(s)} seconds"


_UNIT_S = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def duration_seconds(d: str) -> int:
    """'5 minutes' -> 300; raises when the string is not a simple 'N unit'."""
    import re
    m = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day)s?\s*", d.lower())
    if m is None:
        raise ValueError(f"not a duration of the form 'N seconds|minutes|hours|days': {d!r}")
    return int(m.group(1)) * _UNIT_S[m.group(2)]


def panes_are_exact(window: str, slide: str, pane_s: int) -> bool:
    """Pane pre-aggregation equals direct hopping only when every hop
    boundary is a pane boundary."""
    w, s = duration_seconds(window), duration_seconds(slide)
    return w % pane_s == 0 and s % pane_s == 0


def flatten_window(df: DataFrame, col: str = "window", ntz: bool = True) -> DataFrame:
    start, end = F.col(f"{col}.start"), F.col(f"{col}.end")
    if ntz:
        start, end = to_ntz(start), to_ntz(end)
    rest = [c for c in df.columns if c != col]
    return df.select(start.alias("window_start"), end.alias("window_end"), *rest)


def sliding_counts(df: DataFrame, time_col: str = "event_time", key: str = "wiki",
                   window: str = DEFAULTS.window, slide: str = DEFAULTS.slide,
                   value: str = "edits") -> DataFrame:
    """Direct hopping-window count: (window struct, key, value)."""
    return (df.groupBy(F.window(time_col, window, slide).alias("window"), F.col(key))
            .agg(F.count(F.lit(1)).alias(value)))


def pane_counts(df: DataFrame, time_col: str = "event_time", key: str = "wiki",
                pane_s: int = DEFAULTS.pane_seconds, value: str = "edits") -> DataFrame:
    """Tumbling pane counts: (pane struct, key, value)."""
    return (df.groupBy(F.window(time_col, _secs(pane_s)).alias("pane"), F.col(key))
            .agg(F.count(F.lit(1)).alias(value)))


def panes_to_windows(panes: DataFrame, key: str = "wiki", window: str = DEFAULTS.window,
                     slide: str = DEFAULTS.slide, value: str = "edits") -> DataFrame:
    """Sum pane counts into hopping windows (pane placed at its window_time)."""
    return (panes.groupBy(F.window(F.window_time("pane"), window, slide).alias("window"),
                          F.col(key))
            .agg(F.sum(value).cast("long").alias(value)))


def sliding_edits(events: DataFrame, time_col: str = "event_time",
                  window: str = DEFAULTS.window, slide: str = DEFAULTS.slide,
                  exclude_bots: bool = DEFAULTS.exclude_bots) -> DataFrame:
    """Per-wiki edit counts in hopping windows (direct form)."""
    pop = batch_population(events.select("wiki", "bot", time_col), exclude_bots)
    return flatten_window(sliding_counts(pop, time_col, "wiki", window, slide))


def pane_sliding(events: DataFrame, time_col: str = "event_time",
                 window: str = DEFAULTS.window, slide: str = DEFAULTS.slide,
                 pane_s: int = DEFAULTS.pane_seconds,
                 exclude_bots: bool = DEFAULTS.exclude_bots) -> DataFrame:
    """Same result as :func:`sliding_edits`, via pre-aggregated panes (the
    direct form is used when the window or slide is not a pane multiple)."""
    if not panes_are_exact(window, slide, pane_s):
        return sliding_edits(events, time_col, window, slide, exclude_bots)
    pop = batch_population(events.select("wiki", "bot", time_col), exclude_bots)
    panes = pane_counts(pop, time_col, "wiki", pane_s)
    return flatten_window(panes_to_windows(panes, "wiki", window, slide))


def newest_day(events: DataFrame) -> DataFrame:
    """Events of the newest ``event_date``, which holds the latest event time. The date is a partition of the
    history, so it is found without reading a column and the scan of the result opens one folder.
    Frames without that column, and empty ones, are returned unchanged."""
    if "event_date" not in events.columns:
        return events
    day = events.agg(F.max("event_date")).first()[0]
    return events if day is None else events.filter(F.col("event_date") == F.lit(day))


def as_of_literal(df: DataFrame, col: str) -> Column:
    """max(col) of a frame as a TIMESTAMP literal (NULL when empty).

    Spark computes the max with a partial aggregate per task; only the single
    value (as epoch microseconds, independent of any time zone) is fetched. Of a
    history partitioned by date only the newest day's event times are read.
    """
    if col == "event_time":
        df = newest_day(df)
    v = df.agg(F.max(F.unix_micros(col))).first()[0]
    return F.timestamp_micros(F.lit(v).cast("long"))


def speed_population(events: DataFrame) -> DataFrame:
    """Rows the speed layer counts, keyed by ``group_key`` -> column ``wiki``."""
    return (events.filter(should_count())
            .select(group_key().alias("wiki"), "event_time"))


def live_events(events: DataFrame, as_of: Column,
                window_s: int = DEFAULTS.window_seconds,
                pane_s: int = DEFAULTS.pane_seconds) -> DataFrame:
    """Admitted events in the trailing window ending at ``as_of``.

    A pane is live while its start is >= ``as_of - window_s`` (so coverage is
    between window - pane and window); events after ``as_of`` are ignored.
    ``as_of`` may be a literal or a scalar subquery column. The rule is
    applied per row, so batch callers aggregate once, by key, with no pane
    stage; the streaming snapshot keeps pane counts as its state instead.
    """
    lower = as_of - F.make_interval(secs=F.lit(window_s + pane_s))
    if "event_date" in events.columns:
        # date-partitioned (bronze) history: prune partitions outside the window
        events = events.filter(F.col("event_date").between(F.to_date(lower), F.to_date(as_of)))
    # both bounds on the raw column, so that they reach the scan; the exact lower
    # bound is the pane's start, below
    pop = speed_population(events.filter(
        (F.col("event_time") >= lower) & (F.col("event_time") <= as_of)))
    start = F.window("event_time", _secs(pane_s)).start
    return pop.filter(start >= as_of - F.make_interval(secs=F.lit(window_s)))


def trailing_counts(events: DataFrame, as_of: Column,
                    window_s: int = DEFAULTS.window_seconds,
                    pane_s: int = DEFAULTS.pane_seconds) -> DataFrame:
    """Counts of all keys over the trailing window: (wiki, count)."""
    return (live_events(events, as_of, window_s, pane_s)
            .groupBy("wiki").agg(F.count(F.lit(1)).alias("count")))


def trailing_topn(events: DataFrame, as_of: Column, n: int = DEFAULTS.top_n,
                  window_s: int = DEFAULTS.window_seconds,
                  pane_s: int = DEFAULTS.pane_seconds) -> DataFrame:
    """Top-N keys over the trailing window: (wiki, count)."""
    return top_n(trailing_counts(events, as_of, window_s, pane_s), "count", "wiki", n)


def trailing_size(events: DataFrame, as_of: Column,
                  window_s: int = DEFAULTS.window_seconds,
                  pane_s: int = DEFAULTS.pane_seconds) -> DataFrame:
    """Number of events currently in the trailing window: (size)."""
    return live_events(events, as_of, window_s, pane_s).agg(
        F.count(F.lit(1)).alias("size"))


def rank_within(df: DataFrame, part: list[str], by: str, key: str, n: int,
                rank_col: str = "rank") -> DataFrame:
    """Top-N rows per partition with a 1-based dense position.

    ``row_number() <= n`` lets the optimizer insert a partial WindowGroupLimit
    before the shuffle, so each map task ships at most n rows per partition
    key even when one window holds most of the data.
    """
    w = Window.partitionBy(*part).orderBy(F.col(by).desc(), F.col(key).asc())
    return (df.withColumn(rank_col, F.row_number().over(w))
            .filter(F.col(rank_col) <= n))


def topn_per_window(windowed: DataFrame, n: int = DEFAULTS.top_n, key: str = "wiki",
                    value: str = "edits") -> DataFrame:
    """Top-N keys of every hopping window (flattened window columns)."""
    return rank_within(windowed, ["window_start", "window_end"], value, key, n)
