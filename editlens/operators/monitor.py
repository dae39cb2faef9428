"""Ingest monitoring: per-period rates, bytes, lag, sustained alarms,
sentinel latency and run speed-up -- all as DataFrame aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editlens.config import DEFAULTS
from editlens.functions import (
    epoch_ms,
    has_wiki,
    minute_start,
    not_bot,
    should_count,
    to_ntz,
)
from editlens.schema import EVENT_SCHEMA


def _period(ts: str, seconds: int) -> Column:
    return to_ntz(minute_start(ts, seconds))


def records_per_period(events: DataFrame, clock: str = "arrival_time",
                       seconds: int = DEFAULTS.period_seconds) -> DataFrame:
    """(minute, records): records received per aligned period, by ``clock``."""
    return (events.groupBy(_period(clock, seconds).alias("minute"))
            .agg(F.count(F.lit(1)).alias("records")))


def bytes_per_period(events: DataFrame, clock: str = "arrival_time",
                     seconds: int = DEFAULTS.period_seconds) -> DataFrame:
    """(minute, bytes): serialized JSON payload bytes per period."""
    payload = F.to_json(F.struct(*[F.col(f.name) for f in EVENT_SCHEMA.fields]))
    return (events.groupBy(_period(clock, seconds).alias("minute"))
            .agg(F.sum(F.octet_length(payload)).cast("long").alias("bytes")))


def lag_per_period(events: DataFrame, clock: str = "arrival_time",
                   event_clock: str = "event_time",
                   seconds: int = DEFAULTS.period_seconds) -> DataFrame:
    """(minute, max_lag_ms): worst ingest lag per period."""
    lag = epoch_ms(clock) - epoch_ms(event_clock)
    return (events.groupBy(_period(clock, seconds).alias("minute"))
            .agg(F.max(lag).alias("max_lag_ms")))


def throughput_summary(series: DataFrame, time_col: str = "minute",
                       value: str = "records") -> DataFrame:
    """Peak and latest period of a per-period series, in one aggregate."""
    return series.agg(
        F.count(F.lit(1)).alias("periods"),
        F.max(value).alias("peak"),
        F.max(F.struct(F.col(value), F.col(time_col)))[time_col].alias("peak_at"),
        F.max(time_col).alias("latest_at"),
        F.max(F.struct(F.col(time_col), F.col(value)))[value].alias("latest"),
    )


def sustained_alarm(series: DataFrame, threshold: float, periods: int,
                    period_s: int = DEFAULTS.period_seconds, time_col: str = "minute",
                    value: str = "records") -> DataFrame:
    """Alarm when ``value > threshold`` in ``periods`` consecutive periods.

    A missing period counts as not breaching. Each breaching period
    contributes one hit to itself and the next ``periods - 1`` periods;
    a period alarms when it collects ``periods`` hits. This is one
    aggregate keyed by period -- distributed over the series, unlike an
    un-partitioned window frame that would funnel it into one task.
    Output: (<time_col>, <value>, breach, alarm) for every period present.
    """
    step = F.make_interval(secs=F.lit(int(period_s)))
    s = series.select(F.col(time_col).alias("t"), F.col(value).alias("v"),
                      (F.col(value) > F.lit(threshold)).alias("breach"))
    own = s.select("t", "v", "breach", F.lit(1).alias("own"), F.lit(0).alias("hit"))
    hits = (s.filter("breach")
            .select(F.explode(F.sequence(F.lit(0), F.lit(periods - 1))).alias("i"), "t")
            .select((F.col("t") + step * F.col("i")).alias("t"),
                    F.lit(None).cast("double").alias("v"),
                    F.lit(None).cast("boolean").alias("breach"),
                    F.lit(0).alias("own"), F.lit(1).alias("hit")))
    g = (own.withColumn("v", F.col("v").cast("double")).unionByName(hits)
         .groupBy("t")
         .agg(F.max("own").alias("own"), F.max("v").alias("v"),
              F.max("breach").alias("breach"), F.sum("hit").alias("hits")))
    return (g.filter(F.col("own") == 1)
            .select(F.col("t").alias(time_col), F.col("v").alias(value), "breach",
                    (F.col("hits") >= periods).alias("alarm")))


def sentinel_latency(events: DataFrame, timeout_ms: float = DEFAULTS.sentinel_timeout_ms,
                     burst_s: int = DEFAULTS.period_seconds) -> DataFrame:
    """Latency of probe bursts: (wiki, minute, burst, burst_ms, latency_ms, found).

    A probe is one wiki's events (no bots) of one aligned period. Its clock starts
    when the burst has been sent, at its last event; it is seen when the first
    row of that burst that the speed layer admits arrives (before the end of the
    burst: latency 0). Not seen, or seen after ``timeout_ms``: latency
    ``timeout_ms`` and found = false. Sent and seen rows share their key, so this
    is one scan and one aggregate of conditional extremes.
    """
    sent = not_bot() & has_wiki()
    b = (events.filter(sent).groupBy("wiki", _period("event_time", burst_s).alias("minute"))
         .agg(F.count(F.lit(1)).alias("burst"),
              F.min(F.unix_micros("event_time")).alias("_first"), F.max(F.unix_micros("event_time")).alias("_last"),
              F.min(F.when(should_count(), F.unix_micros("arrival_time"))).alias("_seen")))
    waited = F.greatest((F.col("_seen") - F.col("_last")) / F.lit(1000.0), F.lit(0.0))
    found = F.coalesce(F.when(F.col("_seen").isNotNull(), waited) <= timeout_ms, F.lit(False))
    return b.select("wiki", "minute", "burst", ((F.col("_last") - F.col("_first")) / F.lit(1000.0)).alias("burst_ms"),
                    F.when(found, waited).otherwise(F.lit(float(timeout_ms))).alias("latency_ms"), found.alias("found"))


def speedup(runs: DataFrame, workers: str = "workers", runtime: str = "runtime_s") -> DataFrame:
    """base / t per run, base = the run with the fewest workers.

    The run table has one row per measured configuration (a handful), so the
    un-partitioned window is bounded by construction.
    """
    w = Window.orderBy(F.col(workers)).rowsBetween(Window.unboundedPreceding, 0)
    return runs.select(workers, runtime,
                       (F.first(runtime).over(w) / F.col(runtime)).alias("speedup"))


def progress_frame(spark, query) -> DataFrame:
    """Per-micro-batch metrics of a live streaming query as a DataFrame:
    (batch_id, timestamp, input_rows, input_rows_per_s, processed_rows_per_s,
    trigger_ms, watermark). Built from ``query.recentProgress`` -- a short,
    bounded history kept by Spark on the driver."""
    rows = []
    for p in query.recentProgress:
        rows.append((int(p["batchId"]), str(p["timestamp"]), int(p["numInputRows"]),
                     float(p.get("inputRowsPerSecond") or 0.0),
                     float(p.get("processedRowsPerSecond") or 0.0),
                     int(p["durationMs"].get("triggerExecution", 0)),
                     (p.get("eventTime") or {}).get("watermark")))
    schema = ("batch_id long, timestamp string, input_rows long, input_rows_per_s double, "
              "processed_rows_per_s double, trigger_ms long, watermark string")
    return spark.createDataFrame(rows, schema).withColumn(
        "timestamp", F.to_timestamp("timestamp"))
