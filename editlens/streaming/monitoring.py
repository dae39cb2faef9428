"""Monitoring while a stream runs: sustained alarms, probe latency, top keys of
each window, and a table of every micro-batch's progress.

All are append-mode plans: a row is final when the watermark has passed its
period or window, and state is dropped there.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from editlens.config import DEFAULTS
from editlens.functions import epoch_ms, has_wiki, not_bot, should_count, to_ntz
from editlens.operators import views, windows
from editlens.plans import publish
from editlens.streaming.speed import start_query


def _secs(s: int) -> str:
    return f"{int(s)} seconds"


# --------------------------------------------------------------------- alarms

def alarm_stream(events: DataFrame, value: Column, name: str, threshold: float, periods: int,
                 period_s: int = DEFAULTS.period_seconds, clock: str = "arrival_time",
                 delay: str = DEFAULTS.watermark) -> DataFrame:
    """Streaming form of ``monitor.sustained_alarm``: (minute, <name>, breach, alarm) of every
    closed period that has rows.

    Two chained aggregates: ``value`` by aligned period, then a hop of ``periods`` periods
    that slides by one over the closed periods. A hop alarms its last period when
    all its periods are there and breach, so a missing period ends a run. Rows are
    combined map-side before the shuffle by period.
    """
    series = (events.withWatermark(clock, delay)
              .groupBy(F.window(clock, _secs(period_s)).alias("p")).agg(value.cast("double").alias("v")))
    hop = F.window(F.window_time("p"), _secs(periods * period_s), _secs(period_s))
    runs = series.groupBy(hop.alias("w")).agg(
        F.count_if(F.col("v") > F.lit(threshold)).alias("hits"),
        F.max(F.struct(F.col("p.end").alias("end"), F.col("p.start").alias("start"), "v")).alias("last"))
    return (runs.filter(F.col("last.end") == F.col("w.end"))
            .select(to_ntz(F.col("last.start")).alias("minute"), F.col("last.v").alias(name),
                    (F.col("last.v") > F.lit(threshold)).alias("breach"),
                    (F.col("hits") >= periods).alias("alarm")))


def rate_alarm_stream(events: DataFrame, threshold: float = DEFAULTS.rate_threshold,
                      periods: int = DEFAULTS.rate_periods, **kw) -> DataFrame:
    """Too many records received, ``periods`` periods in a row."""
    return alarm_stream(events, F.count(F.lit(1)), "records", threshold, periods, **kw)


def lag_alarm_stream(events: DataFrame, threshold: float = DEFAULTS.lag_threshold_ms,
                     periods: int = DEFAULTS.lag_periods, clock: str = "arrival_time",
                     event_clock: str = "event_time", **kw) -> DataFrame:
    """Worst lag too high, ``periods`` periods in a row."""
    lag = F.max(epoch_ms(clock) - epoch_ms(event_clock))
    return alarm_stream(events, lag, "max_lag_ms", threshold, periods, clock=clock, **kw)


# --------------------------------------------------------------------- probes

def probe_stream(sent: DataFrame, seen: DataFrame, timeout_ms: float = DEFAULTS.sentinel_timeout_ms,
                 burst_s: int = DEFAULTS.period_seconds) -> DataFrame:
    """Streaming form of ``monitor.sentinel_latency``, from the log of sent records and the log
    the speed layer reads: (wiki, minute, burst, burst_ms, latency_ms, found).

    Bursts (a wiki's sent events of an aligned period) are joined left-outer with the first
    sighting of the same burst. The sighting's watermark lags by the timeout: when it
    has passed a burst, none can come in time, the join lets the burst go
    without a partner, and that row is the timeout. Both sides are aggregates, so a burst
    is one row of state on each side of the join.
    """
    burst = F.window("event_time", _secs(burst_s))
    bursts = (sent.withWatermark("event_time", "0 seconds").filter(not_bot() & has_wiki())
              .groupBy(burst.alias("w"), "wiki")
              .agg(F.count(F.lit(1)).alias("burst"), F.min(F.unix_micros("event_time")).alias("first"),
                   F.max(F.unix_micros("event_time")).alias("last")))
    patience = _secs(-(-int(timeout_ms) // 1000))
    sightings = (seen.withWatermark("event_time", patience).filter(should_count() & not_bot() & has_wiki())
                 .groupBy(burst.alias("seen_w"), F.col("wiki").alias("seen_wiki"))
                 .agg(F.min(F.unix_micros("arrival_time")).alias("seen")))
    joined = bursts.join(sightings, (F.col("w") == F.col("seen_w")) & (F.col("wiki") == F.col("seen_wiki")), "left")
    waited = F.greatest((F.col("seen") - F.col("last")) / F.lit(1000.0), F.lit(0.0))
    found = F.coalesce(F.when(F.col("seen").isNotNull(), waited) <= timeout_ms, F.lit(False))
    return joined.select("wiki", to_ntz(F.col("w.start")).alias("minute"), "burst",
                         ((F.col("last") - F.col("first")) / F.lit(1000.0)).alias("burst_ms"),
                         F.when(found, waited).otherwise(F.lit(float(timeout_ms))).alias("latency_ms"),
                         found.alias("found"))


# ------------------------------------------------------- top keys of a window

def run_topn_per_window(counts: DataFrame, out: str, checkpoint: str, n: int = DEFAULTS.top_n,
                        key: str = "wiki", value: str = "edits", trigger: dict | None = None) -> StreamingQuery:
    """Top ``n`` keys of every closed window of an append-mode windowed count.

    Append mode lets all keys of a window go in the micro-batch whose watermark passed it, so the
    ranking of that batch is final. ``row_number() <= n`` cuts each task's rows to n a
    window before the shuffle; no window is collected. A retried batch rewrites
    its own folder.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        top = windows.topn_per_window(windows.flatten_window(batch, ntz=False), n, key, value)
        top.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return start_query(counts, checkpoint, "append", trigger=trigger, foreach_batch=write)


def read_topn(spark: SparkSession, out: str, key: str = "wiki", value: str = "edits") -> DataFrame:
    """(window_start, window_end, key, value, rank) of the closed windows."""
    rows = spark.read.schema(f"window_start timestamp, window_end timestamp, {key} string, {value} bigint, rank int, "
                             "batch bigint").parquet(out)
    return rows.select(to_ntz(F.col("window_start")).alias("window_start"), to_ntz(F.col("window_end")).alias("window_end"),
                       key, value, "rank")


# ------------------------------------------------------------------- progress

PROGRESS_SCHEMA = """runId string, id string, name string, batchId bigint, timestamp timestamp,
numInputRows bigint, inputRowsPerSecond double, processedRowsPerSecond double,
durationMs map<string, bigint>, eventTime map<string, string>,
sources array<struct<description: string, numInputRows: bigint>>,
observedMetrics map<string, map<string, bigint>>"""


def observe_counts(events: DataFrame, name: str = "ingest") -> DataFrame:
    """Counts rows as they pass (total, after the bot filter, kept), without a scan of their
    own; a stream reports them per micro-batch in ``observedMetrics``."""
    return events.observe(name, *views.count_columns())


class ProgressLog(StreamingQueryListener):
    """Keeps every progress record of the session's queries as a JSON table.

    ``recentProgress`` forgets all but the newest hundred; here each record is a small file
    under ``path``, named by run and batch, written through the cluster's file system.

        log = ProgressLog(spark, path); spark.streams.addListener(log)
        ... run queries ...; log.wait(query); log.read()
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._lock, self._ended = threading.Lock(), {}

    def _done(self, run_id) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._done(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        publish.write_text(self.spark, f"{self.path}/{p.runId}-{p.batchId}-{uuid.uuid4().hex[:8]}.json", p.json)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._done(event.runId).set()

    def wait(self, query: StreamingQuery, timeout_s: float = 60) -> None:
        """Events come after the fact: blocks until the ended query's last one is stored."""
        if not self._done(query.runId).wait(timeout_s):
            raise TimeoutError(f"no end of query {query.runId} reported")

    def read(self) -> DataFrame:
        """A row per progress record, as Spark reports it."""
        return self.spark.read.schema(PROGRESS_SCHEMA).option("multiLine", "true").json(self.path)


def progress_by_batch(records: DataFrame, metric: str = "ingest") -> DataFrame:
    """(batch_id, input_rows, trigger_ms, watermark and the observed counts) per micro-batch.
    A batch that was retried counts as its last run."""
    last = records.groupBy("id", "batchId").agg(F.max_by(F.struct(
        "numInputRows", "durationMs", "eventTime", "observedMetrics"), "timestamp").alias("r"))
    seen = F.col("r.observedMetrics")[metric]
    return last.select(F.col("batchId").alias("batch_id"), F.col("r.numInputRows").alias("input_rows"),
                       F.col("r.durationMs")["triggerExecution"].alias("trigger_ms"),
                       F.col("r.eventTime")["watermark"].alias("watermark"),
                       *[F.coalesce(seen[c], F.lit(0)).alias(c) for c in views.COUNT_NAMES])
