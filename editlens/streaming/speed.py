"""Speed layer on Structured Streaming.

* ``decode_envelope``   log envelope (payload + arrival time) -> records
* ``windowed_counts``   watermark + hopping window count (direct or panes)
* ``run_speed``         windowed counts -> Parquet (append) with checkpoint
* ``run_snapshot``      pane counts in Spark's state store -> trailing counts,
                        published as a new version every micro-batch
* ``dual_write``        each micro-batch to the raw history and to the log
* ``dedupe_stream``     each id of a polled feed once

Every query takes its checkpoint under the shared checkpoint folder; the
sinks are the file sink (exactly-once through its commit log) or
``foreachBatch`` writers that overwrite a batch-id path (idempotent on retry).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from editlens.config import DEFAULTS, UNKNOWN_KEY
from editlens.functions import group_key, has_wiki, not_bot, should_count
from editlens.operators import views, windows
from editlens.plans import publish
from editlens.schema import EDIT_EVENT, STREAM_PAYLOAD
from editlens.sources.feed import has_id
from editlens.sources.raw import land_raw, record_columns, sink_id, write_hours
from editlens.sources.stream import stream_source, to_log_records

TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
WIDTH = "spark.sql.shuffle.partitions"


# ------------------------------------------------------------------ decoding

def envelope(events: DataFrame) -> DataFrame:
    """Rows -> log envelope (what a producer puts on the stream)."""
    payload = F.to_json(F.struct(*[F.col(f.name) for f in STREAM_PAYLOAD.fields]))
    return events.select(payload.cast("binary").alias("data"),
                         F.col("arrival_time").alias("approximateArrivalTimestamp"))


#: payload and clock columns of the envelope shapes of log connectors
ENVELOPES = (("data", "approximateArrivalTimestamp"), ("value", "timestamp"))


def decode_envelope(env: DataFrame) -> DataFrame:
    """Log records of either shape (managed log: data, approximateArrivalTimestamp;
    Kafka: value, timestamp) -> the record's columns with both clocks set to the
    log's arrival time.

    Nothing is filtered: a payload that is no JSON object gives a record of nulls,
    which each layer's own population rule then admits or drops.
    """
    shape = next(((p, c) for p, c in ENVELOPES if {p, c} <= set(env.columns)), None)
    if shape is None:
        raise ValueError(f"not a log envelope: {env.columns}")
    payload, clock = (F.col(c) for c in shape)
    record = F.from_json(payload.cast("string"), STREAM_PAYLOAD)
    arrived = clock.cast("timestamp")
    return env.withColumns({"_record": record, "event_time": arrived, "arrival_time": arrived}).select(
        *[F.col("_record")[f.name].alias(f.name) for f in STREAM_PAYLOAD.fields], "event_time", "arrival_time")


def with_clocks(events: DataFrame) -> DataFrame:
    """Plain records carry only ``timestamp`` (epoch seconds): it stands for the
    event time where that is absent, and the event time for the arrival time."""
    recorded = F.timestamp_seconds("timestamp")
    event = F.coalesce("event_time", recorded) if "event_time" in events.columns else recorded
    out = events.withColumn("event_time", event)
    arrival = F.coalesce("arrival_time", "event_time") if "arrival_time" in events.columns else F.col("event_time")
    return out.withColumn("arrival_time", arrival)


# ------------------------------------------------------------------ windowing

def windowed_counts(events: DataFrame, time_col: str = "event_time",
                    window: str = DEFAULTS.window, slide: str = DEFAULTS.slide,
                    watermark: str = DEFAULTS.watermark, panes: bool = False,
                    pane_s: int = DEFAULTS.pane_seconds,
                    exclude_bots: bool = DEFAULTS.exclude_bots) -> DataFrame:
    """Streaming per-wiki hopping-window counts (append-safe).

    ``panes=True`` chains a tumbling pane count into the hop (two stateful
    operators; append mode only). Output: window struct, wiki, edits.
    """
    pop = views.batch_population(events, exclude_bots).withWatermark(time_col, watermark)
    if panes and windows.panes_are_exact(window, slide, pane_s):
        return windows.panes_to_windows(windows.pane_counts(pop, time_col, "wiki", pane_s),
                                        "wiki", window, slide)
    return windows.sliding_counts(pop, time_col, "wiki", window, slide)


def start_query(stream: DataFrame, checkpoint: str, output_mode: str, sink: str | None = None,
                path: str | None = None, trigger: dict | None = None,
                foreach_batch=None, options: dict[str, str] | None = None,
                state_partitions: int | None = None) -> StreamingQuery:
    """writeStream with a checkpoint, a file sink or a foreachBatch writer, and
    a trigger (processing time by default).

    ``state_partitions`` is the width of a new checkpoint's state, at most the session's shuffle partitions
    (the default). Every partition is committed by every micro-batch, whatever rows it has.
    """
    w = (stream.writeStream.outputMode(output_mode)
         .option("checkpointLocation", checkpoint).options(**(options or {})))
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(sink or "parquet")
        if path is not None:
            w = w.option("path", path)
    w = w.trigger(**(trigger or {"processingTime": DEFAULTS.trigger}))
    if state_partitions is None:
        return w.start()
    conf = stream.sparkSession.conf
    was, most = conf.get(WIDTH, None), int(conf.get(WIDTH))
    conf.set(WIDTH, min(most, state_partitions))
    try:
        return w.start()             # the query keeps the settings it starts with
    finally:
        conf.unset(WIDTH) if was is None else conf.set(WIDTH, was)


def run_speed(events: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
              panes: bool = False, watermark: str = DEFAULTS.watermark,
              window: str = DEFAULTS.window, slide: str = DEFAULTS.slide,
              exclude_bots: bool = DEFAULTS.exclude_bots) -> StreamingQuery:
    """Windowed counts appended to Parquet; a window is written once the
    watermark passes its end."""
    stream = windowed_counts(events, window=window, slide=slide, panes=panes, watermark=watermark,
                             exclude_bots=exclude_bots)
    return start_query(stream, checkpoint, "append", "parquet", out, trigger)


def publish_each_batch(spark: SparkSession, out: str):
    """foreachBatch writer that publishes the batch as the new version of ``out``
    (complete mode); readers of the version before are not disturbed."""
    def write(batch: DataFrame, batch_id: int) -> None:
        publish.publish(spark, batch, out, batch_id)
    return write


def is_windowed(df: DataFrame) -> bool:
    """Some column is a time window."""
    return any(isinstance(f.dataType, StructType) and f.dataType.names == ["start", "end"] for f in df.schema)


def run_complete(stream: DataFrame, out: str | None, checkpoint: str,
                 trigger: dict | None = None, sink: str = "parquet", bounded: bool = False) -> StreamingQuery:
    """Complete-mode aggregate; ``publish.current`` reads the newest version
    (``sink="console"`` prints it instead, for live demos).

    The whole result is state and is rewritten per trigger, so windows, which never stop
    coming, are refused unless the caller says that the stream is ``bounded``: use
    ``run_speed`` for them.
    """
    if sink == "console":
        return start_query(stream, checkpoint, "complete", "console", trigger=trigger,
                           options={"truncate": "false"})
    if is_windowed(stream) and not bounded:
        raise ValueError("complete mode keeps and rewrites every window for ever; append them with run_speed")
    return start_query(stream, checkpoint, "complete", trigger=trigger,
                       foreach_batch=publish_each_batch(stream.sparkSession, out))


def top_wikis_complete(events: DataFrame, n: int = DEFAULTS.top_n) -> DataFrame:
    """Running top-N wikis of the whole stream (complete mode only)."""
    counts = (views.batch_population(events).groupBy("wiki")
              .agg(F.count(F.lit(1)).alias("edits")))
    return views.top_n(counts, "edits", "wiki", n)


# ------------------------------------------------------------------- snapshot

def pane_stream(events: DataFrame, window_s: int = DEFAULTS.window_seconds,
                pane_s: int = DEFAULTS.pane_seconds) -> DataFrame:
    """Running count of admitted events per (pane, wiki), kept by Spark's state store
    until the pane has left the trailing window (watermark = window + pane).

    An event dated after its arrival counts at its arrival: the log's clock, which
    no single record can move, bounds the event time before the watermark. Events that are
    not admitted only move the clock: those of a pane share one row of the state.
    """
    clocked = (with_clocks(events).withColumn("event_time", F.least("event_time", "arrival_time"))
               .withColumn("counted", should_count())
               .withColumn("wiki", F.when(F.col("counted"), group_key()).otherwise(F.lit(UNKNOWN_KEY))))
    return (clocked.withWatermark("event_time", f"{window_s + pane_s} seconds")
            .groupBy(F.window("event_time", f"{pane_s} seconds").alias("pane"), "wiki")
            .agg(F.count_if("counted").alias("count"), F.max("event_time").alias("last")))


def state_panes(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """(pane_start, wiki, count, last) of every pane in the state of a ``pane_stream`` query, as of
    a micro-batch (default: the last committed one), read from its checkpoint."""
    r = spark.read.format("statestore")
    if batch_id is not None:
        r = r.option("batchId", batch_id)
    return r.load(checkpoint).select(F.col("key.window.start").alias("pane_start"), "key.wiki", "value.count",
                                     F.col("value.max").alias("last"))


def in_reach(as_of: Column, window_s: int) -> Column:
    """The pane is in the trailing window that ends at ``as_of``."""
    return F.col("pane_start") >= as_of - F.make_interval(secs=F.lit(window_s))


def live_panes(panes: DataFrame, window_s: int = DEFAULTS.window_seconds, as_of: Column | None = None) -> DataFrame:
    """(wiki, count) over the panes that are live at the newest event (default: of the panes)."""
    if as_of is None:
        as_of = windows.as_of_literal(panes, "last")
    return (panes.where(in_reach(as_of, window_s) & (F.col("count") > 0))
            .groupBy("wiki").agg(F.sum("count").cast("long").alias("count")))


def snapshot_writer(spark: SparkSession, checkpoint: str, snapshot_path: str,
                    window_s: int = DEFAULTS.window_seconds):
    """foreachBatch body of the snapshot, over ``pane_stream`` in update mode.

    The panes of a micro-batch are the state that the one before committed, with those
    the batch changed in their place: counts only grow, so the larger one is newer. The sum
    over the live ones is published as the version of that batch (a retried batch
    rewrites its own; a batch that changes nothing leaves the version before). Nothing but the state store holds panes.

    The state is read once. Panes that have left the window at the batch's own newest event go
    before anything is shuffled: a micro-batch may be far longer than the window.
    """
    from editlens.plans.serving import write_snapshot

    def newest(panes: DataFrame) -> tuple[int | None, int]:
        """Newest event (epoch microseconds) and number of rows."""
        return tuple(panes.agg(F.max(F.unix_micros("last")), F.count(F.lit(1))).first())

    def write(batch: DataFrame, batch_id: int) -> None:
        panes = changed = batch.select(F.col("pane.start").alias("pane_start"), "wiki", "count", "last").persist()
        before = None
        try:
            at, rows = newest(changed)
            if at is None and batch_id > 0 and publish.versions(spark, snapshot_path):
                return
            if batch_id > 0:
                before = state_panes(spark, checkpoint, batch_id - 1)
                if at is not None:
                    before = before.where(in_reach(F.timestamp_micros(F.lit(at)), window_s))
                panes = before.persist().unionByName(changed)
                last, more = newest(before)
                at, rows = max((t for t in (at, last) if t is not None), default=None), rows + more
            as_of = F.timestamp_micros(F.lit(at).cast("long"))
            # one shuffle, by wiki (at most two rows for each pane of the window), as wide as the rows ask for
            panes = (panes.where(in_reach(as_of, window_s)).repartition(max(1, -(-rows // DEFAULTS.landed_rows)), "wiki")
                     .groupBy("pane_start", "wiki").agg(F.max("count").alias("count")))
            write_snapshot(live_panes(panes, window_s, as_of), snapshot_path, window_s, version=batch_id)
        finally:
            changed.unpersist()
            if before is not None:
                before.unpersist()
    return write


def run_snapshot(spark: SparkSession, events: DataFrame, snapshot_path: str, checkpoint: str,
                 window_s: int = DEFAULTS.window_seconds, pane_s: int = DEFAULTS.pane_seconds,
                 trigger: dict | None = None, state_partitions: int | None = None) -> StreamingQuery:
    return start_query(pane_stream(events, window_s, pane_s), checkpoint, "update", trigger=trigger,
                       foreach_batch=snapshot_writer(spark, checkpoint, snapshot_path, window_s),
                       state_partitions=state_partitions)


def state_width(files: int) -> int:
    """State partitions of a ``pane_stream`` whose micro-batch is so many landed files: a file's rows or less
    come to each, so their number follows the rows of a micro-batch."""
    return max(DEFAULTS.state_partitions, files)


# ------------------------------------------------------------ dual write etc.

def dual_writer(raw_path: str, log_path: str, ident: str = "", clock: str = "arrival_time",
                rows_per_writer: int = DEFAULTS.landed_rows):
    """foreachBatch: persist the batch once, write whole records to the raw history
    (JSON by hour, an hour spread over writers) and keyed (key, value) records to the stream log, each
    under its batch id."""
    def write(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist()
        try:
            write_hours(b, raw_path, f"{ident}-{batch_id}", clock, rows_per_writer=rows_per_writer)
            to_log_records(b, payload_cols=record_columns(b)).write.mode("overwrite") \
                .parquet(f"{log_path}/batch_id={ident}-{batch_id}")
        finally:
            b.unpersist()
    return write


def run_dual_write(events: DataFrame, raw_path: str, log_path: str, checkpoint: str,
                   trigger: dict | None = None, **kw) -> StreamingQuery:
    ident = sink_id(events.sparkSession, checkpoint)
    return start_query(events, checkpoint, "append", trigger=trigger,
                       foreach_batch=dual_writer(raw_path, log_path, ident, **kw))


def dedupe_stream(items: DataFrame, id_col: str = "id", time_col: str | None = None,
                  delay: str | None = None) -> DataFrame:
    """Emit each id once, ever: the ids seen are state (RocksDB, on disk). Items
    without an id are skipped.

    With ``time_col`` and ``delay`` state is bounded instead: an id is
    remembered only that long, and comes out again if it returns later.
    """
    kept = items.filter(has_id(id_col))
    if delay is None:
        return kept.dropDuplicates([id_col])
    return kept.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([id_col])


def admitted(events: DataFrame) -> DataFrame:
    """Batch-layer population for stateless replays."""
    return events.filter(not_bot() & has_wiki())


def land_events(events: DataFrame, path: str, clock: str = "arrival_time") -> None:
    """Land full edit events (both clocks, microsecond precision) as JSON
    files, one folder per arrival day -- the input a file-source replay or a
    test stream reads."""
    (events.withColumn("date", F.to_date(clock))
     .hint("rebalance", "date").write.mode("overwrite").partitionBy("date")
     .option("timestampFormat", TS_FORMAT).json(path))


def land_in_waves(events: DataFrame, path: str, waves: int = 4, clock: str = "event_time",
                  rows_per_file: int = DEFAULTS.landed_rows) -> int:
    """Land events in time order, one wave after the other, each an equal share of the
    time span in as many files as the rows ask for. Returns the files of a wave: with
    that as ``max_files`` a micro-batch is a wave."""
    lo, hi, rows = events.agg(F.min(clock), F.max(clock), F.count(F.lit(1))).first()
    files = max(2, -(-rows // (waves * rows_per_file)))
    if lo is None:
        return files
    step = (hi - lo) / waves
    for w in range(waves):
        at = F.col(clock)
        wave = at >= F.lit(lo + w * step)
        if w + 1 < waves:
            wave &= at < F.lit(lo + (w + 1) * step)
        (events.filter(wave).repartition(files, F.xxhash64("id")).write.mode("append")
         .option("timestampFormat", TS_FORMAT).json(path))
    return files


def raw_waves(events: DataFrame, clock: str = "event_time", max_files: int = DEFAULTS.max_files,
              records: int = DEFAULTS.raw_file_records) -> list[Column]:
    """Filters that cut the events into ranges of whole hours, in time order, of about
    ``max_files`` raw files each (an hour above that is a range). The driver sees a
    row per hour. Events without a time are in the first range."""
    hour = F.floor(F.unix_micros(clock) / F.lit(HOUR_US))
    counts = events.filter(F.col(clock).isNotNull()).groupBy(hour.alias("h")).count().collect()
    ranges = hour_ranges([(r["h"], -(-r["count"] // records)) for r in counts], max_files)
    if len(ranges) < 2:
        return [F.lit(True)]
    at = lambda h: F.timestamp_micros(F.lit(h * HOUR_US).cast("long"))
    t = F.col(clock)               # bounds on the raw column, so that they reach the scan
    return [(t < at(ranges[0][1])) | t.isNull(), *[(t >= at(a)) & (t < at(b)) for a, b in ranges[1:-1]],
            t >= at(ranges[-1][0])]


HOUR_US = 3_600_000_000


def hour_ranges(sizes: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """[first hour, hour after the last) of consecutive ranges of at most ``most`` in size (an hour
    above that is a range)."""
    out: list[list[int]] = []
    size = 0
    for h, n in sorted(sizes):
        if not out or size + n > most:
            out.append([h, h + 1])
            size = 0
        out[-1][1] = h + 1
        size += n
    return [(a, b) for (a, _), (b, _) in zip(out, out[1:])] + [tuple(r) for r in out[-1:]]


STAGED = StructType(EDIT_EVENT.fields + [StructField(c, LongType(), True) for c in ("hour", "day")])


def replay_files(spark: SparkSession, stream: DataFrame, out: str, checkpoint: str,
                 range_rows: int = DEFAULTS.max_files * DEFAULTS.landed_rows, **kw) -> int:
    """Drain a stream of landed files through the windowed job in time order, whatever order
    the files have; returns the number of ranges.

    A stateless stream first copies what is new to Parquet by day of the event time (a
    run; files are taken exactly once, a bounded number per micro-batch). The run's hours are then
    landed range after range, each read from its own days' folders, and the windowed
    job takes each range as one micro-batch from one checkpoint. So the watermark never passes a row of
    the run, and state holds the open windows of one range. Rows of a later run that
    are older than the watermark are late and dropped, as on a live stream. Everything lies under ``checkpoint``; a
    run that was broken off goes on where it stopped: nothing is staged into it any
    more, complete ranges are not landed again.
    """
    base = f"{checkpoint}/replay"
    run = 0
    while publish.exists(spark, f"{base}/run-{run}.done"):
        run += 1
    staged = f"{base}/run-{run}"
    if not publish.exists(spark, f"{staged}.staged"):
        hour = F.floor(F.unix_micros("event_time") / F.lit(HOUR_US)).cast("long")
        rows = stream.select(*[f.name for f in EDIT_EVENT.fields], hour.alias("hour"),
                             F.floor(hour / 24).cast("long").alias("day"))

        def stage(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").partitionBy("day").parquet(f"{staged}/batch={batch_id}")

        run_to_end(start_query(rows, f"{checkpoint}/stage", "append", trigger={"availableNow": True}, foreach_batch=stage))
        publish.write_text(spark, f"{staged}.staged", "")
    ranges = []
    if publish.exists(spark, staged):
        rows = spark.read.schema(STAGED).parquet(staged).where(F.col("hour").isNotNull())
        ranges = hour_ranges([(r["hour"], r["count"]) for r in rows.groupBy("hour").count().collect()], range_rows)
    for k, (lo, hi) in enumerate(ranges):
        land = f"{base}/ordered/{run}-{k}"
        if not publish.exists(spark, f"{land}/_SUCCESS"):
            mine = (F.col("hour") >= lo) & (F.col("hour") < hi) & F.col("day").between(lo // 24, (hi - 1) // 24)
            rows.where(mine).drop("hour", "day", "batch").write.mode("overwrite").parquet(land)
        src = stream_source(spark, "parquet", f"{base}/ordered", EDIT_EVENT, {"recursiveFileLookup": "true"})
        run_to_end(run_speed(src, out, f"{checkpoint}/windows", {"availableNow": True}, **kw))
    publish.write_text(spark, f"{staged}.done", "")
    return len(ranges)


def replay_raw(spark: SparkSession, events: DataFrame, raw: str, out: str, checkpoint: str, clock: str = "event_time",
               max_files: int = DEFAULTS.max_files, **kw) -> None:
    """Land the events as raw history and run the windowed job over it, a range of
    hours after the other from one checkpoint: a micro-batch is a whole range, so none
    has rows below the watermark that an earlier one left, however many files there are."""
    for wave in raw_waves(events, clock, max_files):
        land_raw(events.filter(wave), raw, clock=clock, mode="append")
        run_to_end(run_speed(read_events_stream(spark, raw, max_files=None), out, checkpoint, {"availableNow": True}, **kw))


def read_events_stream(spark: SparkSession, path: str, max_files: int | None = DEFAULTS.max_files) -> DataFrame:
    """Stream of landed records: edit events with both clocks, or plain raw history
    (whose ``timestamp`` becomes the event time)."""
    opts = {"timestampFormat": TS_FORMAT}
    if max_files:
        opts["maxFilesPerTrigger"] = str(int(max_files))
    return with_clocks(stream_source(spark, "json", path, EDIT_EVENT, opts))


def run_to_end(q: StreamingQuery, timeout_s: float | None = None) -> None:
    """Block until an availableNow query has drained its input; surface errors."""
    q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def arguments(argv: list[str]):
    import argparse

    p = argparse.ArgumentParser(prog="editlens.streaming.speed", description="Speed-layer jobs.")
    p.add_argument("mode", choices=("windowed", "snapshot"))
    p.add_argument("source", help="folder of landed files (ignored by log connectors)")
    p.add_argument("out")
    p.add_argument("checkpoint")
    p.add_argument("--available-now", action="store_true", help="drain what is there, then stop")
    p.add_argument("--window", default=DEFAULTS.window)
    p.add_argument("--slide", default=DEFAULTS.slide)
    p.add_argument("--watermark", default=DEFAULTS.watermark)
    p.add_argument("--include-bots", action="store_true", help="windowed mode: count bots too")
    p.add_argument("--panes", action="store_true", help="pre-aggregate panes before the hop")
    p.add_argument("--max-files", type=int, default=DEFAULTS.max_files, help="files per micro-batch")
    p.add_argument("--state-partitions", type=int, default=None,
                   help="snapshot mode: width of a new checkpoint's state (default: the session's shuffle partitions)")
    p.add_argument("--format", default="json", help="json, parquet or a log connector's name")
    p.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="source option")
    return p.parse_args(argv)


def main(argv: list[str]) -> None:
    """spark-submit -m editlens.streaming.speed windowed|snapshot <in> <out> <checkpoint> [options]

    With ``--available-now`` the windowed job drains landed files in time order (``replay_files``);
    run it again for what has landed since."""
    from editlens.session import build_session

    a = arguments(argv[1:])
    spark = build_session(app=f"editlens-speed-{a.mode}")
    opts = dict(o.split("=", 1) for o in a.option)
    if a.format == "json":
        stream = read_events_stream(spark, a.source, a.max_files)
    elif a.format == "parquet":
        stream = with_clocks(stream_source(spark, "parquet", a.source, EDIT_EVENT,
                                           {"maxFilesPerTrigger": str(a.max_files)} | opts))
    else:
        stream = decode_envelope(stream_source(spark, a.format, None, None, opts))
    trigger = {"availableNow": True} if a.available_now else None
    if a.mode == "windowed" and a.available_now and a.format in ("json", "parquet"):
        replay_files(spark, stream, a.out, a.checkpoint, panes=a.panes, watermark=a.watermark, window=a.window,
                     slide=a.slide, exclude_bots=not a.include_bots)
        spark.stop()
        return
    if a.mode == "windowed":
        q = run_speed(stream, a.out, a.checkpoint, trigger, a.panes, a.watermark, a.window, a.slide,
                      not a.include_bots)
    else:
        q = run_snapshot(spark, stream, f"{a.out}/snapshot", a.checkpoint,
                         windows.duration_seconds(a.window), trigger=trigger, state_partitions=a.state_partitions)
    run_to_end(q)
    spark.stop()


if __name__ == "__main__":
    import sys
    main(sys.argv)
