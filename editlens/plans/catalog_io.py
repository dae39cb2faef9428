"""Catalog entries that go through storage: view tables, raw JSONL history,
CSV export, and the Structured Streaming jobs (file source, availableNow).

Each call works in a fresh folder under the shared checkpoint root
(``spark.checkpoint.dir``), runs its job to completion and returns a read of
what the job wrote.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from editlens.config import DEFAULTS
from editlens.functions import to_ntz
from editlens.operators import merge, views, windows
from editlens.plans import batch as batch_job
from editlens.plans import incremental, publish, serving
from editlens.plans.catalog import (
    ORACLE_SQL, PANE_S, RATE_PERIOD_S, RATE_PERIODS, RATE_THRESHOLD, TOP, TRAIL_S, _BATCH_ALL, _LIVE, _MERGE_SQL, _PAYLOAD_SQL, _SLIDING_SQL, _SPEED_ALL, _SPEED_TOP, _TRAIL_SQL,
    _batch_and_speed, _clocked, _dense, _DENSE_TIME, query,
)
from editlens.plans.oracle import hour_expr, tokens_expr, with_edits
from editlens.schema import EVENT_SCHEMA
from editlens.session import fresh_dir
from editlens.sources import (
    dedupe_by_id, edit_events, explode_features, land_raw, raw_inventory, scan_jsonl, scan_jsonl_strict,
    to_log_records,
)
from editlens.sources.feed import FEATURE_FEED
from editlens.sources.jsonl import record_counts_jsonl
from editlens.sources.raw import PARTS
from editlens.streaming import monitoring, panes, speed

EVENT_COLS = [f.name for f in EVENT_SCHEMA.fields]
_EVENT_SQL_COLS = 'wiki, title, type, bot, "timestamp", "user", namespace, id'
AVAILABLE_NOW = {"availableNow": True}


# ------------------------------------------------------------ serving tables

_TOP_WIKIS_SQL = """
SELECT wiki, count(*) AS edits FROM pop GROUP BY wiki ORDER BY edits DESC, wiki ASC LIMIT 10"""


MERGE_BUCKETS = 8       # the driver tables are small


def _db() -> str:
    """A database of its own for each run: runs do not drop each other's tables."""
    return f"editlens_{uuid.uuid4().hex[:12]}"


@query("batch_view_topn", with_edits(_TOP_WIKIS_SQL))
def q_batch_view_topn(spark, sf):
    """Batch view written, registered as an external table, read back with
    ORDER BY edits DESC LIMIT n."""
    out = fresh_dir(spark, "views")
    path = f"{out}/wiki_edits"
    batch_job.write_view(views.wiki_counts(edit_events(spark, sf)), path)
    (table,) = serving.register_views(spark, _db(), {"wiki_edits_topn": path})
    return serving.table_topn(spark, table, TOP)


@query("register_views", with_edits(f"""
SELECT 'wiki_edits' AS view, wiki AS key, count(*) AS n FROM pop GROUP BY wiki
UNION ALL SELECT 'keywords', kw, count(*) FROM (SELECT unnest({tokens_expr('title')}) AS kw FROM pop) GROUP BY kw
UNION ALL SELECT 'hourly', {hour_expr('"timestamp"')}, count(*) FROM pop GROUP BY 2
UNION ALL SELECT 'edit_types', type, count(*) FROM pop GROUP BY type
UNION ALL SELECT 'namespaces', CAST(namespace AS VARCHAR), count(*) FROM pop GROUP BY 2"""))
def q_register_views(spark, sf):
    """The batch job end to end: five views written, registered and read back whole."""
    paths = batch_job.run_batch(spark, edit_events(spark, sf), fresh_dir(spark, "views"))
    db = _db()
    tables = serving.register_views(spark, db, paths)
    return _long({t.split(".", 1)[1]: spark.table(t) for t in tables})


def _long(tables: dict):
    """(view, key, n) of several view tables."""
    res = None
    for name, df in tables.items():
        part = df.select(F.lit(name).alias("view"), df[df.columns[0]].cast("string").alias("key"),
                         df[df.columns[1]].alias("n"))
        res = part if res is None else res.unionByName(part)
    return res


@query("batch_incremental", ORACLE_SQL["register_views"])
def q_batch_incremental(spark, sf):
    """Two landings of raw history, the second one partly into a day that is there already; the
    second run counts the changed days only."""
    ev, raw, out = edit_events(spark, sf), fresh_dir(spark, "raw"), fresh_dir(spark, "incremental")
    lo, hi = ev.agg(F.min("arrival_time"), F.max("arrival_time")).first()
    cut = F.col("arrival_time") < F.lit(lo + (hi - lo) * 0.55)
    for part, mode in ((cut, "overwrite"), (~cut, "append")):
        land_raw(ev.filter(part), raw, mode=mode)
        paths = incremental.run_incremental(spark, raw, out)
    return _long({name: spark.read.parquet(p) for name, p in paths.items()})


@query("batch_job_counts", ORACLE_SQL["record_counts"])
def q_batch_job_counts(spark, sf):
    """What the batch job read and kept, observed in the pass that writes the views."""
    out = fresh_dir(spark, "views")
    batch_job.run_batch(spark, edit_events(spark, sf), out)
    return batch_job.read_counts(spark, out)


@query("merged_view", with_edits(_MERGE_SQL, _LIVE, _BATCH_ALL, _SPEED_ALL))
def q_merged_view(spark, sf):
    """Serving path end to end: batch view table (history up to the cutoff)
    + published speed snapshot, both with all keys, merged and cut."""
    batch, speed_counts = _batch_and_speed(spark, sf)
    out = fresh_dir(spark, "serving")
    batch_job.write_view(batch, f"{out}/wiki_edits")
    (table,) = serving.register_views(spark, _db(), {"wiki_edits_cutoff": f"{out}/wiki_edits"})
    serving.write_snapshot(speed_counts, f"{out}/snapshot", TRAIL_S)
    return serving.merged_view(spark, table, f"{out}/snapshot", TOP)


@query("merged_bucketed", with_edits(_MERGE_SQL, _LIVE, _BATCH_ALL, _SPEED_ALL))
def q_merged_bucketed(spark, sf):
    """Both views as tables bucketed by wiki, merged without an exchange."""
    batch, speed_counts = _batch_and_speed(spark, sf)
    out, db = fresh_dir(spark, "serving"), _db()
    serving.write_bucketed(batch, f"{db}.wiki_edits", f"{out}/wiki_edits", buckets=MERGE_BUCKETS)
    serving.write_bucketed(speed_counts, f"{db}.speed", f"{out}/speed", buckets=MERGE_BUCKETS)
    return serving.merged_bucketed(spark, f"{db}.wiki_edits", f"{db}.speed", TOP)


@query("merged_view_batch_only", with_edits("""
SELECT wiki, edits AS edits_merged FROM batch_all ORDER BY edits_merged DESC, wiki ASC LIMIT 10""", _BATCH_ALL))
def q_merged_view_batch_only(spark, sf):
    """No snapshot published yet."""
    batch, _ = _batch_and_speed(spark, sf)
    out = fresh_dir(spark, "serving")
    batch_job.write_view(batch, f"{out}/wiki_edits")
    (table,) = serving.register_views(spark, _db(), {"wiki_edits_cutoff": f"{out}/wiki_edits"})
    return serving.merged_view(spark, table, f"{out}/snapshot", TOP)


@query("merged_view_speed_only", with_edits("""
SELECT wiki, count AS edits_merged FROM speed_all ORDER BY edits_merged DESC, wiki ASC LIMIT 10""", _LIVE, _SPEED_ALL))
def q_merged_view_speed_only(spark, sf):
    """No batch view yet."""
    _, speed_counts = _batch_and_speed(spark, sf)
    out = fresh_dir(spark, "serving")
    serving.write_snapshot(speed_counts, f"{out}/snapshot", TRAIL_S)
    return serving.merged_view(spark, f"{_db()}.wiki_edits", f"{out}/snapshot", TOP)


@query("speed_view", with_edits("""
SELECT CAST(row_number() OVER (ORDER BY count DESC, wiki ASC) AS INTEGER) AS rank, wiki, count,
       CAST(86400 AS INTEGER) AS window_s
FROM speed_top""", _LIVE, _SPEED_TOP))
def q_speed_view(spark, sf):
    ev, as_of, _ = _clocked(spark, sf)
    snap = fresh_dir(spark, "snapshot")
    serving.write_snapshot(windows.trailing_counts(ev, as_of, TRAIL_S, PANE_S), snap, TRAIL_S)
    return serving.read_snapshot(spark, snap, TOP).select("rank", "wiki", "count", "window_s")


@query("trailing_topn_by_day", with_edits(_TRAIL_SQL, _LIVE))
def q_trailing_topn_by_day(spark, sf):
    """Over a history by date: the clock and the window open the newest days' folders alone."""
    path = fresh_dir(spark, "bronze")
    batch_job.to_bronze(edit_events(spark, sf), path)
    ev = spark.read.parquet(path)
    return windows.trailing_topn(ev, windows.as_of_literal(ev, "event_time"), TOP, TRAIL_S, PANE_S)


@query("merged_csv_roundtrip", with_edits(_MERGE_SQL, _LIVE, _BATCH_ALL, _SPEED_ALL))
def q_merged_csv_roundtrip(spark, sf):
    batch, speed_counts = _batch_and_speed(spark, sf)
    path = fresh_dir(spark, "merged-csv")
    serving.export_csv(merge.lambda_merge(batch, speed_counts, TOP), path, single_file=True)
    return serving.read_csv(spark, path)


# --------------------------------------------------------------- raw history

def _mixed_history(spark, sf) -> str:
    """Raw history in hour folders: a third of the records as plain files, a third
    gzipped, a third in files without a JSON extension."""
    ev = edit_events(spark, sf)
    path = fresh_dir(spark, "raw")
    third = F.col("id").cast("long") % 3
    land_raw(ev.filter(third == 0), f"{path}/plain")
    rec = F.to_json(F.struct(*[F.col(c) for c in EVENT_COLS])).alias("value")
    ev.filter(third == 1).select(rec).write.option("compression", "gzip").text(f"{path}/zipped")
    ev.filter(third == 2).select(rec).write.text(f"{path}/other")
    return path


@query("scan_jsonl", with_edits(f"SELECT {_EVENT_SQL_COLS} FROM edits"))
def q_scan_jsonl(spark, sf):
    return scan_jsonl(spark, _mixed_history(spark, sf), recursive=True).select(*EVENT_COLS)


_RAW_SQL = with_edits(f"""
SELECT strftime(arrival_time, '%Y') AS yyyy, strftime(arrival_time, '%m') AS mm,
       strftime(arrival_time, '%d') AS dd, strftime(arrival_time, '%H') AS "HH", {_EVENT_SQL_COLS}
FROM edits""")


def _raw_back(spark, path):
    schema = StructType(EVENT_SCHEMA.fields + [StructField(p, StringType(), True) for p in PARTS])
    return spark.read.schema(schema).json(path).select(*PARTS, *EVENT_COLS)


@query("raw_sink_roundtrip", _RAW_SQL)
def q_raw_sink_roundtrip(spark, sf):
    path = fresh_dir(spark, "raw")
    land_raw(edit_events(spark, sf), path)
    return _raw_back(spark, path)


@query("raw_inventory", with_edits(f"""
SELECT CAST(sum(octet_length(encode({_PAYLOAD_SQL})) + 1) AS BIGINT) AS bytes FROM edits"""))
def q_raw_inventory(spark, sf):
    """Bytes of the landed history (the number of files is the engine's choice)."""
    path = fresh_dir(spark, "raw")
    land_raw(edit_events(spark, sf), path)
    return raw_inventory(spark, path).select("bytes")


INVENTORY_KEYS = 10


@query("raw_inventory_objects", with_edits(f"""
SELECT count(DISTINCT CAST(arrival_time AS DATE)) AS objects,
       CAST(sum(octet_length(encode({_PAYLOAD_SQL})) + 1) AS BIGINT) AS bytes,
       count(DISTINCT CAST(arrival_time AS DATE)) > {INVENTORY_KEYS} AS truncated
FROM edits"""))
def q_raw_inventory_objects(spark, sf):
    """The whole inventory row, of a history of one file a day."""
    path = fresh_dir(spark, "raw")
    (edit_events(spark, sf).select(*EVENT_COLS, F.to_date("arrival_time").alias("date"))
     .repartition("date").write.partitionBy("date").json(path))
    return raw_inventory(spark, path, INVENTORY_KEYS)


def _dirty_jsonl(spark, sf, trailing: bool = False) -> str:
    """Raw lines derived from the events, some damaged: event ids ending in
    07 / 57 are cut in half (unparsable), ids ending in 08 / 58 become blank
    lines. With ``trailing``, ids ending in 09 / 59 are followed by text and those in
    10 / 60 by a second object. Written as text files."""
    ev = edit_events(spark, sf)
    line = F.to_json(F.struct(*[F.col(c) for c in EVENT_COLS]))
    eid = F.col("id").cast("long") % 50
    dirty = (F.when(eid == 7, F.substring(line, 1, (F.length(line) / 2).cast("int")))
             .when(eid == 8, F.lit("")).otherwise(line))
    if trailing:
        dirty = F.when(eid == 11, F.concat(F.lit("\t"), line)).when(eid == 12, F.concat(line, F.lit("\x0c "))).otherwise(dirty)
        dirty = (F.when(eid == 9, F.concat(line, F.lit(" xyz")))
                 .when(eid == 10, F.concat(line, line)).otherwise(dirty))
    path = fresh_dir(spark, "dirty-jsonl")
    ev.select(dirty.alias("value")).write.mode("overwrite").text(path)
    return path


@query("scan_jsonl_strict", with_edits(f"""
SELECT {_EVENT_SQL_COLS} FROM edits WHERE CAST(id AS BIGINT) % 50 NOT IN (7, 8, 9, 10)"""))
def q_scan_jsonl_strict(spark, sf):
    return scan_jsonl_strict(spark, _dirty_jsonl(spark, sf, trailing=True), glob="*.txt")


@query("jsonl_record_counts", with_edits("""
SELECT CAST(count_if(CAST(id AS BIGINT) % 50 <> 8) AS BIGINT) AS total,
       CAST(count_if(CAST(id AS BIGINT) % 50 = 7) AS BIGINT) AS malformed,
       CAST(count_if(CAST(id AS BIGINT) % 50 NOT IN (7, 8)) AS BIGINT) AS parsed,
       CAST(count_if(CAST(id AS BIGINT) % 50 NOT IN (7, 8)) AS BIGINT) AS with_id
FROM edits"""))
def q_jsonl_record_counts(spark, sf):
    df = scan_jsonl(spark, _dirty_jsonl(spark, sf), keep_corrupt=True)
    return record_counts_jsonl(df)


# ------------------------------------------------------------------ streaming

def _landed(spark, sf, clock: str = "event_time") -> tuple[str, int]:
    """Events landed in time order, and how many files make one of the four micro-batches."""
    path = fresh_dir(spark, "stream-in")
    return path, speed.land_in_waves(edit_events(spark, sf), path, clock=clock)


def _stream(spark, sf, clock: str = "event_time"):
    path, files = _landed(spark, sf, clock)
    return speed.read_events_stream(spark, path, max_files=files)


_APPEND_SQL = with_edits("""
SELECT * FROM sliding
WHERE window_end <= (SELECT max(event_time) FROM pop) - INTERVAL 1 MINUTE""",
                         "sliding AS (" + _SLIDING_SQL + ")")


def _append_windows(spark, src, panes: bool):
    out, ck = fresh_dir(spark, "speed-out"), fresh_dir(spark, "ckpt")
    speed.run_to_end(speed.run_speed(src, out, ck, AVAILABLE_NOW, panes=panes))
    return windows.flatten_window(spark.read.parquet(out))


@query("stream_sliding_append", _APPEND_SQL)
def q_stream_sliding_append(spark, sf):
    return _append_windows(spark, _stream(spark, sf), panes=False)


@query("stream_pane_sliding", _APPEND_SQL)
def q_stream_pane_sliding(spark, sf):
    return _append_windows(spark, _stream(spark, sf), panes=True)


@query("stream_restart", _APPEND_SQL)
def q_stream_restart(spark, sf):
    """Two runs from one checkpoint: the later half of the events lands after the first run has ended."""
    ev = edit_events(spark, sf)
    lo, hi = ev.agg(F.min("event_time"), F.max("event_time")).first()
    first = F.col("event_time") < F.lit(lo + (hi - lo) / 2)
    base, out, ck = fresh_dir(spark, "stream-in"), fresh_dir(spark, "speed-out"), fresh_dir(spark, "ckpt")
    for part in (first, ~first):
        files = speed.land_in_waves(ev.filter(part), base, waves=2)
        src = speed.read_events_stream(spark, base, max_files=files)
        speed.run_to_end(speed.run_speed(src, out, ck, AVAILABLE_NOW))
    return windows.flatten_window(spark.read.parquet(out))


RANGE_SHARE = 3         # the replayed history is about so many ranges


@query("speed_history", _APPEND_SQL)
def q_speed_history(spark, sf):
    """The windowed job's drain of landed files: written by several tasks in no time order, more files than
    a micro-batch takes, several ranges."""
    ev = edit_events(spark, sf)
    path, out, ck = fresh_dir(spark, "stream-in"), fresh_dir(spark, "speed-out"), fresh_dir(spark, "ckpt")
    ev.repartition(8, F.xxhash64("id")).write.option("timestampFormat", speed.TS_FORMAT).json(path)
    src = speed.read_events_stream(spark, path, max_files=3)
    speed.replay_files(spark, src, out, ck, range_rows=ev.count() // RANGE_SHARE)
    return windows.flatten_window(spark.read.parquet(out))


_SECONDS_SQL = _SLIDING_SQL.replace("event_time", 'make_timestamp("timestamp" * 1000000)')


@query("speed_over_raw", with_edits(f"""
SELECT * FROM sliding
WHERE window_end <= (SELECT make_timestamp(max("timestamp") * 1000000) FROM pop) - INTERVAL 1 MINUTE""",
                                    "sliding AS (" + _SECONDS_SQL + ")"))
def q_speed_over_raw(spark, sf):
    """The speed job over this library's own raw history, whose records carry only
    ``timestamp``, landed and read in ranges of hours."""
    raw, out, ck = fresh_dir(spark, "raw"), fresh_dir(spark, "speed-out"), fresh_dir(spark, "ckpt")
    speed.replay_raw(spark, edit_events(spark, sf), raw, out, ck)
    return windows.flatten_window(spark.read.parquet(out))


@query("stream_sliding_complete", with_edits(_SLIDING_SQL))
def q_stream_sliding_complete(spark, sf):
    out, ck = fresh_dir(spark, "speed-complete"), fresh_dir(spark, "ckpt")
    agg = windows.sliding_counts(views.batch_population(_stream(spark, sf)))
    speed.run_to_end(speed.run_complete(agg, out, ck, AVAILABLE_NOW, bounded=True))      # the landed files end
    return windows.flatten_window(publish.current(spark, out))


@query("stream_topn_complete", with_edits("""
SELECT wiki, count(*) AS edits FROM pop GROUP BY wiki ORDER BY edits DESC, wiki ASC LIMIT 10"""))
def q_stream_topn_complete(spark, sf):
    out, ck = fresh_dir(spark, "speed-topn"), fresh_dir(spark, "ckpt")
    speed.run_to_end(speed.run_complete(speed.top_wikis_complete(_stream(spark, sf), TOP), out, ck, AVAILABLE_NOW))
    return publish.current(spark, out)


FEED_ITEMS = 500        # features of a polled document


def _polled(spark, sf) -> str:
    """Two overlapping polls of a feature feed made from the events: ids with last
    digit 0-5 in the first, 4-9 in the second; some ids empty or missing."""
    ev = edit_events(spark, sf)
    n = F.col("id").cast("long")
    item = F.struct(
        F.when(n % 97 == 0, "").when(n % 89 == 0, F.lit(None)).otherwise(F.col("id")).alias("id"),
        F.lit("Feature").alias("type"),
        F.struct("title", F.col("wiki").alias("place"), F.col("timestamp").alias("time")).alias("properties"))
    path = fresh_dir(spark, "feed")
    for poll in (n % 10 <= 5, n % 10 >= 4):
        docs = ev.filter(poll).groupBy(F.floor(n / FEED_ITEMS).alias("_doc")).agg(F.collect_list(item).alias("features"))
        docs.select("features").repartition(2, "features").write.mode("append").json(path)
    return path


@query("feed_once", with_edits("""
SELECT id, title, wiki AS place, "timestamp" AS time FROM edits
WHERE CAST(id AS BIGINT) % 97 <> 0 AND CAST(id AS BIGINT) % 89 <> 0"""))
def q_feed_once(spark, sf):
    """Batch form: explode the polled documents, each id once."""
    feed = spark.read.schema(FEATURE_FEED).json(_polled(spark, sf))
    items = explode_features(feed).select("id", "properties.*")
    return dedupe_by_id(items, order_cols=("time",))


@query("stream_dedupe", with_edits("""
SELECT id, title, wiki AS place, "timestamp" AS time FROM edits
WHERE CAST(id AS BIGINT) % 97 <> 0 AND CAST(id AS BIGINT) % 89 <> 0"""))
def q_stream_dedupe(spark, sf):
    """Streaming form over several micro-batches: a file per trigger."""
    from editlens.sources import stream_source
    src = stream_source(spark, "json", _polled(spark, sf), FEATURE_FEED, {"maxFilesPerTrigger": "1"})
    out, ck = fresh_dir(spark, "dedupe"), fresh_dir(spark, "ckpt")
    d = speed.dedupe_stream(explode_features(src).select("id", "properties.*"))
    speed.run_to_end(speed.start_query(d, ck, "append", "parquet", out, AVAILABLE_NOW))
    return spark.read.parquet(out)


@query("replay_stream", with_edits(f"SELECT {_EVENT_SQL_COLS} FROM pop"))
def q_replay_stream(spark, sf):
    out, ck = fresh_dir(spark, "replay"), fresh_dir(spark, "ckpt")
    q = speed.start_query(speed.admitted(_stream(spark, sf)).select(*EVENT_COLS), ck, "append", "parquet", out,
                          AVAILABLE_NOW)
    speed.run_to_end(q)
    return spark.read.parquet(out)


def _snapshot(spark, src, files):
    snap, ck = fresh_dir(spark, "snapshot"), fresh_dir(spark, "ckpt")
    speed.run_to_end(speed.run_snapshot(spark, src, snap, ck, TRAIL_S, PANE_S, AVAILABLE_NOW, speed.state_width(files)))
    return serving.read_snapshot(spark, snap, TOP).select("rank", "wiki", "count", "window_s")


_RANKED_SQL = """
SELECT CAST(row_number() OVER (ORDER BY count DESC, wiki ASC) AS INTEGER) AS rank, wiki, count,
       CAST(86400 AS INTEGER) AS window_s
FROM speed_top"""


@query("speed_snapshot", with_edits(_RANKED_SQL, _LIVE, _SPEED_TOP))
def q_speed_snapshot(spark, sf):
    path, files = _landed(spark, sf)
    return _snapshot(spark, speed.read_events_stream(spark, path, max_files=files), files)


@query("speed_snapshot_log", with_edits(_RANKED_SQL, _LIVE.replace("event_time", "arrival_time"), _SPEED_TOP))
def q_speed_snapshot_log(spark, sf):
    """The same from log records: envelope, decoded record, arrival clock."""
    path, files = _landed(spark, sf)
    src = speed.read_events_stream(spark, path, max_files=files)
    return _snapshot(spark, speed.decode_envelope(speed.envelope(src)), files)


@query("speed_state_view", with_edits(_RANKED_SQL, _LIVE, _SPEED_TOP))
def q_speed_state_view(spark, sf):
    """The same ranks read from the state of the pane counts; the stream publishes nothing."""
    ck = fresh_dir(spark, "ckpt")
    path, files = _landed(spark, sf)
    src = speed.read_events_stream(spark, path, max_files=files)
    speed.run_to_end(speed.start_query(speed.pane_stream(src, TRAIL_S, PANE_S), ck, "update", "noop",
                                       trigger=AVAILABLE_NOW, state_partitions=speed.state_width(files)))
    return serving.state_snapshot(spark, ck, TOP, TRAIL_S).select("rank", "wiki", "count", "window_s")


@query("dual_write", with_edits(f"""
SELECT sink, coalesce(nullif(substring(wiki, 1, 256), ''), 'default') AS key, {_PAYLOAD_SQL} AS value
FROM edits, (VALUES ('raw'), ('log')) AS s(sink)"""))
def q_dual_write(spark, sf):
    raw, log, ck = fresh_dir(spark, "raw"), fresh_dir(spark, "log"), fresh_dir(spark, "ckpt")
    speed.run_to_end(speed.run_dual_write(_stream(spark, sf), raw, log, ck, AVAILABLE_NOW))
    r = to_log_records(scan_jsonl(spark, raw, recursive=True))
    lg = spark.read.schema("key string, value string").option("recursiveFileLookup", "true").parquet(log)
    return r.withColumn("sink", F.lit("raw")).unionByName(lg.withColumn("sink", F.lit("log")))


@query("stream_raw_sink", _RAW_SQL)
def q_stream_raw_sink(spark, sf):
    from editlens.sources import run_raw_sink
    out, ck = fresh_dir(spark, "raw-stream"), fresh_dir(spark, "ckpt")
    speed.run_to_end(run_raw_sink(_stream(spark, sf), out, ck, trigger=AVAILABLE_NOW))
    return _raw_back(spark, out)


@query("stream_source", with_edits(f"SELECT {_EVENT_SQL_COLS}, event_time FROM edits"))
def q_stream_source(spark, sf):
    from editlens.sources import stream_source
    from editlens.schema import EDIT_EVENT
    path, files = _landed(spark, sf)
    src = stream_source(spark, "json", path, EDIT_EVENT,
                        {"timestampFormat": speed.TS_FORMAT, "maxFilesPerTrigger": str(files)})
    out, ck = fresh_dir(spark, "stream-src"), fresh_dir(spark, "ckpt")
    q = speed.start_query(src.select(*EVENT_COLS, to_ntz("event_time").alias("event_time")),
                     ck, "append", "parquet", out, AVAILABLE_NOW)
    speed.run_to_end(q)
    return spark.read.parquet(out)


@query("stream_late_drop", with_edits("""
SELECT ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end, wiki, count(*) AS edits
FROM (SELECT wiki, unnest(generate_series(date_trunc('minute', event_time) - INTERVAL 4 MINUTE,
                                          date_trunc('minute', event_time), INTERVAL 1 MINUTE)) AS ws
      FROM pop WHERE event_time >= (SELECT mid FROM bounds))
GROUP BY ALL
HAVING ws + INTERVAL 5 MINUTE <= (SELECT max(event_time) FROM pop) - INTERVAL 1 MINUTE""",
    "bounds AS (SELECT make_timestamp((epoch_us(min(event_time)) + epoch_us(max(event_time))) // 2)"
    " AS mid FROM edits)"))
def q_stream_late_drop(spark, sf):
    """Late data past the watermark is dropped.

    Wave 1 (events from the time midpoint on) is streamed to completion,
    which moves the watermark to its latest event minus the delay; wave 2
    (the older half) lands afterwards and is streamed from the same
    checkpoint: every wave-2 row is below the watermark, so the output holds
    wave-1 windows only.
    """
    ev = edit_events(spark, sf)
    lo, hi = ev.agg(F.min(F.unix_micros("event_time")), F.max(F.unix_micros("event_time"))).first()
    mid = F.timestamp_micros(F.lit((lo + hi) // 2).cast("long"))
    base, out, ck = fresh_dir(spark, "late-in"), fresh_dir(spark, "late-out"), fresh_dir(spark, "ckpt")
    for part in (ev.filter(F.col("event_time") >= mid), ev.filter(F.col("event_time") < mid)):
        files = speed.land_in_waves(part, base, waves=2)
        src = speed.read_events_stream(spark, base, max_files=files)
        speed.run_to_end(speed.run_speed(src, out, ck, AVAILABLE_NOW))
    return windows.flatten_window(spark.read.parquet(out))


# ------------------------------------------------------ live monitoring and progress

def _run(spark, stream, name: str):
    """An append stream run to its end, and what it wrote."""
    out, ck = fresh_dir(spark, name), fresh_dir(spark, "ckpt")
    speed.run_to_end(speed.start_query(stream, ck, "append", "parquet", out, AVAILABLE_NOW))
    return spark.read.schema(stream.schema).parquet(out)


def _closed(sql: str, period_s: int) -> str:
    """The rows of an alarm query whose period the stream's watermark has passed."""
    return (f"SELECT * FROM ({sql}) WHERE minute + INTERVAL {period_s} SECOND <= (SELECT max(ts + to_seconds(CAST("
            "json_extract(props, '$.k') AS INTEGER))) FROM events) - INTERVAL 1 MINUTE")


@query("stream_rate_alarm", _closed(ORACLE_SQL["rate_alarm"], RATE_PERIOD_S))
def q_stream_rate_alarm(spark, sf):
    return _run(spark, monitoring.rate_alarm_stream(_stream(spark, sf, "arrival_time"), RATE_THRESHOLD, RATE_PERIODS,
                                                    period_s=RATE_PERIOD_S), "rate-alarm")


@query("stream_lag_alarm", _closed(ORACLE_SQL["lag_alarm"], DEFAULTS.period_seconds))
def q_stream_lag_alarm(spark, sf):
    return _run(spark, monitoring.lag_alarm_stream(_stream(spark, sf, "arrival_time")), "lag-alarm")


@query("stream_probe", f"""
SELECT * FROM ({ORACLE_SQL["sentinel_latency"]})
WHERE minute + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 MINUTE""")
def q_stream_probe(spark, sf):
    """Sent records and the log are two streams over the same landed files."""
    path, files = _landed(spark, sf)
    sent, seen = (speed.read_events_stream(spark, path, max_files=files) for _ in range(2))
    out = _run(spark, monitoring.probe_stream(sent, seen), "probe")
    return out


@query("stream_topn_per_window", with_edits(f"""
SELECT window_start, window_end, wiki, edits, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start, window_end ORDER BY edits DESC, wiki ASC) AS rank FROM sliding)
WHERE rank <= {TOP} AND window_end <= (SELECT max(event_time) FROM pop) - INTERVAL 1 MINUTE""",
                                            "sliding AS (" + _SLIDING_SQL + ")"))
def q_stream_topn_per_window(spark, sf):
    out, ck = fresh_dir(spark, "topn-window"), fresh_dir(spark, "ckpt")
    counts = speed.windowed_counts(_stream(spark, sf))
    speed.run_to_end(monitoring.run_topn_per_window(counts, out, ck, TOP, trigger=AVAILABLE_NOW))
    return monitoring.read_topn(spark, out)


@query("stream_progress", with_edits("""
SELECT count(*) AS input_rows, count(*) AS total, CAST(count_if(coalesce(bot, FALSE) = FALSE) AS BIGINT) AS after_bot_filter,
       CAST(count_if(coalesce(bot, FALSE) = FALSE AND wiki IS NOT NULL) AS BIGINT) AS kept
FROM edits"""))
def q_stream_progress(spark, sf):
    """Rows of every micro-batch, as the progress table holds them, add up to the landed rows."""
    log = monitoring.ProgressLog(spark, fresh_dir(spark, "progress"))
    spark.streams.addListener(log)
    try:
        seen = monitoring.observe_counts(_stream(spark, sf))
        q = speed.run_speed(seen, fresh_dir(spark, "speed-out"), fresh_dir(spark, "ckpt"), AVAILABLE_NOW)
        speed.run_to_end(q)
        log.wait(q)
    finally:
        spark.streams.removeListener(log)
    return monitoring.progress_by_batch(log.read()).agg(
        *[F.sum(c).cast("long").alias(c) for c in ("input_rows", *views.COUNT_NAMES)])


# ------------------------------------------------------------- panes opened by events

SHARDS = 4

_EVENT_PANES = f"""
rows AS (
  SELECT CAST((CAST('0x' || substring(md5(coalesce(nullif(substring(wiki, 1, 256), ''), 'default')), 1, 8) AS BIGINT)
               * {SHARDS}) >> 32 AS INTEGER) AS shard, epoch_us({_DENSE_TIME}) AS t,
         coalesce(nullif(wiki, ''), nullif(id, ''), 'unknown') AS wiki
  FROM edits
  WHERE coalesce(bot, FALSE) = FALSE
    AND (coalesce(type, '') = '' OR type IN ('edit', 'new', 'categorize') OR (wiki IS NULL AND title IS NULL))),
starts AS (
  SELECT shard, min(t) AS p FROM rows GROUP BY shard
  UNION ALL
  SELECT s.shard, min(r.t) FROM starts s JOIN rows r ON r.shard = s.shard AND r.t >= s.p + {PANE_S * 1_000_000}
  GROUP BY s.shard),
panes AS (
  SELECT r.shard, s.p, r.wiki, count(*) AS count
  FROM rows r ASOF JOIN starts s ON r.shard = s.shard AND r.t >= s.p GROUP BY ALL)"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def _pane_table(spark, sf):
    path = fresh_dir(spark, "stream-in")
    files = speed.land_in_waves(_dense(spark, sf), path)
    src = speed.read_events_stream(spark, path, max_files=files)
    out, ck = fresh_dir(spark, "event-panes"), fresh_dir(spark, "ckpt")
    speed.run_to_end(panes.run_event_panes(src, out, ck, AVAILABLE_NOW, shards=SHARDS, pane_s=PANE_S))
    return panes.read_panes(spark, out)


@query("stream_event_panes", _recursive(with_edits(
    "SELECT shard, make_timestamp(p) AS pane_start, wiki, count FROM panes", _EVENT_PANES)))
def q_stream_event_panes(spark, sf):
    """Every pane of every shard, over several micro-batches."""
    return _pane_table(spark, sf).select("shard", to_ntz(F.col("pane_start")).alias("pane_start"), "wiki", "count")


@query("stream_event_panes_topn", _recursive(with_edits(f"""
SELECT wiki, CAST(sum(count) AS BIGINT) AS count FROM panes
WHERE p >= (SELECT max(t) FROM rows) - {DEFAULTS.window_seconds * 1_000_000}
GROUP BY wiki ORDER BY count DESC, wiki ASC LIMIT {TOP}""", _EVENT_PANES)))
def q_stream_event_panes_topn(spark, sf):
    """The consumer's top keys at its latest event."""
    rows = windows.speed_population(_dense(spark, sf))
    return panes.live_topn(_pane_table(spark, sf), windows.as_of_literal(rows, "event_time"), TOP)
