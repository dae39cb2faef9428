"""Query catalog: every operator as a (spark, sf_dir) -> DataFrame callable,
with its DuckDB SQL twin (``ORACLE_SQL``) where one exists.

Parameters are fixed here once. The driver tables are sparse in time
(~14 events per hour at sf0.01), so trailing-window queries use a one-day
window and the ingest-rate alarm a one-hour period; library defaults are
unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editlens.config import DEFAULTS
from editlens.functions import group_key, not_bot, partition_key, should_count, to_ntz
from editlens.operators import amplify, merge, monitor, views, windows
from editlens.operators.windows import as_of_literal
from editlens.plans.oracle import bucket_expr, hour_expr, tokens_expr, with_edits
from editlens.sources import dedupe_by_id, documents, edit_events, part_names

TOP = DEFAULTS.top_n
TRAIL_S = 86_400          # trailing window of the speed-view queries
PANE_S = DEFAULTS.pane_seconds
RATE_PERIOD_S = 3_600     # rate alarm period (events are sparse)
RATE_THRESHOLD = 14.0
RATE_PERIODS = DEFAULTS.rate_periods

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def latest_event(ev: DataFrame):
    """max(event_time), computed once by Spark -- a partial max per task, so a
    single number reaches the driver -- and used as a literal. (A scalar
    subquery would be re-executed at each place the plan uses it, i.e. one
    more scan of the time column per use.)"""
    return as_of_literal(ev, "event_time")


# ---------------------------------------------------------------- batch views

@query("wiki_edits", with_edits("""
SELECT wiki, count(*) AS edits FROM pop GROUP BY wiki
ORDER BY edits DESC, wiki ASC LIMIT 10"""))
def q_wiki_edits(spark, sf):
    return views.wiki_edits(edit_events(spark, sf), TOP)


@query("keywords", with_edits(f"""
SELECT kw, count(*) AS freq FROM (SELECT unnest({tokens_expr('title')}) AS kw FROM pop)
GROUP BY kw ORDER BY freq DESC, kw ASC LIMIT 10"""))
def q_keywords(spark, sf):
    return views.keywords(edit_events(spark, sf), TOP)


@query("doc_keywords", f"""
SELECT kw, count(*) AS freq FROM (SELECT unnest({tokens_expr('text')}) AS kw FROM documents)
GROUP BY kw ORDER BY freq DESC, kw ASC LIMIT 10""")
def q_doc_keywords(spark, sf):
    return views.keywords(documents(spark, sf), TOP, text_col="text", population=False)


@query("part_keywords", f"""
SELECT kw, count(*) AS freq FROM (SELECT unnest({tokens_expr('p_name')}) AS kw FROM part)
GROUP BY kw ORDER BY freq DESC, kw ASC LIMIT 10""")
def q_part_keywords(spark, sf):
    return views.keywords(part_names(spark, sf), TOP, text_col="p_name", population=False)


@query("tokens", f"""
SELECT doc_id, CAST(len({tokens_expr('text')}) AS INTEGER) AS n_tokens,
       CAST(len(list_distinct({tokens_expr('text')})) AS INTEGER) AS n_distinct
FROM documents""")
def q_tokens(spark, sf):
    from editlens.functions import keyword_tokens
    toks = keyword_tokens("text")
    return documents(spark, sf).select(
        "doc_id",
        F.coalesce(F.size(toks), F.lit(0)).alias("n_tokens"),
        F.coalesce(F.size(F.array_distinct(toks)), F.lit(0)).alias("n_distinct"))


@query("keywords_strict", with_edits(f"""
SELECT kw, count(*) AS freq FROM (
  SELECT unnest({tokens_expr('title')}) AS kw FROM edits
  WHERE coalesce(bot, FALSE) = FALSE AND title IS NOT NULL)
GROUP BY kw ORDER BY freq DESC, kw ASC LIMIT 10"""))
def q_keywords_strict(spark, sf):
    """Single-machine twin semantics: titles of every non-bot row, wiki or not."""
    ev = edit_events(spark, sf).filter(not_bot()).na.drop(subset=["title"])
    return views.keywords(ev, TOP, population=False)


@query("hourly", with_edits(f"""
SELECT {hour_expr('"timestamp"')} AS hour, count(*) AS edits FROM pop
GROUP BY hour ORDER BY hour"""))
def q_hourly(spark, sf):
    return views.hourly(edit_events(spark, sf))


@query("hourly_utc_strict", with_edits(f"""
SELECT {hour_expr('"timestamp"')} AS hour, count(*) AS edits FROM edits
WHERE coalesce(bot, FALSE) = FALSE AND "timestamp" IS NOT NULL
GROUP BY hour ORDER BY hour"""))
def q_hourly_strict(spark, sf):
    return views.hourly_utc_strict(edit_events(spark, sf))


@query("hour_bucket", with_edits(f"""
SELECT id, {hour_expr('"timestamp"')} AS hour FROM edits"""))
def q_hour_bucket(spark, sf):
    return views.hour_bucket(edit_events(spark, sf))


@query("edit_types", with_edits("""
SELECT type, count(*) AS edits FROM pop GROUP BY type ORDER BY edits DESC, type ASC NULLS FIRST"""))
def q_edit_types(spark, sf):
    return views.edit_types(edit_events(spark, sf))


@query("edit_types_nonnull", with_edits("""
SELECT type, count(*) AS edits FROM pop WHERE type IS NOT NULL
GROUP BY type ORDER BY edits DESC, type ASC"""))
def q_edit_types_nonnull(spark, sf):
    return views.edit_types(edit_events(spark, sf), keep_null=False)


@query("namespaces", with_edits("""
SELECT namespace, count(*) AS edits FROM pop GROUP BY namespace
ORDER BY edits DESC, namespace ASC NULLS FIRST LIMIT 10"""))
def q_namespaces(spark, sf):
    return views.namespaces(edit_events(spark, sf), TOP)


@query("record_counts", with_edits("""
SELECT count(*) AS total,
       CAST(count_if(coalesce(bot, FALSE) = FALSE) AS BIGINT) AS after_bot_filter,
       CAST(count_if(coalesce(bot, FALSE) = FALSE AND wiki IS NOT NULL) AS BIGINT) AS kept
FROM edits"""))
def q_record_counts(spark, sf):
    return views.record_counts(edit_events(spark, sf))


@query("views_single_pass", with_edits(f"""
SELECT 'wiki' AS view, wiki AS key, count(*) AS edits FROM pop GROUP BY wiki
UNION ALL SELECT 'hour', {hour_expr('"timestamp"')}, count(*) FROM pop GROUP BY 2
UNION ALL SELECT 'type', type, count(*) FROM pop GROUP BY type
UNION ALL SELECT 'namespace', CAST(namespace AS VARCHAR), count(*) FROM pop GROUP BY 2"""))
def q_views_single_pass(spark, sf):
    return views.views_single_pass(edit_events(spark, sf))


# Spark's to_json writes compact JSON and omits NULL fields; concat_ws skips
# NULL parts, so the same payload string is rebuilt field by field.
_PAYLOAD_SQL = """'{' || concat_ws(',',
    CASE WHEN wiki IS NOT NULL THEN '"wiki":' || to_json(wiki) END,
    CASE WHEN title IS NOT NULL THEN '"title":' || to_json(title) END,
    CASE WHEN type IS NOT NULL THEN '"type":' || to_json(type) END,
    CASE WHEN bot IS NOT NULL THEN '"bot":' || CASE WHEN bot THEN 'true' ELSE 'false' END END,
    CASE WHEN "timestamp" IS NOT NULL THEN '"timestamp":' || CAST("timestamp" AS VARCHAR) END,
    CASE WHEN "user" IS NOT NULL THEN '"user":' || to_json("user") END,
    CASE WHEN namespace IS NOT NULL THEN '"namespace":' || CAST(namespace AS VARCHAR) END,
    CASE WHEN id IS NOT NULL THEN '"id":' || to_json(id) END) || '}'"""


# ------------------------------------------------------- predicates and keys

@query("bot_filter", with_edits("""
SELECT id, wiki, bot FROM edits WHERE coalesce(bot, FALSE) = FALSE"""))
def q_bot_filter(spark, sf):
    return edit_events(spark, sf).filter(not_bot()).select("id", "wiki", "bot")


@query("should_count", with_edits("""
SELECT id, (coalesce(bot, FALSE) = FALSE
            AND (coalesce(type, '') = '' OR type IN ('edit', 'new', 'categorize')
                 OR (wiki IS NULL AND title IS NULL))) AS keep
FROM edits"""))
def q_should_count(spark, sf):
    return edit_events(spark, sf).select("id", should_count().alias("keep"))


@query("group_key", with_edits("""
SELECT id, coalesce(nullif(wiki, ''), nullif(id, ''), 'unknown') AS key FROM edits"""))
def q_group_key(spark, sf):
    return edit_events(spark, sf).select("id", group_key().alias("key"))


@query("partition_key", with_edits("""
SELECT id, coalesce(nullif(substring(wiki, 1, 256), ''), 'default') AS pkey FROM edits"""))
def q_partition_key(spark, sf):
    return edit_events(spark, sf).select("id", partition_key("wiki").alias("pkey"))


@query("log_records", with_edits(f"""
SELECT coalesce(nullif(substring(wiki, 1, 256), ''), 'default') AS key, {_PAYLOAD_SQL} AS value
FROM edits"""))
def q_log_records(spark, sf):
    from editlens.sources import to_log_records
    return to_log_records(edit_events(spark, sf))


@query("fanout", with_edits("""
SELECT pkey, count(*) AS n, count(_fanout) AS clones FROM (
  SELECT CASE WHEN i > 0 THEN i END AS _fanout,
         CASE WHEN i > 0 THEN coalesce(wiki, 'enwiki') || '-' || CAST(i AS VARCHAR)
              ELSE coalesce(wiki, 'enwiki') END AS pkey
  FROM (SELECT wiki, unnest(generate_series(0, 4)) AS i FROM edits))
GROUP BY pkey"""))
def q_fanout(spark, sf):
    return (amplify.fanout(edit_events(spark, sf).select("wiki", "id"), DEFAULTS.fanout)
            .groupBy("pkey").agg(F.count(F.lit(1)).alias("n"),
                                 F.count("_fanout").alias("clones")))


@query("dedupe_by_id", with_edits("""
SELECT title, event_time, id FROM (
  SELECT title, event_time, id,
         row_number() OVER (PARTITION BY title ORDER BY event_time, id) AS rn
  FROM edits WHERE title IS NOT NULL)
WHERE rn = 1"""))
def q_dedupe_by_id(spark, sf):
    items = edit_events(spark, sf).select("title", to_ntz("event_time").alias("event_time"), "id")
    return dedupe_by_id(items, id_col="title", order_cols=("event_time", "id"))


@query("parse_payload", with_edits("""
SELECT wiki, title, "timestamp", "user", type, bot, namespace, id, arrival_time AS event_time
FROM edits WHERE coalesce(bot, FALSE) = FALSE AND wiki IS NOT NULL"""))
def q_parse_payload(spark, sf):
    from editlens.streaming.speed import decode_envelope, envelope
    out = views.batch_population(decode_envelope(envelope(edit_events(spark, sf))))
    return out.select(*[c for c in out.columns if c not in ("event_time", "arrival_time")],
                      to_ntz("event_time").alias("event_time"))


@query("parse_kafka", with_edits("""
SELECT wiki, title, "timestamp", "user", type, bot, namespace, id, arrival_time AS event_time FROM edits"""))
def q_parse_kafka(spark, sf):
    """(key, value, timestamp) records of the other log shape; nothing filtered."""
    from editlens.sources import to_log_records
    from editlens.streaming.speed import decode_envelope
    ev = edit_events(spark, sf)
    payload = to_log_records(ev.withColumn("_t", F.col("arrival_time")), keep=("_t",))
    out = decode_envelope(payload.select(F.col("key").cast("binary"), F.col("value").cast("binary"),
                                         F.col("_t").alias("timestamp")))
    return out.select(*[c for c in out.columns if c not in ("event_time", "arrival_time")],
                      to_ntz("event_time").alias("event_time"))


# -------------------------------------------------------------------- windows

_SLIDING_SQL = """
SELECT ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end, wiki, count(*) AS edits
FROM (SELECT wiki, unnest(generate_series(date_trunc('minute', event_time) - INTERVAL 4 MINUTE,
                                          date_trunc('minute', event_time), INTERVAL 1 MINUTE)) AS ws
      FROM pop)
GROUP BY ALL"""


@query("sliding_edits", with_edits(_SLIDING_SQL))
def q_sliding_edits(spark, sf):
    return windows.sliding_edits(edit_events(spark, sf))


@query("pane_sliding", with_edits(_SLIDING_SQL))
def q_pane_sliding(spark, sf):
    return windows.pane_sliding(edit_events(spark, sf))


DENSE = 1000      # time runs so many times faster in the dense case: many events per pane and key
_DENSE_TIME = f"make_timestamp(epoch_us(event_time) // {DENSE})"
_DENSE_SQL = _SLIDING_SQL.replace("event_time", _DENSE_TIME)


def _dense(spark, sf):
    return edit_events(spark, sf).withColumn("event_time", F.timestamp_micros(
        F.floor(F.unix_micros("event_time") / DENSE).cast("long")))


@query("dense_sliding", with_edits(_DENSE_SQL))
def q_dense_sliding(spark, sf):
    return windows.sliding_edits(_dense(spark, sf))


@query("dense_pane_sliding", with_edits(_DENSE_SQL))
def q_dense_pane_sliding(spark, sf):
    return windows.pane_sliding(_dense(spark, sf))


@query("topn_per_window", with_edits("""
SELECT window_start, window_end, wiki, edits, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_start, window_end
                                    ORDER BY edits DESC, wiki ASC) AS INTEGER) AS rank
  FROM sliding) WHERE rank <= 3""", "sliding AS (" + _SLIDING_SQL + ")"))
def q_topn_per_window(spark, sf):
    return windows.topn_per_window(windows.pane_sliding(edit_events(spark, sf)), 3)


_ASOF = "(SELECT max(event_time) FROM edits)"
_LIVE = f"""
live AS (
  SELECT wiki FROM speed
  WHERE event_time <= {_ASOF}
    AND {bucket_expr('event_time', PANE_S)} >= {_ASOF} - INTERVAL {TRAIL_S} SECOND
)"""
_TRAIL_SQL = """
SELECT wiki, count(*) AS count FROM live GROUP BY wiki ORDER BY count DESC, wiki ASC LIMIT 10"""


@query("trailing_topn", with_edits(_TRAIL_SQL, _LIVE))
def q_trailing_topn(spark, sf):
    ev = edit_events(spark, sf)
    return windows.trailing_topn(ev, latest_event(ev), TOP, TRAIL_S, PANE_S)


@query("trailing_size", with_edits("SELECT count(*) AS size FROM live", _LIVE))
def q_trailing_size(spark, sf):
    ev = edit_events(spark, sf)
    return windows.trailing_size(ev, latest_event(ev), TRAIL_S, PANE_S)


# ---------------------------------------------------------------------- merge

_CUTOFF = f"({_ASOF} - INTERVAL {TRAIL_S} SECOND)"
_BATCH_TOP = f"""
batch_top AS (
  SELECT wiki, count(*) AS edits FROM pop WHERE event_time <= {_CUTOFF}
  GROUP BY wiki ORDER BY edits DESC, wiki ASC LIMIT 10
)"""
_SPEED_TOP = "speed_top AS (" + _TRAIL_SQL + ")"
_BATCH_ALL = f"batch_all AS (SELECT wiki, count(*) AS edits FROM pop WHERE event_time <= {_CUTOFF} GROUP BY wiki)"
_SPEED_ALL = "speed_all AS (SELECT wiki, count(*) AS count FROM live GROUP BY wiki)"


def _merge_sql(batch: str, speed: str) -> str:
    return f"""
SELECT wiki, CAST(sum(edits) AS BIGINT) AS edits_merged FROM (
  SELECT wiki, edits FROM {batch} UNION ALL SELECT wiki, count AS edits FROM {speed})
GROUP BY wiki ORDER BY edits_merged DESC, wiki ASC LIMIT 10"""


_MERGE_SQL = _merge_sql("batch_all", "speed_all")


def _clocked(spark, sf):
    """(events, as_of, cutoff between batch history and speed window)"""
    ev = edit_events(spark, sf)
    as_of = latest_event(ev)
    return ev, as_of, as_of - F.make_interval(secs=F.lit(TRAIL_S))


def _batch_and_speed(spark, sf):
    """Counts of all keys of both layers."""
    ev, as_of, cutoff = _clocked(spark, sf)
    return (views.wiki_counts(ev.filter(F.col("event_time") <= cutoff)),
            windows.trailing_counts(ev, as_of, TRAIL_S, PANE_S))


@query("lambda_merge", with_edits(_MERGE_SQL, _LIVE, _BATCH_ALL, _SPEED_ALL))
def q_lambda_merge(spark, sf):
    batch, speed = _batch_and_speed(spark, sf)
    return merge.lambda_merge(batch, speed, TOP)


@query("lambda_merge_outer", with_edits(_MERGE_SQL, _LIVE, _BATCH_ALL, _SPEED_ALL))
def q_lambda_merge_outer(spark, sf):
    batch, speed = _batch_and_speed(spark, sf)
    return merge.lambda_merge_outer(batch, speed, TOP)


@query("lambda_merge_truncated", with_edits(_merge_sql("batch_top", "speed_top"), _LIVE, _BATCH_TOP, _SPEED_TOP))
def q_lambda_merge_truncated(spark, sf):
    """Compatibility variant: both lists are cut to n before they are added, so a
    key ranked n + 1 in both is lost."""
    ev, as_of, cutoff = _clocked(spark, sf)
    return merge.lambda_merge(views.wiki_edits(ev.filter(F.col("event_time") <= cutoff), TOP),
                              windows.trailing_topn(ev, as_of, TOP, TRAIL_S, PANE_S), TOP)


@query("lambda_merge_speed_only", with_edits("""
SELECT wiki, count AS edits_merged FROM speed_top ORDER BY edits_merged DESC, wiki ASC LIMIT 10""",
                                             _LIVE, _SPEED_TOP))
def q_lambda_merge_speed_only(spark, sf):
    ev, as_of, _ = _clocked(spark, sf)
    return merge.lambda_merge(None, windows.trailing_counts(ev, as_of, TRAIL_S, PANE_S), TOP)


@query("lambda_merge_exact", with_edits(f"""
SELECT wiki, CAST(sum(n) AS BIGINT) AS edits_merged FROM (
  SELECT wiki, count(*) AS n FROM pop WHERE event_time <= {_CUTOFF} GROUP BY wiki
  UNION ALL
  SELECT wiki, count(*) AS n FROM speed WHERE event_time > {_CUTOFF} GROUP BY wiki)
GROUP BY wiki ORDER BY edits_merged DESC, wiki ASC LIMIT 10"""))
def q_lambda_merge_exact(spark, sf):
    ev, _, cutoff = _clocked(spark, sf)
    return merge.lambda_merge_exact(ev, cutoff, TOP)


# ----------------------------------------------------------------- monitoring

def _minute(col: str, seconds: int = 60) -> str:
    return bucket_expr(col, seconds)


@query("records_per_min", with_edits(f"""
SELECT {_minute('arrival_time')} AS minute, count(*) AS records FROM edits GROUP BY 1"""))
def q_records_per_min(spark, sf):
    return monitor.records_per_period(edit_events(spark, sf))


@query("throughput_summary", with_edits("""
SELECT count(*) AS periods, max(records) AS peak,
       max(minute) FILTER (WHERE records = (SELECT max(records) FROM rpm)) AS peak_at,
       max(minute) AS latest_at,
       max(records) FILTER (WHERE minute = (SELECT max(minute) FROM rpm)) AS latest
FROM rpm""", f"rpm AS (SELECT {_minute('arrival_time')} AS minute, count(*) AS records "
             f"FROM edits GROUP BY 1)"))
def q_throughput_summary(spark, sf):
    return monitor.throughput_summary(monitor.records_per_period(edit_events(spark, sf)))


@query("bytes_per_min", with_edits(f"""
SELECT {bucket_expr('arrival_time', 60)} AS minute,
       CAST(sum(octet_length(encode({_PAYLOAD_SQL}))) AS BIGINT) AS bytes
FROM edits GROUP BY 1"""))
def q_bytes_per_min(spark, sf):
    return monitor.bytes_per_period(edit_events(spark, sf))


@query("lag_per_min", with_edits(f"""
SELECT {_minute('arrival_time')} AS minute,
       max(epoch_ms(arrival_time) - epoch_ms(event_time)) AS max_lag_ms
FROM edits GROUP BY 1"""))
def q_lag_per_min(spark, sf):
    return monitor.lag_per_period(edit_events(spark, sf))


def _alarm_sql(series_cte: str, value: str, threshold: float, periods: int, period_s: int) -> str:
    return with_edits(f"""
SELECT minute, CAST({value} AS DOUBLE) AS {value}, breach,
       sum(CAST(breach AS INTEGER)) OVER (
         ORDER BY epoch(minute) RANGE BETWEEN {(periods - 1) * period_s} PRECEDING
         AND CURRENT ROW) >= {periods} AS alarm
FROM (SELECT minute, {value}, {value} > {threshold} AS breach FROM series)""", series_cte)


@query("rate_alarm", _alarm_sql(
    f"series AS (SELECT {_minute('arrival_time', RATE_PERIOD_S)} AS minute, count(*) AS records "
    f"FROM edits GROUP BY 1)", "records", RATE_THRESHOLD, RATE_PERIODS, RATE_PERIOD_S))
def q_rate_alarm(spark, sf):
    s = monitor.records_per_period(edit_events(spark, sf), seconds=RATE_PERIOD_S)
    return monitor.sustained_alarm(s, RATE_THRESHOLD, RATE_PERIODS, RATE_PERIOD_S)


@query("lag_alarm", _alarm_sql(
    f"series AS (SELECT {_minute('arrival_time')} AS minute, "
    f"max(epoch_ms(arrival_time) - epoch_ms(event_time)) AS max_lag_ms FROM edits GROUP BY 1)",
    "max_lag_ms", DEFAULTS.lag_threshold_ms, DEFAULTS.lag_periods, DEFAULTS.period_seconds))
def q_lag_alarm(spark, sf):
    s = monitor.lag_per_period(edit_events(spark, sf))
    return monitor.sustained_alarm(s, DEFAULTS.lag_threshold_ms, DEFAULTS.lag_periods,
                                   DEFAULTS.period_seconds, value="max_lag_ms")


@query("sentinel_latency", with_edits(f"""
SELECT wiki, minute, burst, burst_ms, found, CASE WHEN found THEN waited ELSE 60000.0 END AS latency_ms
FROM (SELECT *, coalesce(waited <= 60000.0, FALSE) AS found FROM (
  SELECT wiki, {_minute('event_time')} AS minute, count(*) AS burst,
         (max(epoch_us(event_time)) - min(epoch_us(event_time))) / 1000.0 AS burst_ms,
         CASE WHEN count(seen) > 0 THEN greatest((min(seen) - max(epoch_us(event_time))) / 1000.0, 0.0) END AS waited
  FROM (SELECT *, CASE WHEN coalesce(type, '') = '' OR type IN ('edit', 'new', 'categorize')
                       THEN epoch_us(arrival_time) END AS seen FROM pop)
  GROUP BY 1, 2))"""))
def q_sentinel_latency(spark, sf):
    return monitor.sentinel_latency(edit_events(spark, sf))


# Storage- and stream-backed entries register themselves on import.
from editlens.plans import catalog_io  # noqa: E402,F401
