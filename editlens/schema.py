"""Canonical edit-event schemas (batch, stream payload, envelope)."""

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Raw JSON record as written by producers; all fields nullable.
EVENT_SCHEMA = StructType([
    StructField("wiki", StringType(), True),
    StructField("title", StringType(), True),
    StructField("type", StringType(), True),
    StructField("bot", BooleanType(), True),
    StructField("timestamp", LongType(), True),
    StructField("user", StringType(), True),
    StructField("namespace", IntegerType(), True),
    StructField("id", StringType(), True),
])

# Same record plus the two clocks every layer works on.
EDIT_EVENT = StructType(EVENT_SCHEMA.fields + [
    StructField("event_time", TimestampType(), True),
    StructField("arrival_time", TimestampType(), True),
])

# Payload decoded by the streaming layer: the whole record (the counting key
# falls back to id).
STREAM_PAYLOAD = EVENT_SCHEMA

# Envelope of a record read from a managed log.
ENVELOPE = StructType([
    StructField("data", BinaryType(), True),
    StructField("approximateArrivalTimestamp", TimestampType(), True),
])

# Speed snapshot as stored, all keys; ranks are added when it is read.
SNAPSHOT_SCHEMA = StructType([
    StructField("wiki", StringType(), True),
    StructField("count", LongType(), True),
    StructField("ts", LongType(), True),
    StructField("window_s", IntegerType(), True),
])

# Only the strict scan filters by name; compressed files count.
STRICT_FILE_GLOB = "*.{jsonl,json,jsonl.gz,json.gz}"
