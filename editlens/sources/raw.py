"""Raw-history sink (JSONL by hour) and the raw-file inventory."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editlens.config import DEFAULTS
from editlens.schema import EVENT_SCHEMA

PARTS = ("yyyy", "mm", "dd", "HH")
SMALL_WRITERS = 8       # of a batch that one writer could take: hours in parallel
CLOCKS = ("event_time", "arrival_time")


def hour_parts(ts: Column | str) -> list[Column]:
    c = F.col(ts) if isinstance(ts, str) else ts
    return [F.date_format(c, f).alias(n) for f, n in
            (("yyyy", "yyyy"), ("MM", "mm"), ("dd", "dd"), ("HH", "HH"))]


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite",
                max_records_per_file: int | None = None) -> None:
    w = df.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.json(path)


def record_columns(events: DataFrame, columns: tuple[str, ...] | None = None) -> list[str]:
    """The canonical fields first, then whatever else the record has."""
    if columns:
        return list(columns)
    known = [f.name for f in EVENT_SCHEMA.fields if f.name in events.columns]
    return known + [c for c in events.columns if c not in known and c not in CLOCKS and c not in PARTS]


def land_raw(events: DataFrame, path: str, clock: str = "arrival_time",
             max_records_per_file: int = DEFAULTS.raw_file_records, mode: str = "overwrite",
             columns: tuple[str, ...] | None = None) -> None:
    """Write events as JSON lines under ``yyyy=/mm=/dd=/HH=`` of ``clock``.

    The hour is that of the ingest clock, not the event's own timestamp, as
    in the raw master dataset. Rows are clustered by hour with a REBALANCE
    hint so each task writes few, large files, and AQE splits an hour that
    holds a large share of all rows over several tasks instead of one;
    ``max_records_per_file`` bounds a file (a producer's flush size, for its small
    files). ``columns`` defaults to every column but the clocks, so fields beyond the
    canonical record are kept. (Range
    partitioning on the clock would also split hot hours, but its sampling
    job is a second pass over the input; on tiny inputs AQE coalesces the
    rebalance into one writer task, which is slow locally and right at scale.)
    """
    out = events.select(*record_columns(events, columns), *hour_parts(clock))
    w = out.hint("rebalance", *PARTS).write.mode(mode).partitionBy(*PARTS)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.json(path)


def sink_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity of a streaming sink, kept in its checkpoint: a query that starts over from an empty
    checkpoint counts its batches from 0 again and must not replace the old ones."""
    from editlens.plans import publish
    path = f"{checkpoint}/sink-id"
    if not publish.exists(spark, path):
        publish.write_text(spark, path, uuid.uuid4().hex[:12])
    return publish.read_text(spark, path).strip()


def write_hours(batch: DataFrame, path: str, name: str, clock: str = "arrival_time",
                columns: tuple[str, ...] | None = None, rows_per_writer: int = DEFAULTS.landed_rows,
                max_records_per_file: int = DEFAULTS.raw_file_records) -> None:
    """Write a (persisted) micro-batch as JSON lines under ``yyyy=/mm=/dd=/HH=/batch=<name>``.

    Rows are dealt evenly to as many writers as the batch's rows ask for, so a batch that is all of one
    hour has that many writers of an equal share; a batch small enough for one writer is dealt
    by hour. Only the batch's own folders are replaced, if
    it is run again.
    """
    cols = record_columns(batch, columns)
    writers = max(1, -(-batch.count() // rows_per_writer))
    rows = batch.select(*cols, *hour_parts(clock), F.lit(name).alias("batch"))
    rows = rows.repartition(writers) if writers > 1 else rows.repartition(SMALL_WRITERS, *PARTS)
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", int(max_records_per_file)).partitionBy(*PARTS, "batch").json(path))


def run_raw_sink(stream: DataFrame, path: str, checkpoint: str, clock: str = "arrival_time",
                 max_records_per_file: int = DEFAULTS.raw_file_records,
                 trigger: dict | None = None, columns: tuple[str, ...] | None = None,
                 rows_per_writer: int = DEFAULTS.landed_rows):
    """Streaming form of the raw sink, see ``write_hours``: each micro-batch once, whatever is retried."""
    ident = sink_id(stream.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            write_hours(held, path, f"{ident}-{batch_id}", clock, columns, rows_per_writer, max_records_per_file)
        finally:
            held.unpersist()

    return (stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
            .trigger(**(trigger or {"processingTime": f"{DEFAULTS.flush_seconds} seconds"})).start())


def raw_inventory(spark: SparkSession, path: str, max_keys: int = 5000) -> DataFrame:
    """Object count, total bytes and a 'more than max_keys' flag.

    Reads only file metadata (``binaryFile`` with the content column pruned), of the
    same files as the permissive scan: all but hidden ones.
    """
    files = (spark.read.format("binaryFile")
             .option("recursiveFileLookup", "true")
             .load(path).select("path", "length"))
    return files.agg(
        F.count(F.lit(1)).alias("objects"),
        F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("bytes"),
        (F.count(F.lit(1)) > F.lit(max_keys)).alias("truncated"),
    )

