"""Stream sources: a log connector or landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from editlens.schema import EVENT_SCHEMA
from editlens.session import ensure_utc


def stream_source(spark: SparkSession, fmt: str = "json", path: str | None = None,
                  schema: StructType | None = EVENT_SCHEMA,
                  options: dict[str, str] | None = None) -> DataFrame:
    """``readStream`` over any connector.

    ``fmt`` is a connector name (``kafka``, a managed-log connector, ...) with
    its ``options``, or a file format reading landed files under ``path``
    (every file, whatever its name or compression; ``maxFilesPerTrigger`` bounds
    each micro-batch; offsets live in the query checkpoint, so a restart resumes
    where it stopped).
    """
    ensure_utc(spark)
    r = spark.readStream.format(fmt)
    if schema is not None and fmt in ("json", "csv", "parquet", "text", "orc"):
        r = r.schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path) if path is not None else r.load()


def to_log_records(events: DataFrame, key_col: str = "wiki",
                   payload_cols: list[str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows -> (key, value) records for a log sink (Kafka-style connector).

    key = the stream partition key of ``key_col`` (first 256 chars, else
    'default'); value = the compact JSON payload. Records with the same key
    land in the same log partition, in order. ``keep`` passes columns through.
    """
    from pyspark.sql import functions as F

    from editlens.functions import partition_key
    cols = payload_cols or [f.name for f in EVENT_SCHEMA.fields]
    return events.select(
        partition_key(key_col).alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in cols])).alias("value"), *keep)


def write_log(records: DataFrame, fmt: str, options: dict[str, str],
              checkpoint: str | None = None, trigger: dict | None = None):
    """Write (key, value) records to a log connector, batch or streaming."""
    if records.isStreaming:
        w = records.writeStream.format(fmt).option("checkpointLocation", checkpoint)
        for k, v in options.items():
            w = w.option(k, v)
        return w.trigger(**(trigger or {"processingTime": "1 second"})).start()
    w = records.write.format(fmt)
    for k, v in options.items():
        w = w.option(k, v)
    w.save()
    return None
