"""Driver tables -> edit events.

The driver's ``events`` table (event_id, ts, user_id, event_type, value,
props '{"k": 0..99}') is mapped deterministically onto the edit-event
schema, so every view reads real rows whose volume grows with the data:

* wiki      NULL when k = 0, else 'wiki_<user_id>'
* type      click->edit, view->new, purchase->categorize, signup->log,
            error->NULL
* bot       true when k % 10 = 1, NULL when k % 10 = 2, else false
* timestamp epoch seconds of ts (floored)
* namespace NULL when k % 16 = 15, else k % 16
* id / user event_id / user_id as strings
* title     NULL when k = 0, else 'User:<event_type>_page_of_<k>'
* event_time   ts as TIMESTAMP (UTC)
* arrival_time event_time + k seconds (stands for the ingest clock)

The mapping is a narrow projection: it keeps the Parquet scan's column
pruning and filter pushdown and adds no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editlens.session import ensure_utc


# Schemas of the driver tables this library reads (skips footer inference,
# fails loudly on drift).
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
}


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    r = spark.read
    if name in TABLE_SCHEMAS:
        r = r.schema(TABLE_SCHEMAS[name])
    return r.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_as_edits(events: DataFrame) -> DataFrame:
    # json_tuple is a generator, so each props document is parsed once per
    # row; a scalar get_json_object would be re-evaluated in every filter
    # and projection that uses k.
    et = F.col("event_type")
    event_time = F.col("ts").cast("timestamp")
    return (
        events.select(
            F.json_tuple("props", "k").alias("_kj"),
            "event_id", "user_id", "event_type", "ts",
        )
        .select(
            F.col("_kj").cast("int").alias("_k"),
            "event_id", "user_id", "event_type",
            event_time.alias("event_time"),
        )
        .select(
            F.when(F.col("_k") == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("wiki_"), F.col("user_id").cast("string")))
             .alias("wiki"),
            F.when(F.col("_k") == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("User:"), et, F.lit("_page_of_"),
                                 F.col("_k").cast("string")))
             .alias("title"),
            F.when(et == "click", "edit").when(et == "view", "new")
             .when(et == "purchase", "categorize").when(et == "signup", "log")
             .alias("type"),
            F.when(F.col("_k") % 10 == 1, F.lit(True))
             .when(F.col("_k") % 10 == 2, F.lit(None).cast("boolean"))
             .otherwise(F.lit(False)).alias("bot"),
            F.unix_seconds("event_time").alias("timestamp"),
            F.col("user_id").cast("string").alias("user"),
            F.when(F.col("_k") % 16 == 15, F.lit(None).cast("int"))
             .otherwise((F.col("_k") % 16).cast("int")).alias("namespace"),
            F.col("event_id").cast("string").alias("id"),
            "event_time",
            F.timestamp_micros(
                F.unix_micros("event_time") + F.col("_k").cast("long") * 1_000_000
            ).alias("arrival_time"),
        )
    )


def edit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edit events derived from ``events.parquet`` (schema: EDIT_EVENT)."""
    ensure_utc(spark)
    return events_as_edits(load_table(spark, sf_dir, "events"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "documents")


def part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "part").select("p_partkey", "p_name")
