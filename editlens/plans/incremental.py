"""Incremental batch layer: the five views as sums of partial counts by day.

    spark-submit -m editlens.plans.incremental <raw_path> <out_path> [--top-n N] [--include-bots]

The views are counts, so counts of single days add up to them. A run compares the raw files of each
day (``yyyy=/mm=/dd=/HH=`` folders) with those of the run before, counts only the days whose
files changed, and replaces just their partitions of the partial table (dynamic partition
overwrite). The day table is published after the partials: a run that failed
in between counts the same days once more and replaces the same partitions.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from editlens.config import DEFAULTS, STOP_WORDS
from editlens.functions import hour_label
from editlens.functions.text import word_matches
from editlens.operators import views
from editlens.plans import publish
from editlens.plans.batch import CUT_VIEWS, VIEW_NAMES, write_view
from editlens.schema import EVENT_SCHEMA
from editlens.sources.jsonl import scan_jsonl
from editlens.sources.raw import PARTS

PARTIAL_SCHEMA = "view string, key string, edits bigint, day string"
DAY_SCHEMA = "day string, files bigint, bytes bigint, mark bigint"
OUTSIDE = "--"           # day of a file that is in no day folder
#: view -> (column, type) of its key
KEYS = {"wiki_edits": ("wiki", "string"), "keywords": ("kw", "string"), "hourly": ("hour", "string"),
        "edit_types": ("type", "string"), "namespaces": ("namespace", "int")}


def day_files(spark: SparkSession, raw: str) -> DataFrame:
    """(day, files, bytes, mark) of the raw history, from file metadata alone. ``mark`` changes
    with any name, size or time of a file."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(raw)
             .select("path", "length", "modificationTime"))
    parts = [F.regexp_extract("path", f"/{p}=([0-9]+)/", 1) for p in PARTS[:3]]
    return (files.groupBy(F.concat_ws("-", *parts).alias("day"))
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
                 F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("mark")))


def changed_days(spark: SparkSession, now: DataFrame, out: str) -> tuple[list[str], list[str]]:
    """Days to count again and days that are gone; the driver sees days only."""
    before = publish.current(spark, f"{out}/days", spark.createDataFrame([], DAY_SCHEMA).schema)
    if before is None:
        return [r.day for r in now.select("day").collect()], []
    changed = now.join(before, ["day", "files", "bytes", "mark"], "left_anti").select("day").collect()
    gone = before.join(now, "day", "left_anti").select("day").collect()
    return [r.day for r in changed], [r.day for r in gone]


def read_days(spark: SparkSession, raw: str, days: list[str]) -> DataFrame:
    """Raw records of the given days with their ``day``; only those folders are scanned."""
    schema = StructType(EVENT_SCHEMA.fields + [StructField(p, StringType(), True) for p in PARTS])
    day = F.concat_ws("-", *PARTS[:3])
    return scan_jsonl(spark, raw, schema).where(day.isin(days)).withColumn("day", day)


def partial_views(events: DataFrame, exclude_bots: bool = DEFAULTS.exclude_bots) -> DataFrame:
    """(view, key, edits, day): all five views in one scan and one aggregate, combined map-side;
    rows read and kept are counted as views of their own."""
    kept = views.batch_population(events, exclude_bots)
    entry = lambda view, key: F.struct(F.lit(view).alias("view"), key.cast("string").alias("key"))
    words = F.filter(F.coalesce(word_matches("title"), F.array().cast("array<string>")),
                     lambda w: ~w.isin(*STOP_WORDS))
    entries = F.concat(F.array(entry("wiki_edits", F.col("wiki")), entry("hourly", hour_label("timestamp")),
                               entry("edit_types", F.col("type")), entry("namespaces", F.col("namespace"))),
                       F.transform(words, lambda w: entry("keywords", w)))
    counts = (kept.select("day", F.explode(entries).alias("e")).groupBy("e.view", "e.key", "day")
              .agg(F.count(F.lit(1)).alias("edits")))
    rows = events.groupBy("day").agg(*views.count_columns(exclude_bots))
    rows = rows.select(F.explode(F.array(*[F.struct(F.lit(f"_{c}").alias("view"), F.lit(None).cast("string").alias("key"),
                                                    F.col(c).alias("edits")) for c in views.COUNT_NAMES])).alias("r"), "day")
    return counts.unionByName(rows.select("r.*", "day"))


def refresh(spark: SparkSession, raw: str, out: str, exclude_bots: bool = DEFAULTS.exclude_bots) -> list[str]:
    """Bring the partial table up to date with the raw history; returns the days that were counted.

    A day's files are taken as they are listed first: what lands during the run is a change
    for the next one. A changed day without records keeps an empty partial.
    """
    out = out.rstrip("/")
    now = day_files(spark, raw)
    version = publish.publish(spark, now, f"{out}/listed")
    now = publish.current(spark, f"{out}/listed", spark.createDataFrame([], DAY_SCHEMA).schema)
    days, gone = changed_days(spark, now, out)
    if OUTSIDE in days:
        raise ValueError(f"files outside the day folders under {raw}")
    if days:
        empty = spark.createDataFrame([("_total", None, 0, d) for d in days], PARTIAL_SCHEMA)
        partial = partial_views(read_days(spark, raw, days), exclude_bots).unionByName(empty)
        (partial.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day").parquet(f"{out}/partial"))
    for day in gone:
        publish.delete(spark, f"{out}/partial/day={day}")
    publish.publish(spark, now, f"{out}/days", version)
    return days


def merged(spark: SparkSession, out: str) -> DataFrame:
    """(view, key, edits) over all days."""
    return (spark.read.schema(PARTIAL_SCHEMA).parquet(f"{out.rstrip('/')}/partial").groupBy("view", "key")
            .agg(F.sum("edits").alias("edits")))


def view(counts: DataFrame, name: str, top_n: int | None = None) -> DataFrame:
    """One of the five views, ordered and cut as the full job's."""
    key, kind = KEYS[name]
    value = "freq" if name == "keywords" else "edits"
    rows = counts.where(F.col("view") == name).select(F.col("key").cast(kind).alias(key), F.col("edits").alias(value))
    if name == "hourly":
        return rows.orderBy(F.col("hour").asc_nulls_first())
    return views.top_n(rows, value, key, top_n if name in CUT_VIEWS else None)


def run_incremental(spark: SparkSession, raw: str, out: str, top_n: int | None = None,
                    exclude_bots: bool = DEFAULTS.exclude_bots) -> dict[str, str]:
    """Refresh the partials and write the five views from them; returns {view: path}."""
    out = out.rstrip("/")
    refresh(spark, raw, out, exclude_bots)
    counts, paths = merged(spark, out), {}
    for name in VIEW_NAMES:
        paths[name] = f"{out}/{name}"
        write_view(view(counts, name, top_n), paths[name], single_file=top_n is not None and name in CUT_VIEWS)
    return paths


def main(argv: list[str]) -> None:
    import argparse

    from editlens.session import build_session

    p = argparse.ArgumentParser(prog="editlens.plans.incremental", description="Changed days of raw history -> views.")
    p.add_argument("raw")
    p.add_argument("out")
    p.add_argument("--top-n", type=int, default=None)
    p.add_argument("--include-bots", action="store_true")
    a = p.parse_args(argv[1:])
    spark = build_session(app="editlens-incremental")
    run_incremental(spark, a.raw, a.out, a.top_n, not a.include_bots)
    for r in merged(spark, a.out).where("view like '\\\\_%'").orderBy("view").collect():
        print(f"{r.view[1:]}: {r.edits}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
