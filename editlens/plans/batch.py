"""Batch layer job: raw history -> five Parquet views.

    spark-submit -m editlens.plans.batch <raw_path> <out_path> [--top-n N] [--include-bots]

Each view is planned independently from the raw source (no cache of the
whole history: every plan prunes to the 1-3 columns it needs). When the raw
history is JSON, convert it once to a Parquet "bronze" table with
:func:`to_bronze` so later runs get vectorized, pruned, pushed-down scans.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from editlens.config import DEFAULTS
from editlens.operators import views

VIEW_NAMES = ("wiki_edits", "keywords", "hourly", "edit_types", "namespaces")
CUT_VIEWS = ("wiki_edits", "keywords", "namespaces")      # those that ``top_n`` bounds


COUNTS = "_counts"
COUNTS_SCHEMA = ", ".join(f"{c} bigint" for c in views.COUNT_NAMES)

# view -> column it needs besides wiki / bot
VIEW_COLUMN = {"wiki_edits": "wiki", "keywords": "title", "hourly": "timestamp",
               "edit_types": "type", "namespaces": "namespace"}


def with_bot(events: DataFrame) -> DataFrame:
    """Input without a ``bot`` column has no known bots."""
    return events if "bot" in events.columns else events.withColumn("bot", F.lit(None).cast("boolean"))


def batch_views(events: DataFrame, top_n: int | None = None,
                exclude_bots: bool = DEFAULTS.exclude_bots) -> dict[str, DataFrame]:
    """The five views; a view whose column the input lacks is skipped
    (schema guard for caller-supplied tables -- a driver-side check of the
    schema, no data is read)."""
    events = with_bot(events)
    build = {
        "wiki_edits": lambda: views.wiki_edits(events, top_n, exclude_bots),
        "keywords": lambda: views.keywords(events, top_n, exclude_bots),
        "hourly": lambda: views.hourly(events, exclude_bots),
        "edit_types": lambda: views.edit_types(events, True, exclude_bots),
        "namespaces": lambda: views.namespaces(events, top_n, exclude_bots),
    }
    if "wiki" not in events.columns:
        return {}
    return {name: make() for name, make in build.items()
            if VIEW_COLUMN[name] in events.columns}


def write_view(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite a view. ``single_file`` only for bounded (top-N) views."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").parquet(path)


def views_from_grouped(grouped: DataFrame, top_n: int | None = None) -> dict[str, DataFrame]:
    """Split a ``views_single_pass`` result (view, key, edits) into the four
    count views with their own order / limit."""
    def part(view: str, name: str, cast: str = "string") -> DataFrame:
        return (grouped.filter(F.col("view") == view)
                .select(F.col("key").cast(cast).alias(name), "edits"))
    return {
        "wiki_edits": views.top_n(part("wiki", "wiki"), "edits", "wiki", top_n),
        "hourly": part("hour", "hour").orderBy(F.col("hour").asc_nulls_first()),
        "edit_types": views.top_n(part("type", "type"), "edits", "type", None),
        "namespaces": views.top_n(part("namespace", "namespace", "int"), "edits",
                                  "namespace", top_n),
    }


def run_batch(spark: SparkSession, events: DataFrame, out: str,
              top_n: int | None = None, exclude_bots: bool = DEFAULTS.exclude_bots,
              require_input: bool = True, single_pass: bool = True) -> dict[str, str]:
    """Write the five views under ``out``; returns {view: path}.

    Views hold every key unless ``top_n`` cuts them: readers cut after merging.
    Only cut views are written as one file.

    ``single_pass`` (default) reads the history twice instead of five times:
    one GROUPING SETS aggregate for wiki / hour / type / namespace, written
    once as an intermediate table (this also cuts lineage, so the four views
    are cheap reads of a small table), and one keyword explode.

    The first of them also counts the rows it reads and keeps; the counts are stored beside the
    views (``read_counts``). No view is touched if there are no records at all.
    """
    events = with_bot(events)
    out = out.rstrip("/")
    needed = {"wiki", "title", "timestamp", "type", "namespace"}
    if single_pass and needed <= set(events.columns):
        grouped_path = f"{out}/_grouped"
        counts = write_grouped(spark, events, grouped_path, exclude_bots)
        built = views_from_grouped(spark.read.parquet(grouped_path), top_n)
        built["keywords"] = views.keywords(events, top_n, exclude_bots)
    else:
        needs_wiki = events if "wiki" in events.columns else events.withColumn("wiki", F.lit(None).cast("string"))
        counts = views.record_counts(needs_wiki, exclude_bots).first().asDict()
        built = batch_views(events, top_n, exclude_bots)
    if require_input and not counts["total"]:
        raise SystemExit("no input records")
    paths = {}
    for name in VIEW_NAMES:
        if name not in built:
            continue
        path = f"{out}/{name}"
        write_view(built[name], path, single_file=top_n is not None and name in CUT_VIEWS)
        paths[name] = path
    row = spark.createDataFrame([tuple(counts[c] for c in views.COUNT_NAMES)], COUNTS_SCHEMA)
    row.coalesce(1).write.mode("overwrite").parquet(f"{out}/{COUNTS}")
    return paths


def write_grouped(spark: SparkSession, events: DataFrame, path: str, exclude_bots: bool) -> dict[str, int]:
    """Write the GROUPING SETS pass and return its row counts, observed on the way.

    Every kept row is in exactly one type group, so the written table holds the exact number
    of kept rows. If a task ran twice after a lost executor, its rows may have been observed twice: then
    the numbers differ and the rows are counted by a scan of their own.
    """
    seen = Observation()
    watched = events.select("wiki", "bot", "type", "namespace", "timestamp").observe(
        seen, *views.count_columns(exclude_bots))
    views.views_single_pass(watched, exclude_bots).write.mode("overwrite").parquet(path)
    kept = spark.read.parquet(path).where("view = 'type'").agg(F.sum("edits")).first()[0]
    if kept is not None and seen.get["kept"] == kept:
        return seen.get
    return views.record_counts(events, exclude_bots).first().asDict()      # also where a plan without rows observed nothing


def read_counts(spark: SparkSession, out: str) -> DataFrame:
    """(total, after_bot_filter, kept) of the run that wrote the views under ``out``."""
    return spark.read.schema(COUNTS_SCHEMA).parquet(f"{out.rstrip('/')}/{COUNTS}")


def to_bronze(events: DataFrame, path: str) -> None:
    """Raw JSON history -> Parquet partitioned by event date."""
    (events.withColumn("event_date", F.to_date("event_time"))
     .hint("rebalance", "event_date").write.mode("overwrite")
     .partitionBy("event_date").parquet(path))


def arguments(argv: list[str]):
    import argparse

    p = argparse.ArgumentParser(prog="editlens.plans.batch", description="Raw history -> views.")
    p.add_argument("raw")
    p.add_argument("out")
    p.add_argument("--top-n", type=int, default=None, help="cut the ranked views when written (default: keep all keys)")
    p.add_argument("--include-bots", action="store_true")
    p.add_argument("--bronze", help="first convert the raw JSON to date-partitioned Parquet here")
    return p.parse_args(argv)


def main(argv: list[str]) -> None:
    """spark-submit -m editlens.plans.batch <raw> <out> [--top-n N] [--include-bots] [--bronze <path>]

    With ``--bronze`` the views are built from the Parquet table (vectorized, pruned
    scans; later runs can start from it)."""
    from editlens.session import build_session
    from editlens.sources.jsonl import scan_jsonl

    a = arguments(argv[1:])
    spark = build_session(app="editlens-batch")
    raw = scan_jsonl(spark, a.raw, recursive=True)
    events = raw.withColumn("event_time", F.timestamp_seconds("timestamp"))
    if a.bronze:
        to_bronze(events, a.bronze)
        events = spark.read.parquet(a.bronze)
    run_batch(spark, events, a.out, a.top_n, not a.include_bots)
    for name, n in read_counts(spark, a.out).first().asDict().items():
        print(f"{name}: {n}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
