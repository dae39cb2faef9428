"""Serving layer: external tables over the views, top-N reads, the merged
view and its CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from editlens.config import DEFAULTS
from editlens.operators import merge, views
from editlens.plans import publish
from editlens.schema import SNAPSHOT_SCHEMA

MERGED_SCHEMA = StructType([StructField("wiki", StringType(), True),
                            StructField("edits_merged", LongType(), True)])


#: of a bucketed view; all views that are merged share it
BUCKETS = 64


def database_location(spark: SparkSession, db: str) -> str:
    from editlens.session import shared_root
    return f"{shared_root(spark)}/editlens/warehouse/{db}.db"


def register_views(spark: SparkSession, db: str, paths: dict[str, str],
                   location: str | None = None) -> list[str]:
    """CREATE DATABASE; DROP + CREATE one external Parquet table per view.

    The database folder defaults to ``<shared root>/warehouse/<db>.db`` (the
    cluster's shared storage), not the driver's working directory.
    """
    location = location or database_location(spark, db)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{location}'")
    names = []
    for name, path in paths.items():
        spark.sql(f"DROP TABLE IF EXISTS `{db}`.`{name}`")
        spark.sql(f"CREATE TABLE `{db}`.`{name}` USING PARQUET LOCATION '{path}'")
        names.append(f"{db}.{name}")
    return names


def write_bucketed(df: DataFrame, table: str, path: str, key: str = "wiki", buckets: int = BUCKETS) -> None:
    """External table of a view with its rows bucketed and sorted by ``key``: later joins on the key
    need no shuffle. One shuffle here keeps it to a file a bucket."""
    db = table.split(".")[0]
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{database_location(df.sparkSession, db)}'")
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path)
     .saveAsTable(table))


def merged_bucketed(spark: SparkSession, batch_table: str, speed_table: str, n: int | None = DEFAULTS.top_n) -> DataFrame:
    """Batch and speed view merged bucket by bucket: both tables are bucketed alike by wiki, so
    the outer join reads each bucket where it lies and exchanges nothing."""
    return merge.lambda_merge_outer(spark.table(batch_table), spark.table(speed_table), n)


def drop_database(spark: SparkSession, db: str) -> None:
    """Forget a database and its external tables; the views' files stay."""
    spark.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")


def table_topn(spark: SparkSession, table: str, n: int = DEFAULTS.top_n,
               key: str = "wiki", value: str = "edits") -> DataFrame:
    """SELECT key, value FROM table ORDER BY value DESC LIMIT n."""
    return views.top_n(spark.table(table).select(key, value), value, key, n)


def batch_view_or_none(spark: SparkSession, table: str) -> DataFrame | None:
    """The batch view, or None when the batch layer has not produced it."""
    return spark.table(table) if spark.catalog.tableExists(table) else None


def write_snapshot(counts: DataFrame, path: str, window_s: int, version: int | None = None) -> None:
    """Publish the speed counts (wiki, count) of every key; they are ranked and cut
    when read."""
    publish.publish(counts.sparkSession, counts.select(
        "wiki", F.col("count").cast("long").alias("count"),
        F.unix_seconds(F.current_timestamp()).alias("ts"),
        F.lit(window_s).cast("int").alias("window_s")), path, version)


def snapshot_counts(spark: SparkSession, path: str) -> DataFrame | None:
    """(wiki, count, ts, window_s) of all keys, or None while nothing is published."""
    return publish.current(spark, path, SNAPSHOT_SCHEMA)


def ranked(snap: DataFrame, n: int) -> DataFrame:
    """Ranks 1..n of snapshot rows: taken over the n rows that are left after the limit."""
    top = views.top_n(snap, "count", "wiki", n)
    rank = F.row_number().over(Window.orderBy(F.col("count").desc(), F.col("wiki").asc_nulls_first()))
    return top.select(rank.alias("rank"), "wiki", "count", "ts", "window_s").orderBy("rank")


def read_snapshot(spark: SparkSession, path: str, n: int = DEFAULTS.top_n) -> DataFrame:
    """Ranks 1..n of the newest snapshot (no rows while there is none)."""
    snap = snapshot_counts(spark, path)
    return ranked(snap if snap is not None else spark.createDataFrame([], SNAPSHOT_SCHEMA), n)


def state_snapshot(spark: SparkSession, checkpoint: str, n: int = DEFAULTS.top_n,
                   window_s: int = DEFAULTS.window_seconds) -> DataFrame:
    """Ranks 1..n straight from the state of a running or stopped ``pane_stream`` query, as of
    its last committed micro-batch."""
    from editlens.streaming.speed import live_panes, state_panes
    counts = live_panes(state_panes(spark, checkpoint), window_s)
    return ranked(counts.select("wiki", "count", F.unix_seconds(F.current_timestamp()).alias("ts"),
                                F.lit(window_s).cast("int").alias("window_s")), n)


def merged_view(spark: SparkSession, batch_table: str, snapshot_path: str,
                n: int = DEFAULTS.top_n) -> DataFrame:
    """Batch view + speed snapshot over all their keys, then the top n. Serves
    what there is if the batch view, the snapshot or both are absent."""
    batch = batch_view_or_none(spark, batch_table)
    speed = snapshot_counts(spark, snapshot_path)
    if batch is None and speed is None:
        batch = merge.empty_view(spark)
    return merge.lambda_merge(batch, speed, n)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header. ``single_file`` funnels the frame into one task:
    only for bounded results such as a top-N view."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite") \
        .option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType = MERGED_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def main(argv: list[str]) -> None:
    """spark-submit -m editlens.plans.serving register <views> <db>
       spark-submit -m editlens.plans.serving serve <db>.<table> <snapshot> [--top-n N] [--csv <path>]"""
    import argparse

    from editlens.plans.batch import VIEW_NAMES
    from editlens.session import build_session

    p = argparse.ArgumentParser(prog="editlens.plans.serving")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("register", help="external tables over the batch views")
    r.add_argument("views")
    r.add_argument("db")
    s = sub.add_parser("serve", help="merged top wikis")
    s.add_argument("table")
    s.add_argument("snapshot")
    s.add_argument("--top-n", type=int, default=DEFAULTS.top_n)
    s.add_argument("--csv")
    a = p.parse_args(argv[1:])
    spark = build_session(app=f"editlens-{a.command}")
    if a.command == "register":
        there = {n: f"{a.views.rstrip('/')}/{n}" for n in VIEW_NAMES}
        print("\n".join(register_views(spark, a.db, {n: v for n, v in there.items()
                                                     if publish.exists(spark, v)})))
    else:
        out = merged_view(spark, a.table, a.snapshot, a.top_n)
        if a.csv:
            export_csv(out, a.csv, single_file=True)
        else:
            out.show(a.top_n, truncate=False)
    spark.stop()


if __name__ == "__main__":
    import sys
    main(sys.argv)
