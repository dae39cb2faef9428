"""Polled feeds: explode a feature collection, emit each id once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


FEATURE_FEED = ("features array<struct<id: string, type: string, properties: "
                "struct<title: string, place: string, time: bigint>>>")


def explode_features(feed: DataFrame, array_col: str = "features") -> DataFrame:
    """One row per element of a GeoJSON-style ``features`` array (batch or stream)."""
    return feed.select(F.explode(array_col).alias("f")).select("f.*")


def has_id(id_col: str = "id"):
    """Items without an id (null or empty) are skipped, as a polling client does."""
    return F.coalesce(F.col(id_col).cast("string"), F.lit("")) != ""


def dedupe_by_id(items: DataFrame, id_col: str = "id",
                 order_cols: tuple[str, ...] = ("event_time",)) -> DataFrame:
    """Keep the first occurrence of every id (by ``order_cols``, then row).

    Written as an aggregate (``min_by`` over a struct) rather than
    ``dropDuplicates`` so the kept row is deterministic; partial aggregation
    runs before the shuffle, so a hot id costs one row per map task.
    """
    cols = [c for c in items.columns if c != id_col]
    order = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)],
                     *[F.col(c) for c in cols])
    return (items.filter(has_id(id_col))
            .groupBy(id_col)
            .agg(F.min(order).alias("_first"))
            .select(id_col, *[F.col(f"_first.{c}").alias(c) for c in cols]))
