"""Intermediate tables in the cluster's shared folder.

A written table cuts lineage for good: it survives lost executors, and every
later job reads the same rows (sampled range bounds and generated ids stay
fixed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editlens.session import fresh_dir

#: A side is sent to every task only if it has been counted and is this small.
BROADCAST_BYTES = 8 << 20
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """A private folder for the tables of one operator run."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = fresh_dir(spark, name)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back. Shuffle files of the write go as soon as it
        is done: nothing reads them again."""
        path, conf = f"{self.base}/{name}", self.spark.conf
        before = conf.get(SHUFFLE_CLEANUP, None)
        conf.set(SHUFFLE_CLEANUP, "true")
        try:
            df.write.mode("overwrite").parquet(path)
        finally:
            if before is None:
                conf.unset(SHUFFLE_CLEANUP)
            else:
                conf.set(SHUFFLE_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Remove a table that no later step reads."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fs.delete(path, True)


def whole_rows(df: DataFrame) -> DataFrame:
    """One struct column ``row`` with all columns of ``df``: whatever their names are, none can meet a
    column that is added beside. ``select("row.*")`` gives them back."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def sized(df: DataFrame, row_bytes: int | str) -> tuple[DataFrame, bool]:
    """``df`` hinted for broadcast if its measured size is at most
    ``BROADCAST_BYTES``, else unchanged (the join then shuffles). ``row_bytes``
    is a constant per row, or an SQL expression of one row's size."""
    cost = F.lit(row_bytes) if isinstance(row_bytes, int) else F.expr(row_bytes)
    total = df.agg(F.sum(cost.cast("long"))).first()[0] or 0
    small = total <= BROADCAST_BYTES
    return (F.broadcast(df) if small else df), small
