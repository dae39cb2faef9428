"""Row amplification for load tests: one event -> original + clones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editlens.config import DEFAULT_WIKI, DEFAULTS
from editlens.functions import partition_key


def fanout(events: DataFrame, factor: int = DEFAULTS.fanout) -> DataFrame:
    """Each row becomes ``factor`` rows: the original (``_fanout`` NULL, key =
    wiki) and clones 1..factor-1 (``_fanout`` = i, key = 'wiki-i', ``_scale_ts`` =
    epoch seconds at which they were made; NULL on the original).

    The clone key doubles as a salt: a hot wiki spreads over ``factor``
    stream partitions. Works on batch and streaming frames alike.
    """
    f = max(int(factor), 1)
    wiki = F.coalesce(F.col("wiki"), F.lit(DEFAULT_WIKI))
    i = F.explode(F.sequence(F.lit(0), F.lit(f - 1))).alias("_i")
    out = events.select("*", i)
    return out.select(
        *[c for c in events.columns],
        F.when(F.col("_i") > 0, F.col("_i")).alias("_fanout"),
        F.when(F.col("_i") > 0, F.unix_micros(F.current_timestamp()) / F.lit(1e6)).alias("_scale_ts"),
        partition_key(F.when(F.col("_i") > 0, F.concat_ws("-", wiki, F.col("_i").cast("string")))
                      .otherwise(wiki)).alias("pkey"),
    )
