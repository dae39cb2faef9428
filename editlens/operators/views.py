"""Full-history batch views.

Each view is its own pruned scan -> filter -> partial aggregate -> shuffle
-> final aggregate plan; the raw scan is never cached so column pruning and
filter pushdown reach the files. Count aggregates are combined map-side,
so a hot key (a wiki holding a third of all rows) ships one partial row
per map task, not its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editlens.config import DEFAULTS, STOP_WORDS
from editlens.functions import has_wiki, hour_label, not_bot
from editlens.functions.text import word_matches


def top_n(df: DataFrame, by: str, key: str | list[str], n: int | None) -> DataFrame:
    """Descending top-N with a deterministic tie-break on the key ascending.

    ``orderBy(..).limit(n)`` plans as TakeOrderedAndProject: a per-partition
    top-N, then a merge of n rows per partition -- no full sort.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ordered = df.orderBy(F.col(by).desc(), *[F.col(k).asc_nulls_first() for k in keys])
    return ordered.limit(n) if n is not None else ordered


def batch_population(events: DataFrame, exclude_bots: bool = DEFAULTS.exclude_bots,
                     require_wiki: bool = True) -> DataFrame:
    df = events.filter(not_bot()) if exclude_bots else events
    return df.filter(has_wiki()) if require_wiki else df


def count_by(df: DataFrame, key: str | Column, name: str, value: str = "edits") -> DataFrame:
    k = F.col(key) if isinstance(key, str) else key
    return df.groupBy(k.alias(name)).agg(F.count(F.lit(1)).alias(value))


def wiki_counts(events: DataFrame, exclude_bots: bool = DEFAULTS.exclude_bots) -> DataFrame:
    """Edit counts of all wikis, in no order: (wiki, edits)."""
    return count_by(batch_population(events.select("wiki", "bot"), exclude_bots), "wiki", "wiki")


def wiki_edits(events: DataFrame, n: int | None = DEFAULTS.top_n,
               exclude_bots: bool = DEFAULTS.exclude_bots) -> DataFrame:
    """Top wikis by edit count: (wiki, edits)."""
    return top_n(wiki_counts(events, exclude_bots), "edits", "wiki", n)


def keyword_counts(texts: DataFrame, text_col: str = "title") -> DataFrame:
    """(kw, freq) over all tokens of ``text_col`` (whole texts)."""
    return (texts.select(F.explode(word_matches(text_col)).alias("kw"))
            .filter(~F.col("kw").isin(*STOP_WORDS))
            .groupBy("kw").agg(F.count(F.lit(1)).alias("freq")))


def keywords(events: DataFrame, n: int | None = DEFAULTS.top_n,
             exclude_bots: bool = DEFAULTS.exclude_bots, text_col: str = "title",
             population: bool = True) -> DataFrame:
    """Top title keywords: (kw, freq)."""
    src = batch_population(events, exclude_bots) if population else events
    return top_n(keyword_counts(src.select(text_col), text_col), "freq", "kw", n)


def hourly(events: DataFrame, exclude_bots: bool = DEFAULTS.exclude_bots) -> DataFrame:
    """Edits per UTC hour label, ordered by hour; a NULL timestamp is its own group."""
    pop = batch_population(events.select("wiki", "bot", "timestamp"), exclude_bots)
    return count_by(pop, hour_label("timestamp"), "hour").orderBy(F.col("hour").asc_nulls_first())


def hourly_utc_strict(events: DataFrame, exclude_bots: bool = DEFAULTS.exclude_bots) -> DataFrame:
    """Single-machine twin semantics: no wiki requirement, timestamps coerced
    to numbers with bad values dropped, NULL hour dropped."""
    pop = batch_population(events.select("wiki", "bot", "timestamp"), exclude_bots,
                           require_wiki=False)
    ts = F.col("timestamp").cast("string").try_cast("double")
    hours = pop.select(ts.alias("t")).na.drop(subset=["t"])
    return (count_by(hours, hour_label(F.floor("t")), "hour")
            .orderBy("hour"))


def hour_bucket(events: DataFrame) -> DataFrame:
    """Per-row hour label: (id, hour)."""
    return events.select("id", hour_label("timestamp").alias("hour"))


def edit_types(events: DataFrame, keep_null: bool = True,
               exclude_bots: bool = DEFAULTS.exclude_bots) -> DataFrame:
    """Edit-type breakdown, no limit. ``keep_null=False`` drops the NULL type."""
    pop = batch_population(events.select("wiki", "bot", "type"), exclude_bots)
    if not keep_null:
        pop = pop.filter(F.col("type").isNotNull())
    return top_n(count_by(pop, "type", "type"), "edits", "type", None)


def namespaces(events: DataFrame, n: int | None = DEFAULTS.top_n,
               exclude_bots: bool = DEFAULTS.exclude_bots) -> DataFrame:
    pop = batch_population(events.select("wiki", "bot", "namespace"), exclude_bots)
    return top_n(count_by(pop, "namespace", "namespace"), "edits", "namespace", n)


COUNT_NAMES = ("total", "after_bot_filter", "kept")


def count_columns(exclude_bots: bool = DEFAULTS.exclude_bots) -> list[Column]:
    """Aggregates of the row counts before and after the filters."""
    kept = not_bot() if exclude_bots else F.lit(True)
    return [F.count(F.lit(1)).alias("total"), F.count_if(kept).alias("after_bot_filter"),
            F.count_if(kept & has_wiki()).alias("kept")]


def record_counts(events: DataFrame, exclude_bots: bool = DEFAULTS.exclude_bots) -> DataFrame:
    """Row counts before and after the filters, in one pass."""
    return events.select("bot", "wiki").agg(*count_columns(exclude_bots))


def views_single_pass(events: DataFrame, exclude_bots: bool = DEFAULTS.exclude_bots) -> DataFrame:
    """wiki / hour / type / namespace counts in one GROUPING SETS pass.

    Output (view, key, edits) with the key as a string; untruncated.
    """
    pop = batch_population(events.select("wiki", "bot", "type", "namespace", "timestamp"),
                           exclude_bots)
    g = (pop.select("wiki", hour_label("timestamp").alias("hour"), "type",
                    F.col("namespace").cast("string").alias("namespace"))
         .groupingSets([["wiki"], ["hour"], ["type"], ["namespace"]],
                       "wiki", "hour", "type", "namespace")
         .agg(F.count(F.lit(1)).alias("edits"),
              F.grouping_id("wiki", "hour", "type", "namespace").alias("_gid")))
    view = (F.when(F.col("_gid") == 7, "wiki").when(F.col("_gid") == 11, "hour")
            .when(F.col("_gid") == 13, "type").otherwise("namespace"))
    key = F.coalesce(
        F.when(F.col("_gid") == 7, F.col("wiki")),
        F.when(F.col("_gid") == 11, F.col("hour")),
        F.when(F.col("_gid") == 13, F.col("type")),
        F.when(F.col("_gid") == 14, F.col("namespace")),
    )
    return g.select(view.alias("view"), key.alias("key"), "edits")
