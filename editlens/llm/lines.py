"""Line dedup: lines spread over many sites are boilerplate. SQL functions only.

Each line hash has a HyperLogLog sketch of the sites it occurs on; sketches merge
in the aggregation, so a line that a third of all documents hold costs one sketch
per task. A line whose estimate lies well above or below ``min_sites`` is
decided by it; the few near the threshold get exact distinct counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editlens.llm.scratch import Scratch, sized

MIN_SITES = 10
LG_K = 12            # sketch of 2^12 registers: standard error about 1.6 %
BAND = 0.2           # estimates within this share of the threshold are counted exactly


def lines(text: str) -> Column:
    return F.split(F.col(text).cast("string"), "\n")


def line_hash(line: Column) -> Column:
    """Null for blank lines, which are never boilerplate. Outer blanks do not count."""
    t = F.trim(line)
    return F.when(t != "", F.xxhash64(t))


def boilerplate(docs: DataFrame, scratch: Scratch, text_col: str = "text", site_col: str = "source",
                min_sites: int = MIN_SITES) -> DataFrame:
    """(h): hashes of the lines found on at least ``min_sites`` sites. A null
    site is no site."""
    seen = docs.select(F.col(site_col).cast("string").alias("_site"), F.explode(lines(text_col)).alias("_line")) \
        .select("_site", line_hash(F.col("_line")).alias("h")).where("h is not null")
    spread = scratch.table(seen.groupBy("h").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("_site", LG_K)).alias("sites"))
        .where(F.col("sites") >= min_sites * (1 - BAND)), "spread")
    sure = spread.where(F.col("sites") > min_sites * (1 + BAND)).select("h")
    near, _ = sized(spread.where(F.col("sites") <= min_sites * (1 + BAND)).select("h"), 48)
    exact = seen.join(near, "h").groupBy("h", "_site").agg(F.lit(1).alias("_x")) \
        .groupBy("h").agg(F.count("_site").alias("n")).where(F.col("n") >= min_sites).select("h")
    return scratch.table(sure.union(exact), "boilerplate")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                min_sites: int = MIN_SITES) -> DataFrame:
    """One row per input row: id, n_lines, n_removed, kept (the lines that stay,
    joined by a newline; null if the text is null).

    An empty text is one blank line. Every occurrence of a boilerplate line goes,
    repeats within a document included. Rows that repeat in id and text get the
    same result each. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    bad, _ = sized(boilerplate(docs, scratch, text_col, site_col, min_sites), 48)
    key = F.xxhash64(F.col(text_col))
    unique = docs.select(F.col(id_col).alias("_id"), key.alias("_key"), F.col(text_col).alias("_text"))
    each = unique.select("_id", "_key", F.posexplode(lines("_text")).alias("_pos", "_line"))
    each = each.withColumn("_h", line_hash(F.col("_line")))
    stay = each.join(bad, F.col("_h") == F.col("h"), "left_anti").select(
        "_id", "_key", F.struct("_pos", "_line").alias("_l"), F.lit(None).cast("int").alias("_lines"), F.lit(0).alias("_head"))
    # a head row for each document, so that one grouping serves those without lines left too
    heads = unique.select("_id", "_key", F.lit(None).alias("_l"),
                          F.when(F.col("_text").isNotNull(), F.size(lines("_text"))).alias("_lines"), F.lit(1).alias("_head"))
    # repeated rows bring the same lines again: one of each position is kept
    per_doc = stay.union(heads).groupBy("_id", "_key").agg(
        F.array_sort(F.collect_set("_l")).alias("_kept"), F.max("_lines").cast("long").alias("_lines"), F.sum("_head").cast("int").alias("_rows"))
    total = F.coalesce("_lines", F.lit(0).cast("long"))
    out = per_doc.withColumn("_r", F.explode(F.array_repeat(F.lit(0), F.col("_rows"))))
    return out.select(F.col("_id").alias(id_col), total.alias("n_lines"),
                      (total - F.size("_kept")).alias("n_removed"),
                      F.when(F.col("_lines").isNotNull(), F.array_join(F.transform("_kept", lambda x: x["_line"]), "\n")).alias("kept"))
