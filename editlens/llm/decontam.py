"""Benchmark decontamination: prefix-filtered containment join, SQL functions only.

A window (13 consecutive words of a benchmark item, or the whole of a shorter
item) occurs in a document only if every one of its word shingles does. So
the shingles are ordered by rarity over all documents, and a single one per
window, the rarest (the prefix that exact containment needs), is joined with
the documents' shingles. Its position in the window says where the window would
have to start (positional bound) and whether it fits (length bound); what is
left is verified word by word.

Words are runs of [0-9A-Za-z] and non-ASCII characters; comparison is on
texts with A-Z lower-cased. One translation of the text lower-cases A-Z and turns
everything between words into spaces, so that words are cut at spaces, once per pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editlens.llm.scratch import Scratch, sized, whole_rows

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# ASCII characters outside words: \x00-\x2F, \x3A-\x40, \x5B-\x60, \x7B-\x7F
BETWEEN = "".join(c for c in map(chr, range(128)) if not c.isalnum())
WINDOW = 13
SHINGLE = 3


def words(text: str) -> Column:
    """Words of a text (null: none), A-Z lower-cased."""
    spaced = F.translate(F.col(text), BETWEEN + UPPER, " " * len(BETWEEN) + LOWER)
    return F.coalesce(F.array_remove(F.split(spaced, " "), ""), F.array().cast("array<string>"))


def text_key(text: str) -> Column:
    """With the id, names a row's content where ids repeat."""
    return F.xxhash64(F.col(text))


def _windows(items: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(wkey, len, items): distinct windows and the items that hold them."""
    w = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("_item"),
                     words(text_col).alias("_w")).where(F.size("_w") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("_w") - window + 1, F.lit(1))))
    w = w.select("_item", "_w", starts.alias("_at"))
    w = w.select("_item", F.array_join(F.slice("_w", F.col("_at"), F.lit(window)), " ").alias("wkey"))
    return w.groupBy("wkey").agg(F.collect_set("_item").alias("items")).select(
        "wkey", F.size(F.split("wkey", " ")).alias("len"), "items")


def _shingle(words_col: Column, at: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(words_col, at + j) for j in range(k)])


def _prefixes(rows: DataFrame, items: DataFrame, scratch: Scratch, item_col: str, item_text: str,
              window: int) -> tuple[DataFrame | None, list[int], bool]:
    """(wkey, len, items, tok, off): each window that may occur and its rarest
    shingle; the shingle lengths in use; whether the table may be broadcast."""
    windows = scratch.table(_windows(items, item_col, item_text, window), "windows")
    inside = windows.select("wkey", "len", F.split("wkey", " ").alias("_w")).select(
        "*", F.least("len", F.lit(SHINGLE)).alias("_k"))
    ks = sorted(r[0] for r in inside.select("_k").distinct().collect())     # at most SHINGLE values
    toks = None
    for k in ks:
        one = inside.where(F.col("_k") == k).select(
            "*", F.explode(F.sequence(F.lit(0), F.col("len") - k)).alias("off"))
        one = one.select("wkey", "len", "off", _shingle(F.col("_w"), F.col("off"), k).alias("tok"))
        toks = one if toks is None else toks.union(one)
    if toks is None:
        return None, ks, True
    toks = scratch.table(toks, "shingles")
    # rarity over all documents
    vocabulary, _ = sized(scratch.table(toks.select("tok").distinct(), "vocabulary"), 48)
    counts = scratch.table(_doc_shingles(rows.select("_w"), ks).select("tok").join(vocabulary, "tok")
                           .groupBy("tok").agg(F.count(F.lit(1)).alias("n")), "counts")
    # a window with an unseen shingle has no occurrence
    rarest = toks.join(counts, "tok", "left").groupBy("wkey").agg(
        F.min(F.struct("n", "tok", "off")).alias("_a"), F.count(F.when(F.col("n").isNull(), 1)).alias("_unseen"))
    need = windows.join(rarest.where("_unseen = 0"), "wkey").select("wkey", "len", "items", "_a.tok", "_a.off")
    need, small = sized(scratch.table(need, "prefixes"), "2 * length(wkey) + 20 * size(items) + 64")
    return need, ks, small


def _doc_shingles(rows: DataFrame, ks: list[int], heads: bool = False) -> DataFrame:
    """rows (with ``_w``) -> one row per position and shingle length: _pos, tok.
    ``heads``: besides, a row with null tok for each input row."""
    n = F.size("_w")
    # outer without heads too (a wordless row's tok is null): the inner form makes Spark filter by
    # size(_w) below the projection, which cuts every text into words a second time
    at = rows.select("*", F.posexplode_outer("_w").alias("_pos", "_word")).drop("_word")
    toks = [F.when(F.col("_pos") + k <= n, _shingle(F.col("_w"), F.col("_pos"), k)) for k in ks]
    if len(ks) == 1 and not heads:
        return at.withColumn("tok", toks[0]).where("tok is not null")
    if len(ks) == 1:
        # the first position (null without words) is kept twice: as head and as shingle
        at = at.withColumn("_head", F.explode(F.when(F.coalesce("_pos", F.lit(0)) == 0, F.array(F.lit(True), F.lit(False)))
                                              .otherwise(F.array(F.lit(False)))))
        return at.withColumn("tok", F.when(~F.col("_head"), toks[0])).where("_head or tok is not null").drop("_head")
    first = F.when(F.coalesce("_pos", F.lit(0)) == 0, F.lit(True)).otherwise(F.lit(False))
    each = F.array(*([F.struct(first.alias("h"), F.lit(None).cast("long").alias("t"))] if heads else []),
                   *[F.struct(F.lit(False).alias("h"), t.alias("t")) for t in toks])
    at = at.withColumn("_t", F.explode(each)).where("_t.h or _t.t is not null")
    return at.withColumn("tok", F.col("_t.t")).drop("_t")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  share: int = 20) -> DataFrame:
    """One row per input row: id, _key, n_words, n_hit, items (sorted ids as
    strings), contaminated (n_hit > 0 and share * n_hit >= n_words).

    Rows with null or wordless text have n_words 0 and are clean; repeated rows
    get the same result each; columns beside id and text are ignored. Items without
    words are ignored; a null item id counts as the empty string.
    """
    scratch = Scratch(docs.sparkSession, "decontam")
    rows = docs.select(F.col(id_col).alias("_id"), text_key(text_col).alias("_key"), words(text_col).alias("_w"))
    need, ks, small = _prefixes(rows, items, scratch, item_col, item_text, window)
    if need is None:
        return rows.select(F.col("_id").alias(id_col), "_key", F.size("_w").cast("long").alias("n_words"),
                           F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"),
                           F.lit(False).alias("contaminated"))
    # one pass: the shingles that may begin a match, and a head row for each document
    n, start = F.size("_w"), F.col("_pos") - F.col("off")
    found = _doc_shingles(rows, ks, heads=True).withColumn("_n", n)
    bounds = (start >= 0) & (start + F.col("len") <= F.col("_n"))
    same = F.array_join(F.slice("_w", start + 1, F.col("len")), " ") == F.col("wkey")
    span = F.struct(start.alias("start"), (start + F.col("len")).alias("stop"))
    if small:
        met = found.join(need, "tok", "left").where(F.col("tok").isNull() | (bounds & same))
        met = met.select("_id", "_key", "_n", F.when(F.col("tok").isNotNull(), span).alias("span"),
                         F.col("tok").isNull().alias("_head"), "items")
    else:
        # narrow rows through the shuffle; words are fetched again for verification
        near = found.select("_id", "_key", "_pos", "_n", "tok").join(need, "tok").where(bounds)
        again = rows.select(F.col("_id").alias("_id2"), F.col("_key").alias("_key2"), "_w").dropDuplicates(["_id2", "_key2"])
        near = near.join(again, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_key") == F.col("_key2"))).where(same)
        met = near.select("_id", "_key", "_n", span.alias("span"), F.lit(False).alias("_head"), "items").union(
            rows.select("_id", "_key", n.alias("_n"), F.lit(None), F.lit(True), F.lit(None)))
    per_doc = met.groupBy("_id", "_key").agg(
        F.max("_n").cast("long").alias("n_words"), F.count(F.when(F.col("_head"), 1)).alias("_rows"),
        F.array_sort(F.collect_set("span")).alias("_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    # length of the union of the spans, which are sorted by start
    covered = F.aggregate(
        "_spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("last")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["stop"] - F.greatest(s["start"], a["last"]), F.lit(0))).alias("n"),
            F.greatest(a["last"], s["stop"]).alias("last")))["n"]
    out = per_doc.select(F.col("_id").alias(id_col), "_key", F.greatest("n_words", F.lit(0)).alias("n_words"),
                         covered.alias("n_hit"), "items", "_rows")
    out = out.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
    return out.withColumn("_r", F.explode(F.array_repeat(F.lit(0), F.col("_rows").cast("int")))).drop("_rows", "_r")


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without contamination; all columns of ``docs``, of any name. Null and wordless texts
    stay, repeated rows stay or go together; without items or documents nothing changes."""
    bad = decontaminate(docs, items, id_col, text_col).where("contaminated").select(
        F.col(id_col).alias("bad_id"), F.col("_key").alias("bad_key")).distinct()
    row = F.col("row")
    return whole_rows(docs).join(bad, row[id_col].eqNullSafe(F.col("bad_id")) &
                                 (F.xxhash64(row[text_col]) == F.col("bad_key")), "left_anti").select("row.*")
