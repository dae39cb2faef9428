"""How five document filters interact: every order of them, step by step.

A document's outcome in all 120 orders follows from which filters it fails
(its mask), so a mask is mapped to one wide integer: 600 steps x six counters,
64 bits apart, each 0 or 1. ``n`` documents of the same mask add ``n`` times that
integer, and the integers of a part are summed with ordinary arbitrary-precision
addition. A field is at most the number of documents of its part; the part's
integer carries that number too, and unpacking checks it against the field width,
so no field can have run into its neighbour.

Distribution: one pass over the texts writes a narrow row per document (id, part,
digest, mask). Copies collapse by digest, part and labels before the smallest id of a
digest is joined back, so a text that fills a third of the rows is a few rows there. Masks
are counted per part with map-side combination, so at most 128 short rows a part reach the
task that sums its integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editlens.llm.reduce import mark
from editlens.llm.scratch import Scratch

LETTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(LETTERS)]
STEPS = len(LETTERS)
MIN_WORDS = 200          # A
MIN_DISTINCT = 50        # B: percent of the words
MAX_CAPITALS = 2         # C: percent of the code points
SYMBOLS = "[#$%&*|]"     # D
SPACE = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

COUNTERS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
FIELD_BITS = 64
FIELDS = len(ORDERS) * STEPS * len(COUNTERS)
TOTAL_AT = FIELDS * FIELD_BITS               # the part's number of documents, above all fields
FIELD_MASK = (1 << FIELD_BITS) - 1

RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


def own_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails; ``text`` is not null."""
    words = F.array_remove(F.split(text, SPACE), "")
    n, distinct = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
    length = F.length(text).cast("long")
    capitals = length - F.length(F.translate(text, CAPITALS, "")).cast("long")
    fails = [n < MIN_WORDS, 100 * distinct < MIN_DISTINCT * n, 100 * capitals > MAX_CAPITALS * length,
             text.rlike(SYMBOLS)]
    return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)), F.lit(0)).cast("int")


@lru_cache(1)
def packed() -> list[int]:
    """Wide integer of every (mask, label) pair, at ``4 * mask + 2 * good + toxic``."""
    out = []
    for mask in range(1 << STEPS):
        for good in (0, 1):
            for toxic in (0, 1):
                value, at = 1 << TOTAL_AT, 0
                for order in ORDERS:
                    before = 0
                    for letter in order:
                        bit = 1 << LETTERS.index(letter)
                        fails, gone = bool(mask & bit), bool(mask & before)
                        removed = fails and not gone
                        for hit in (not fails and not gone, removed, fails and gone, mask == bit,
                                    removed and good, removed and toxic):
                            if hit:
                                value |= 1 << at
                            at += FIELD_BITS
                        before |= bit
                out.append(value)
    return out


def unpack(total: int) -> list[list[int]]:
    """Counters of the 600 steps of a part's integer, in the order of ``ORDERS``."""
    documents = total >> TOTAL_AT
    if documents > FIELD_MASK >> 1:
        raise OverflowError(f"{documents} documents in a part do not fit a field")
    raw = (total & ((1 << TOTAL_AT) - 1)).to_bytes(FIELDS * FIELD_BITS // 8, "little")
    step = FIELD_BITS // 8
    flat = [int.from_bytes(raw[i:i + step], "little") for i in range(0, len(raw), step)]
    return [flat[i:i + len(COUNTERS)] for i in range(0, FIELDS, len(COUNTERS))]


def _rows(part: str, total: int) -> pa.RecordBatch:
    steps = unpack(total)
    names = [(order, i + 1, letter) for order in ORDERS for i, letter in enumerate(order)]
    shapley = dict.fromkeys(LETTERS, 0)
    for (_, _, letter), counts in zip(names, steps):
        shapley[letter] += counts[1]
    columns = [pa.array([part] * len(names), pa.string()),
               pa.array([o for o, _, _ in names], pa.string()), pa.array([s for _, s, _ in names], pa.int32())]
    columns += [pa.array([c[i] for c in steps], pa.int64()) for i in range(len(COUNTERS))]
    columns.append(pa.array([shapley[letter] for _, _, letter in names], pa.int64()))
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in RESULT.split(", ")])


def _sum_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, code, n) sorted by part -> the 600 steps of each part. Holds one
    part's integer at a time."""
    words, part, total = packed(), None, 0
    for b in batches:
        for p, code, n in zip(*(b.column(i).to_pylist() for i in range(3))):
            if p != part:
                if total:
                    yield _rows(part, total)
                part, total = p, 0
            total += n * words[code]
    if total:
        yield _rows(part, total)


def facts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per distinct (doc_id, part, text): digest, own failures, labels, and how
    many times it is repeated. Written once, so the texts are read once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
                       own_failures(text).alias("mask"))
    rows = rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    rows = mark(rows, labels, {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}, F.xxhash64("digest"))
    return rows.select("doc_id", "part", "digest", "mask", "n",
                       F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All orders of the filters A to E, per source, over whole ``docs``.

    Needs doc_id, text, source and, in ``labels``, doc_id, quality, toxic; other columns
    are ignored whatever their names. A null text is the empty one, a null source the
    part ``''``. Filter E fails a row whose text a smaller doc_id has too: rows that repeat an
    id pass or fail together, a row without an id passes and makes none fail. A
    document is good (toxic) if any of its label rows says so; a null mark says nothing.
    No documents give no rows. Very long texts count as a whole.
    """
    scratch = Scratch(docs.sparkSession, "filter-audit")
    rows = scratch.table(facts(docs, labels), "facts")
    # copies collapse map-side to a row per (text, part, labels), the smallest id with its repeats kept apart
    groups = rows.groupBy("digest", "part", "mask", "good", "toxic", F.col("doc_id").isNull().alias("anonymous")).agg(
        F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("head"))
    firsts = (groups.where(~F.col("anonymous")).groupBy(F.col("digest").alias("same"))
              .agg(F.min("head.doc_id").alias("first"), F.sum("n").alias("copies")).where(F.col("copies") > 1).drop("copies"))
    stays = (F.when(F.col("anonymous") | F.col("first").isNull(), F.col("n"))
             .when(F.col("head.doc_id") == F.col("first"), F.col("head.n")).otherwise(0))
    code = 4 * F.col("mask") + 2 * F.col("good").cast("int") + F.col("toxic").cast("int")
    split = F.explode(F.array(F.struct(code.alias("code"), stays.alias("n")),
                              F.struct((code + 64).alias("code"), (F.col("n") - stays).alias("n"))))
    counts = (groups.join(firsts, F.col("digest") == F.col("same"), "left").select("part", split.alias("s"))
              .where(F.col("s.n") > 0).groupBy("part", F.col("s.code").alias("code")).agg(F.sum("s.n").alias("n")))
    return (counts.repartition(F.col("part")).sortWithinPartitions("part").select("part", "code", "n")
            .mapInArrow(_sum_parts, RESULT))
