"""SimHash near-dedup by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits, each seen as a
word of the perfect binary Golay code (23 bits, 4096 codewords, radius 3). Two
fingerprints at most 2 bits apart agree exactly in one segment ``a`` and, for
one of the pairs (0,1), (1,2), (2,0) = (a, b), differ in at most one bit of
segment ``b`` (pigeonhole). Words one bit apart always share a codeword within
distance 4, of which a word has 1 or 6. So each fingerprint emits, per pair, the
exact segment joined with the index of every codeword near the other one;
fingerprints with a common key are joined and verified by bit distance.

A key held by more than ``crowded`` fingerprints would give a square of
pairs. Its members link through midpoints instead, which is exact and linear:
two fingerprints are at most 2 bits apart if and only if some word is at most 1
bit away from both.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editlens.llm.graph import components
from editlens.llm.scratch import Scratch, whole_rows

MAX_BITS = 2
SEGMENTS = ((0, 22), (22, 21), (43, 21))      # (shift, bits)
GENERATOR = 0b101011100011                    # x^11+x^9+x^7+x^6+x^5+x+1, of the (23,12) Golay code
CHUNK = 1 << 14


# ------------------------------------------------------------------ fingerprints

def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the ASCII-lower-cased text's word shingles."""
    words = [] if text is None else text.encode("utf-8").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
        n = 1
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        n = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    done = 0
    while done < n:                            # bounded memory for very long texts
        k = min(CHUNK, n - done)
        h = np.fromiter((xxhash.xxh64_intdigest(g, seed) for g, _ in zip(grams, range(k))),
                        np.uint64, k)
        bits = np.unpackbits(h.view(np.uint8).reshape(k, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        done += k
    packed = np.packbits(2 * ones > n, bitorder="little")
    return int(packed.view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """(doc id, fp bigint); whole texts, one pass, no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1)
            fp = [fingerprint(texts[i].as_py(), shingle) for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], ["_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")) \
        .mapInArrow(run, f"_id {kind}, fp bigint")


# ------------------------------------------------------------------ Golay keys

def _syndromes(v: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word by the generator polynomial (11 bits)."""
    v = v.copy()
    for i in range(22, 10, -1):
        v = np.where((v >> i) & 1, v ^ (GENERATOR << (i - 11)), v)
    return v


def _near_errors() -> np.ndarray:
    """For each syndrome the error patterns of weight <= 4 that lead to a
    codeword: one of weight <= 3, and five of weight 4 if that one has weight
    3. Shape (2048, 6), padded with -1."""
    patterns = [0] + [sum(1 << i for i in c) for w in range(1, 5) for c in combinations(range(23), w)]
    err = np.array(patterns, np.int64)
    table, used = np.full((2048, 6), -1, np.int64), np.zeros(2048, np.int64)
    for s, e in zip(_syndromes(err), err):
        table[s, used[s]] = e
        used[s] += 1
    return table


def golay_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """int64 fingerprints -> (row numbers, keys)."""
    table = _near_errors()
    u = fp.view(np.uint64)
    seg = [((u >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in SEGMENTS]
    rows, keys = [], []
    for pair in range(3):
        exact, fuzzy = seg[pair], seg[(pair + 1) % 3]
        err = table[_syndromes(fuzzy)]
        r, k = np.nonzero(err >= 0)
        index = (fuzzy[r] ^ err[r, k]) >> 11    # a codeword is known by its top 12 bits
        rows.append(r)
        keys.append((pair << 40) | (exact[r] << 12) | index)
    return np.concatenate(rows), np.concatenate(keys)


def _keys(fps: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            r, k = golay_keys(fp)
            yield pa.RecordBatch.from_arrays([pa.array(fp[r]), pa.array(k)], ["fp", "key"])

    return fps.select("fp").mapInArrow(run, "fp bigint, key bigint")


def links(fps: DataFrame, scratch: Scratch, max_bits: int = MAX_BITS,
          crowded: int = 32) -> DataFrame:
    """Links (u, v) whose components equal those of "at most ``max_bits``
    differing bits" over distinct fingerprints. ``max_bits`` is 1 or 2."""
    if max_bits not in (1, 2):
        raise ValueError("max_bits must be 1 or 2")
    keys = scratch.table(_keys(fps), "keys")
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = keys.join(sizes, "key")
    small = held.where(F.col("n") <= crowded).select("key", "fp")
    other = small.select("key", F.col("fp").alias("fp2"))
    pairs = (small.join(other, "key").where("fp < fp2")
             .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= max_bits)
             .select(F.col("fp").alias("u"), F.col("fp2").alias("v")))
    many = held.where(F.col("n") > crowded).select("fp").distinct()
    ball = many.select("fp", F.explode(F.array(F.lit(0).cast("long"), *[
        F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])).alias("_flip"))
    ball = ball.select("fp", "_flip", F.col("fp").bitwiseXOR(F.col("_flip")).alias("mid"))
    if max_bits == 1:
        # one of two neighbours is the midpoint itself
        nodes = many.select(F.col("fp").alias("mid"))
        stars = ball.where("_flip <> 0").join(nodes, "mid").select(
            F.col("fp").alias("u"), F.col("mid").alias("v"))
    else:
        ball = scratch.table(ball.select("fp", "mid"), "balls")
        low = ball.groupBy("mid").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n")) \
            .where("n > 1").select("mid", "v")
        stars = ball.join(low, "mid").where("fp <> v").select(F.col("fp").alias("u"), "v")
    return pairs.union(stars).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: id, fp (bigint), component_id = smallest id reachable.

    Null, empty and wordless texts share fingerprint 0 and link like any other.
    Repeated rows give repeated result rows. Null ids take part in linking; a
    component without any id has component_id null. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    marks = scratch.table(fingerprints(docs, id_col, text_col, shingle), "marks")
    distinct = scratch.table(marks.groupBy("fp").agg(F.min("_id").alias("_low")), "distinct")
    roots = components(links(distinct, scratch, max_bits), scratch)
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "_low", F.coalesce("root", "fp").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("_low").alias("component_id"))
    labels = scratch.table(rooted.join(lows, "root").select("fp", "component_id"), "labels")
    return marks.join(labels, "fp").select(
        F.col("_id").alias(id_col), "fp", "component_id")


def hex_fingerprint(col: str = "fp"):
    return F.lpad(F.lower(F.hex(F.col(col))), 16, "0")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, that with the smallest id; all columns
    of ``docs``, of any name. Where rows share that id, one of them (least by text hash)
    stays; a component without ids keeps one row likewise. Null, empty and wordless texts
    are one component; an empty table gives none."""
    scratch = Scratch(docs.sparkSession, "keep")
    row = F.col("row")
    held = whole_rows(docs).withColumn("key", F.xxhash64(row[text_col]))
    groups = near_duplicates(held.select(F.struct(row[id_col].isNull().alias("n"), row[id_col].alias("i"),
                                                  F.col("key").alias("k")).alias("_row"),
                                         row[text_col].alias("_t")), "_row", "_t")
    keep = scratch.table(groups.where(F.col("_row") == F.col("component_id")).groupBy("_row")
                         .agg(F.count(F.lit(1)).alias("many")).select(
        F.col("_row.i").alias("keep_id"), F.col("_row.k").alias("keep_key"), "many"), "keep")
    kept = held.join(keep, row[id_col].eqNullSafe(F.col("keep_id")) & (F.col("key") == F.col("keep_key")))
    if keep.where("many > 1").isEmpty():
        return kept.select("row.*")
    once = kept.where("many = 1").select("row")
    repeated = kept.where("many > 1").dropDuplicates(["keep_id", "keep_key"]).select("row")
    return once.union(repeated).select("row.*")
