"""Substring dedup: passages that an earlier document already has are removed.

A word goes if some window of ``WINDOW`` words covering it also starts in a
document with a smaller id. Four steps, none of which sees all windows at once:

1. Phrases. In every window the least of its ``PHRASE``-word phrases by hash
   stands for it (a minimizer), so equal windows have equal phrases and only about
   two positions in nine are a phrase. A phrase found in two documents recurs; runs
   of windows with a recurring phrase are cut out as short pieces (at most 20 words).
   Equal pieces are one piece with the smallest and largest id that has it.
2. Confirmed passages. A group-by over the pieces' window digests finds the
   windows that two documents have, and for each the piece of its first document:
   that piece owns it.
3. Automata. Pieces are dealt by their phrase. Each phrase's owned windows are compiled into an
   Aho-Corasick automaton over word numbers, and every piece of the phrase is streamed through it: the
   automaton says which of a piece's windows recur, by their words, and which document was first.
   A phrase with over ``GROUP`` pieces is dealt over several automata by window
   digest, a piece going to those of its windows; an automaton with over ``STREAM`` pieces to read is
   compiled by several tasks that share them.
4. Cover. Each document gathers the windows found in an earlier document and
   drops the words they cover.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editlens.llm.scratch import Scratch, sized

WINDOW = 13
PHRASE = 6
REACH = WINDOW - PHRASE + 1     # phrases in a window; also the longest run of one phrase
GROUP = 256                     # pieces of a phrase per automaton, about
STREAM = 4096                   # pieces that one task streams through an automaton, about
PORTION_ROWS = 256
PORTION_BYTES = 1 << 21


def runs(docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase hashes, at * 16 + n, runs of each document): the windows at .. at + n - 1 of a
    document share a phrase."""
    sizes = np.array([len(d) for d in docs], np.int64)
    n = int(sizes.sum())
    if n < WINDOW:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(docs), np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(docs)), np.uint64, n)
    least = h[:n - PHRASE + 1].copy()
    for j in range(1, PHRASE):
        least = least * np.uint64(0x9E3779B97F4A7C15) + h[j:n - PHRASE + 1 + j]
        least ^= least >> np.uint64(31)
    width = 1
    while width < REACH:
        step = min(width, REACH - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    doc = np.repeat(np.arange(len(docs)), sizes)
    pos = np.arange(n) - (np.cumsum(sizes) - sizes)[doc]
    at = np.nonzero((pos + WINDOW <= sizes[doc])[:len(least)])[0]
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(docs), np.int64)
    least = least[at]
    new = np.append(True, (least[1:] != least[:-1]) | (np.diff(at) != 1))
    place = np.arange(len(at))
    new |= (place - np.maximum.accumulate(np.where(new, place, 0))) % REACH == 0     # repeated phrases
    first = np.nonzero(new)[0]
    length = np.diff(np.append(first, len(at)))
    return (least[first].view(np.int64), pos[at[first]] * 16 + length,
            np.bincount(doc[at[first]], minlength=len(docs)))


def portions(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with few rows and few bytes of text; a longer text is one of its own."""
    sizes = [0 if not t.is_valid else len(t.as_buffer()) for t in batch.column(text)]
    lo = held = 0
    for i, size in enumerate(sizes):
        if i > lo and (i - lo == PORTION_ROWS or held + size > PORTION_BYTES):
            yield batch.slice(lo, i - lo)
            lo, held = i, 0
        held += size
    if batch.num_rows > lo:
        yield batch.slice(lo)


def _split(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8").split()


def _phrases(rows: DataFrame) -> DataFrame:
    """(_id, _key, runs array<struct<seed, at>>) of each document with an id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in portions(b, 2):
                seed, at, counts = runs([_split(t.as_py()) for t in part.column(2)])
                ends = np.append(0, np.cumsum(counts)).astype(np.int32)
                item = pa.StructArray.from_arrays([pa.array(seed), pa.array(at)], ["seed", "at"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.ListArray.from_arrays(pa.array(ends), item)],
                    ["_id", "_key", "runs"])

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, _key bigint, runs array<struct<seed:bigint,at:bigint>>")


def _pieces(docs: DataFrame) -> DataFrame:
    """(_doc, _id, at, seed, p1, p2, piece) from documents with their recurring runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in portions(b, 2):
                text: list[bytes] = []
                hits = part.column(3).flatten()
                at = hits.field(1)
                sizes = np.diff(part.column(3).offsets.to_numpy())
                flat, lo = at.to_numpy(zero_copy_only=False), 0
                for i, size in enumerate(sizes.tolist()):
                    words = _split(part.column(2)[i].as_py())
                    mine = flat[lo:lo + size]
                    text += [b" ".join(words[a:a + n + WINDOW - 1])
                             for a, n in zip((mine >> 4).tolist(), (mine & 15).tolist())]
                    lo += size
                names = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, text)), np.int64).reshape(-1, 2)
                of = pa.array(np.repeat(np.arange(part.num_rows), sizes))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(of), part.column(1).take(of), at, hits.field(0),
                     pa.array(names[:, 0].copy()), pa.array(names[:, 1].copy()),
                     pa.array(text, pa.binary()).cast(pa.string())],
                    ["_doc", "_id", "at", "seed", "p1", "p2", "piece"])

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"_doc bigint, _id {kind}, at bigint, seed bigint, p1 bigint, p2 bigint, piece string")


class Recurring:
    """Automaton over the confirmed windows of one phrase, or of its share of them."""

    def __init__(self, owned: list[tuple[str, int, object]]):
        """``owned``: (piece, bits of the windows it owns, id of their first document)."""
        self.number: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for piece, bits, low in owned:
            seq = tuple([self.number.setdefault(w, len(self.number) + 1) for w in piece.split(" ")])
            for k in range(len(seq) - WINDOW + 1):
                if bits >> k & 1:
                    self.automaton.add_word(seq[k:k + WINDOW], low)
        self.automaton.make_automaton()

    def locate(self, piece: str) -> list[tuple[int, object]]:
        """Windows of ``piece`` that recur: (offset in words, id of their first document)."""
        get = self.number.get
        seq = tuple([get(w, 0) for w in piece.split(" ")])
        return [(end - WINDOW + 1, low) for end, low in self.automaton.iter(seq)]


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (seed, part, salt, bits, reads, p1, p2, piece, low) sorted by (seed, part, salt), owners (bits not 0)
    first: compiles each group's automaton and streams the pieces to read through it. Holds the
    owners of one group."""
    key = automaton = None
    owned: list[tuple] = []
    waiting: list[tuple] = []
    out: list[tuple] = []
    kind = None

    def read(p1: int, p2: int, piece: str) -> None:
        found = automaton.locate(piece)
        if found:
            out.append((p1, p2, found))

    def settle() -> None:
        nonlocal automaton
        automaton = Recurring(owned)
        for row in waiting:
            read(*row)

    def flush() -> pa.RecordBatch:
        ends = np.cumsum([0] + [len(f) for _, _, f in out]).astype(np.int32)
        flat = [x for _, _, f in out for x in f]
        item = pa.StructArray.from_arrays([pa.array([o for o, _ in flat], pa.int32()),
                                           pa.array([low for _, low in flat], kind)], ["off", "low"])
        batch = pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
             pa.ListArray.from_arrays(pa.array(ends), item)], ["p1", "p2", "found"])
        out.clear()
        return batch

    for b in batches:
        kind = b.schema.field(8).type
        for seed, part, salt, bits, reads, p1, p2, piece, low in zip(*[c.to_pylist() for c in b.columns]):
            if (seed, part, salt) != key:
                if owned and automaton is None:
                    settle()
                key, automaton, owned, waiting = (seed, part, salt), None, [], []
            if bits:
                owned.append((piece, bits, low))
                if reads:
                    waiting.append((p1, p2, piece))
            elif owned:
                if automaton is None:
                    settle()
                read(p1, p2, piece)
        if out:
            yield flush()
    if owned and automaton is None:
        settle()
    if out:
        yield flush()


def _first_owners(distinct: DataFrame, scratch: Scratch) -> DataFrame:
    """(p1, p2, found array<struct<off, low>>): recurring windows of each distinct piece and the smallest id
    that has them; several rows of a piece have different windows."""
    kind = distinct.schema["low"].dataType.simpleString()
    words = F.split("piece", " ")
    # with the phrase's hash a digest of a window has 128 bits
    digests = F.transform(F.sequence(F.lit(0), F.size("_w") - WINDOW), lambda k: F.xxhash64(F.slice("_w", k + 1, F.lit(WINDOW))))
    confirmed = distinct.withColumn("_w", words).select("seed", "low", "high", "no", F.posexplode(digests).alias("off", "digest")) \
        .groupBy("seed", "digest").agg(F.min(F.struct("low", "no", "off")).alias("first"), F.max("high").alias("high")) \
        .where("first.low < high")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("first.off"))
    owners = scratch.table(confirmed.groupBy(F.col("first.no").alias("no")).agg(F.sum(bit).alias("own")), "owners")

    crowded = distinct.groupBy("seed").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > GROUP)
    crowded = scratch.table(crowded.select("seed", F.ceil(F.col("_n") / GROUP).alias("parts")), "crowded")
    crowded, _ = sized(crowded, 16)
    home = F.transform("_digests", lambda d: F.pmod(d, F.col("parts")))
    # automata that many pieces of a crowded phrase read
    dealt = distinct.select("seed", words.alias("_w")).join(crowded, "seed").withColumn("_digests", digests)
    busy = dealt.select("seed", F.explode(F.array_distinct(home)).alias("part")).groupBy("seed", "part").agg(
        F.count(F.lit(1)).alias("_n")).where(F.col("_n") > STREAM)
    busy = scratch.table(busy.select("seed", "part", F.ceil(F.col("_n") / STREAM).alias("salts")), "busy")
    busy, _ = sized(busy, 24)

    none = F.lit(0).cast("long")
    plain = F.col("parts").isNull()
    rows = distinct.join(owners, "no", "left").withColumn("own", F.coalesce("own", none)).join(crowded, "seed", "left")
    split = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW),
                        lambda k: F.pmod(F.xxhash64(F.slice(words, k + 1, F.lit(WINDOW))), F.col("parts")))
    rows = rows.withColumn("_home", F.when(plain, F.array(none)).otherwise(split)) \
        .withColumn("part", F.explode(F.array_distinct("_home")))
    mine = F.aggregate(F.sequence(F.lit(0), F.size("_home") - 1), none, lambda s, k: s.bitwiseOR(
        F.when(F.get("_home", k) == F.col("part"), F.call_function("shiftleft", F.lit(1).cast("long"), k)).otherwise(none)))
    rows = rows.withColumn("bits", F.when(plain | (F.col("own") == 0), F.col("own")).otherwise(F.col("own").bitwiseAND(mine))) \
        .join(busy, ["seed", "part"], "left").withColumn("salts", F.coalesce("salts", F.lit(1).cast("long"))) \
        .withColumn("_seat", F.pmod(F.xxhash64("no"), F.col("salts")))
    every = F.when(F.col("bits") != 0, F.sequence(none, F.col("salts") - 1)).otherwise(F.array("_seat"))
    rows = rows.withColumn("salt", F.explode(every)).select(
        "seed", "part", "salt", "bits", (F.col("_seat") == F.col("salt")).alias("reads"), "p1", "p2", "piece", "low")
    ordered = rows.repartition("seed", "part", "salt").sortWithinPartitions("seed", "part", "salt", (F.col("bits") == 0))
    return scratch.table(ordered.mapInArrow(_stream, f"p1 bigint, p2 bigint, found array<struct<off:int,low:{kind}>>"), "located")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept (the words that stay,
    joined by one space).

    Null and blank texts have no words. Rows without an id neither lose words nor
    make others lose any. Rows that share an id are one document as far as "smaller
    id" goes: they never remove each other's words. Columns beside id and text are
    ignored.
    """
    scratch = Scratch(docs.sparkSession, "substrings")
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_key"),
                       F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    marked = scratch.table(_phrases(rows.where("_id is not null")).withColumn(
        "_doc", F.monotonically_increasing_id()), "phrases")
    each = marked.select("_doc", "_id", F.explode("runs").alias("r")).select("_doc", "_id", "r.seed", "r.at")
    recurring = each.groupBy("seed").agg(F.min("_id").alias("_lo"), F.max("_id").alias("_hi")) \
        .where("_lo < _hi").select("seed")
    # a table of its own: both sides of the join are then shuffles that AQE can split at a hot phrase
    recurring = scratch.table(recurring, "recurring")
    hits = each.select("_doc", "seed", "at").join(recurring, "seed").groupBy("_doc").agg(
        F.collect_list(F.struct("seed", "at")).alias("hits"))
    names = marked.select("_doc", "_id", "_key")
    # repeated rows have the same runs: one of them stands for all
    hits = scratch.table(hits.join(names, "_doc").groupBy("_id", "_key").agg(
        F.min(F.struct("_doc", "hits")).alias("_one")).select("_id", "_key", "_one._doc", "_one.hits"), "hits")
    scratch.drop("phrases")
    scratch.drop("recurring")
    cut = hits.select("_doc", F.col("_id").alias("_i"), F.col("_key").alias("_k"), "hits").join(
        rows.dropDuplicates(["_id", "_key"]) if _repeats(hits, rows) else rows,
        (F.col("_id") == F.col("_i")) & (F.col("_key") == F.col("_k"))).select("_doc", "_id", "_text", "hits")
    cut = scratch.table(_pieces(cut), "cut")
    # the text is a key too: an aggregate of numbers alone is hashed, not sorted
    distinct = scratch.table(cut.groupBy("p1", "p2", "seed", "piece").agg(
        F.min("_id").alias("low"), F.max("_id").alias("high")).withColumn("no", F.monotonically_increasing_id()), "distinct")
    pieces = scratch.table(cut.select("_doc", "_id", "at", "p1", "p2"), "pieces")
    scratch.drop("cut")
    owners = _first_owners(distinct, scratch)
    scratch.drop("distinct")
    # one bit for each window of the piece that an earlier document has
    mask = F.aggregate(F.filter("found", lambda f: f["low"] < F.col("_id")), F.lit(0).cast("long"),
                       lambda m, f: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), f["off"])))
    gone = pieces.select("_doc", "_id", "at", "p1", "p2").join(owners, ["p1", "p2"]).select(
        "_doc", F.shiftright("at", 4).alias("at"), mask.alias("mask")).where("mask <> 0")
    gone = gone.groupBy("_doc").agg(F.collect_list(F.struct("at", "mask")).alias("gone"))
    gone = scratch.table(hits.select("_doc", F.col("_id").alias("_i"), F.col("_key").alias("_k")).join(gone, "_doc")
                         .select("_i", "_k", "gone"), "gone")
    for name in ("pieces", "located", "hits", "owners", "crowded", "busy"):
        scratch.drop(name)
    full = rows.join(gone, (F.col("_id") == F.col("_i")) & (F.col("_key") == F.col("_k")), "left").select("_id", "_text", "gone")

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                out: list[tuple[int, int, str]] = []
                for t, g in zip(part.column(1), part.column(2)):
                    words = _split(t.as_py())
                    if not g.is_valid:
                        out.append((len(words), 0, b" ".join(words).decode("utf-8")))
                        continue
                    at = g.values.field(0).to_numpy(zero_copy_only=False)
                    bits = g.values.field(1).to_numpy(zero_copy_only=False)
                    steps = np.zeros(len(words) + 1, np.int64)
                    for k in range(REACH):
                        s = at[(bits >> k) & 1 == 1] + k
                        np.add.at(steps, s, 1)
                        np.add.at(steps, s + WINDOW, -1)
                    keep = np.cumsum(steps[:-1]) == 0
                    kept = [w for w, k in zip(words, keep.tolist()) if k]
                    out.append((len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8")))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                     pa.array(cols[2], pa.string())], ["_id", "n_words", "n_removed", "kept"])

    return full.mapInArrow(cover, f"_id {kind}, n_words bigint, n_removed bigint, kept string") \
        .withColumnRenamed("_id", id_col)


def _repeats(hits: DataFrame, rows: DataFrame) -> bool:
    """Whether (id, key) repeats among rows (two narrow counts)."""
    n = rows.select("_id", "_key").groupBy("_id", "_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return not n.isEmpty()
