"""Language identification with error-correcting output codes.

Each language has a codeword of B bits. For every bit a binary classifier over
hashed character n-grams says which half of the languages a text comes
from; its weights are the log-odds of an n-gram under the languages whose bit
is 1 against the others. A text's margins are decoded to the codeword of least
loss, each bit weighed by how well it separates the training languages.

The n-gram counts behind the weights are taken over all labelled rows by Spark:
every task folds its rows into one table per language and emits that table
once. The model (languages x ``buckets`` numbers) is the only thing
collected; its size depends on the label set alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editlens.llm.scratch import Scratch, whole_rows

ORDERS = (1, 2, 3)
BUCKETS = 1 << 14
MAX_LANGUAGES = 512      # more distinct labels than this mean the label column is dirty: an error
EVIDENCE = 40            # n-grams beyond which more text adds no more certainty
AMBIGUOUS_BELOW = 0.5    # a decoded score under this is flagged
CHUNK = 1 << 18


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str | None, buckets: int = BUCKETS) -> np.ndarray | None:
    """Hashed n-gram counts of a whole text; None if it has no letter."""
    if not text:
        return None
    total, tail = None, np.empty(0, np.uint32)
    for at in range(0, len(text), CHUNK):
        cp = np.frombuffer(text[at:at + CHUNK].lower().encode("utf-32-le", "replace"), np.uint32)
        letter = _letters()[cp]
        if not letter.any():
            continue
        cp = np.where(letter, cp, np.uint32(32))
        keep = letter.copy()
        keep[1:] |= letter[:-1]                 # one blank after each word
        cp = np.concatenate([tail if len(tail) else np.array([32], np.uint32), cp[keep]])
        out = np.zeros(buckets, np.int64)
        for n in ORDERS:
            if len(cp) < n:
                continue
            h = np.full(len(cp) - n + 1, n, np.uint64)
            for j in range(n):
                h = (h + cp[j:len(cp) - n + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            out += np.bincount((h % np.uint64(buckets)).astype(np.int64), minlength=buckets)
        total = out if total is None else total + out
        tail = cp[-1:]
    return total


def codewords(n: int) -> np.ndarray:
    """(n, B) matrix of 0/1: the exhaustive code for up to 7 languages, else the
    best of a fixed series of random codes by smallest row distance."""
    if n <= 7:
        masks = range(1, 2 ** max(n - 1, 1)) if n > 1 else [1]
        return np.array([[(m >> (n - 2 - i)) & 1 if i < n - 1 else 0 for m in masks]
                         for i in range(n)])
    width, best = 15 * int(np.ceil(np.log2(n))), None
    for seed in range(20):
        c = np.random.default_rng(seed).integers(0, 2, (n, width))
        c = c[:, (c.sum(0) > 0) & (c.sum(0) < n)]
        agree = c @ c.T + (1 - c) @ (1 - c).T
        near = (c.shape[1] - agree + np.eye(n) * width).min()
        if best is None or near > best[0]:
            best = (near, c)
    return best[1]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray        # (languages, bits) of -1 / +1
    weights: np.ndarray     # (buckets, bits)
    trust: np.ndarray       # (bits,) loss weight


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "lang",
          buckets: int = BUCKETS) -> Model:
    """Rows with a null label or without letters teach nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for b in batches:
            for i in range(b.num_rows):
                c = ngram_counts(b.column(0)[i].as_py(), buckets)
                if c is not None:
                    lang = b.column(1)[i].as_py()
                    seen[lang] = seen[lang] + c if lang in seen else c
            if len(seen) > MAX_LANGUAGES:
                raise ValueError(f"more than {MAX_LANGUAGES} distinct labels")
        for lang, c in seen.items():
            at = np.nonzero(c)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(c[at])],
                ["lang", "bucket", "n"])

    rows = (labelled.select(F.col(text_col).cast("string").alias("t"), F.col(label_col).cast("string").alias("l"))
            .where(F.col("l").isNotNull()).mapInArrow(run, "lang string, bucket int, n bigint")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    rows = Scratch(labelled.sparkSession, "langid").table(rows, "counts")      # one pass over the texts
    langs = sorted(r[0] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} distinct labels")
    counts = np.full((len(langs), buckets), 0.5)
    got = rows.toPandas()                       # languages x buckets at most
    np.add.at(counts, (np.searchsorted(langs, got["lang"].to_numpy(dtype=object)) if len(got) else
                       np.empty(0, int), got["bucket"].to_numpy(dtype=int)), got["n"].to_numpy(dtype=float))
    p = counts / counts.sum(1, keepdims=True)
    code = codewords(len(langs)) if langs else np.zeros((0, 1), int)
    if len(langs) < 2:
        return Model(langs, 2 * code - 1, np.zeros((buckets, code.shape[1]), np.float32), np.ones(code.shape[1]))
    ones = code.T @ p / np.maximum(code.sum(0), 1)[:, None]
    zeros = (1 - code).T @ p / np.maximum((1 - code).sum(0), 1)[:, None]
    weights = (np.log(ones) - np.log(zeros)).T
    signed = 2 * code - 1
    expected = np.min(signed * (p @ weights), axis=0)   # worst language's mean margin of each bit
    trust = np.maximum(expected, 1e-3)
    return Model(langs, signed, weights.astype(np.float32), trust / trust.mean())


def decode(counts: np.ndarray | None, model: Model) -> tuple[str, float, bool]:
    """(language, score in [0, 1], ambiguous)."""
    if counts is None or not model.languages:
        return "und", 0.0, True
    if len(model.languages) == 1:
        return model.languages[0], 1.0, False
    at = np.nonzero(counts)[0]
    n = counts[at].sum()
    margin = counts[at] @ model.weights[at] / n
    loss = np.logaddexp(0, -model.code * margin * min(n, EVIDENCE)) @ model.trust
    q = np.exp(loss.min() - loss)
    q /= q.sum()
    best = int(np.argmin(loss))
    return model.languages[best], float(q[best]), bool(q[best] < AMBIGUOUS_BELOW)


def predict(text: Column, model: Model) -> Column:
    """struct(lang_pred string, score double, ambiguous boolean) of a text.
    Null texts and texts without letters give ``und``, score 0, ambiguous; equal texts (repeated
    rows) equal results; very long texts are read whole, in chunks; at a tie the first language wins."""
    buckets = model.weights.shape[0]

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            out = [decode(ngram_counts(t, buckets), model) for t in s]
            yield pd.DataFrame(out, columns=["lang_pred", "score", "ambiguous"])

    return run(text)


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """Documents whose language is clear: neither ``und`` nor ambiguous; all columns of ``docs``, of any
    name. Learns from the labelled documents of ``docs`` that are not held out. Null texts and texts
    without letters go, repeated rows stay or go together, very long texts count as a whole; an empty
    table stays empty. Documents without any label to learn from are an error, as all would go.
    """
    model = train(docs.where(~held_out(F.col(id_col))), text_col, label_col)
    if not model.languages and not docs.isEmpty():
        raise ValueError(f"no document with a value in {label_col!r} to learn a language from")
    rows = whole_rows(docs).withColumn("known", predict(F.col("row")[text_col], model))
    return rows.where(~F.col("known.ambiguous")).select("row.*")


def held_out(id_col: Column) -> Column:
    """True for rows that training never sees."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(4)) == 2, F.lit(False))
