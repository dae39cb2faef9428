"""The corpus pipeline: each stage is one operator of ``editlens.llm``.

``run`` applies the stages to ``documents``; every stage's rows are written to the
shared folder and read again as the next one's input.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from editlens.llm import decontam, langid, mixing, sharding, simhash  # noqa: E402
from editlens.llm.scratch import Scratch  # noqa: E402


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a clear language: not ``und``, not ambiguous. Learns
    from the labelled documents of its own input that are not held out. Null and letterless texts
    go; repeated rows stay or go together; an empty table stays empty, documents without any label are
    an error. Columns of any name pass through, here and in the stages below."""
    return langid.keep_known(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component one document stays: the one with the smallest id. Null and wordless texts
    are one component; of rows that repeat an id one stays."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go. Null and wordless texts are clean; repeated rows stay or go together;
    an empty benchmark removes nothing."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: 0 to 2 times. Null sources are one source; null and
    blank texts weigh nothing; repeated rows are taken equally often; an empty table gives none."""
    return mixing.apply_mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each document of the mix: one row per row, repeated rows and null ids
    included. Equal texts share a place up to the slack at a cut; an empty table gives none."""
    return sharding.shard(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

# learned and iterative stages have no SQL form; tests/llm holds them against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs
