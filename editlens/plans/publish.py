"""Versioned tables: a writer adds ``v=<n>``, readers take the newest complete one.

Nothing is replaced in place, so a reader never meets a table between delete and
write. A version is complete when its committer has left ``_SUCCESS``; versions before the
previous one are removed. Only folder names are looked at, through the cluster's
file system.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced if it is there."""
    p, fs = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """Content of a small file."""
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def versions(spark: SparkSession, base: str) -> list[int]:
    """Complete versions, oldest first; empty if there is no such folder."""
    p, fs = _fs(spark, base)
    if not fs.exists(p):
        return []
    found = []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if name.startswith("v=") and fs.exists(_fs(spark, f"{base}/{name}/_SUCCESS")[0]):
            found.append(int(name[2:]))
    return sorted(found)


def publish(spark: SparkSession, df: DataFrame, base: str, version: int | None = None) -> int:
    """Write ``df`` as a new version (a retry of the same version rewrites it)."""
    old = versions(spark, base)
    if version is None:
        version = old[-1] + 1 if old else 0
    df.write.mode("overwrite").parquet(f"{base}/v={version}")
    for v in [v for v in old if v < version][:-1]:
        delete(spark, f"{base}/v={v}")
    return version


def current(spark: SparkSession, base: str, schema=None) -> DataFrame | None:
    """The newest complete version, or None."""
    found = versions(spark, base)
    if not found:
        return None
    r = spark.read.schema(schema) if schema is not None else spark.read
    return r.parquet(f"{base}/v={found[-1]}")
