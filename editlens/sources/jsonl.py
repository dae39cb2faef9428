"""Raw JSONL history scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from editlens.config import WHITE_SPACE
from editlens.schema import EVENT_SCHEMA, STRICT_FILE_GLOB
from editlens.session import ensure_utc

CORRUPT = "_corrupt_record"
LAST = "_editlens_last"


def scan_jsonl(spark: SparkSession, path: str, schema: StructType = EVENT_SCHEMA,
               recursive: bool = False, keep_corrupt: bool = False) -> DataFrame:
    """Full-history scan with an explicit schema in PERMISSIVE mode.

    Every file under ``path`` is read, whatever its name or compression
    (hidden files aside). A malformed line becomes an all-NULL row (it still counts in the total);
    a field of the wrong type is NULL on its own. With ``recursive`` partition
    discovery is off (foreign layouts such as yyyy/mm/dd/HH/); the default
    reads Hive-style ``yyyy=/mm=/dd=/HH=`` folders so partition columns can
    prune the scan.
    """
    ensure_utc(spark)
    if keep_corrupt:
        schema = StructType(schema.fields + [StructField(CORRUPT, StringType(), True)])
    r = (spark.read.schema(schema)
         .option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", CORRUPT))
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.json(path)


def scan_jsonl_strict(spark: SparkSession, path: str, schema: StructType = EVENT_SCHEMA,
                      recursive: bool = True, glob: str = STRICT_FILE_GLOB) -> DataFrame:
    """Scan that drops blank and unparsable lines, keeping only lines that are
    exactly one JSON object (white space of any kind around it aside, no text or second object
    after it).

    A JSON parser stops at the end of the first value, so each line is parsed once
    as the first element of an array that a marker object ends: the line is one
    value if and only if the marker is the second element. Unlike DROPMALFORMED it does not drop a row whose only fault is a field
    of the wrong type: that field is NULL, the row is kept. Duplicate keys are
    accepted (last one wins), as a plain JSON decoder does.
    """
    ensure_utc(spark)
    r = spark.read.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    lines = r.text(path).select(F.btrim("value", F.lit(WHITE_SPACE)).alias("line"))
    marked = ArrayType(StructType(schema.fields + [StructField(LAST, BooleanType(), True)]))
    parsed = lines.filter(F.col("line").startswith("{")).select(
        F.from_json(F.concat(F.lit("["), "line", F.lit(f',{{"{LAST}":true}}]')), marked).alias("a"))
    whole = (F.size("a") == 2) & F.col("a")[0][LAST].isNull() & F.col("a")[1][LAST]
    return parsed.filter(whole).select(F.col("a")[0].alias("e")).select(
        *[F.col(f"e.{f.name}").alias(f.name) for f in schema.fields])


def record_counts_jsonl(df: DataFrame) -> DataFrame:
    """total / malformed / parsed counts of a ``scan_jsonl(keep_corrupt=True)``.

    Blank lines are not records. ``with_id`` also reads a data column, which
    Spark requires before it evaluates the corrupt-record column of raw JSON.
    """
    bad = F.col(CORRUPT).isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(bad).alias("malformed"),
        F.count_if(~bad).alias("parsed"),
        F.count("id").alias("with_id"),
    )
