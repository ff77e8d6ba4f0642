"""Newline-delimited JSON events: read, write, batch landing, file inventory.

* Reads use the fixed ``RAW_SCHEMA`` (no inference pass, no type drift) and
  ``FAILFAST`` by default, so a malformed line fails the load instead of
  turning into a silently dropped all-null row. A line of more than one
  object, or with text after it, is malformed (Spark's own reader would take
  the first object and drop the rest). Costs are what the validator takes:
  numbers, numeric strings, true and false; NaN and infinity are refused.
* Writes land each batch in its own directory (``batch=<stamp>``) and never
  overwrite; the file committer and task retries replace a client-side retry
  loop, and a partial task output is never visible.
* The inventory lists files (path, size) without reading their content and
  joins per-file event counts computed from the same files.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.constants import RAW_SCHEMA
from adlens.session import path_exists

BATCH_PREFIX = "mmp_events_"
CORRUPT_COLUMN = "_corrupt_record"


def batch_stamp(now: _dt.datetime | None = None) -> str:
    """``mmp_events_YYYYmmdd_HHMMSS`` for a landing run (UTC)."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return f"{BATCH_PREFIX}{now:%Y%m%d_%H%M%S}"


NUMBER_TEXT = r"^\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"


def parse_events(lines: DataFrame, line: str = "value", mode: str = "FAILFAST") -> DataFrame:
    """Raw events from JSON text lines, one object each; blank lines are none.

    Other columns of ``lines`` are kept. ``mode="PERMISSIVE"`` adds
    ``_corrupt_record``, the text of a malformed line.
    """
    if mode.upper() not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError("mode must be 'FAILFAST' or 'PERMISSIVE'")
    fields = [T.StructField(f.name, T.StringType() if f.name == "cost_usd" else f.dataType) for f in RAW_SCHEMA.fields]
    schema = T.StructType([*fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    text, j = F.col(line), F.col("_j")
    others = [c for c in lines.columns if c != line]
    df = lines.filter(F.trim(text) != "").withColumn("_j", F.from_json(text, schema, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN, "allowNonNumericNumbers": "false"}))
    # only lines with something after a brace can hold more than one object: those are parsed as a list
    several = F.when(text.rlike(r"\}\s*\S"), F.coalesce(F.try_variant_get(
        F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$[1]", "variant").isNotNull()
        | F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNull(), F.lit(True))).otherwise(F.lit(False))
    cost = j["cost_usd"]
    number = (F.when(F.lower(cost) == "true", F.lit(1.0)).when(F.lower(cost) == "false", F.lit(0.0))
              .when(cost.rlike(NUMBER_TEXT), F.trim(cost).try_cast("double")))
    bad = (j.isNull() | j[CORRUPT_COLUMN].isNotNull() | several
           | (cost.isNotNull() & (number.isNull() | (F.abs(number) == float("inf")))))
    df = df.withColumn("_bad", F.coalesce(bad, F.lit(True))).withColumn("_cost", number)
    out = [(F.col("_cost") if f.name == "cost_usd" else j[f.name]).alias(f.name) for f in RAW_SCHEMA.fields]
    if mode.upper() == "PERMISSIVE":
        event = F.array(F.struct(*out, F.when(F.col("_bad"), text).alias(CORRUPT_COLUMN)))
    else:
        event = F.array(F.struct(*out))
        event = F.when(F.col("_bad"), F.raise_error(F.concat(F.lit("Malformed event record: "), text))).otherwise(event)
    # The event leaves through a one-element generator: a later filter on its
    # fields then stays above it, where a plain projection would let the
    # optimizer put the whole parse into the filter, several times over.
    return df.select(*others, F.inline(event)).select(*[f.name for f in RAW_SCHEMA.fields],
                                                      *([CORRUPT_COLUMN] if mode.upper() == "PERMISSIVE" else []), *others)


def read_events(spark: SparkSession, path: str, mode: str = "FAILFAST",
                base_path: str | None = None) -> DataFrame:
    """Raw events from JSONL file(s), directory or glob.

    ``mode="PERMISSIVE"`` keeps malformed lines in ``_corrupt_record`` (for
    quarantine) instead of failing. With ``base_path`` set, ``batch=...``
    directories below it become a ``batch`` column (hive-style discovery).
    """
    r = spark.read
    if base_path:
        r = r.option("basePath", base_path)
    return parse_events(r.text(path), mode=mode)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw text lines (``line``) plus the file each came from (``file_path``)."""
    return (spark.read.text(path)
            .select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file_path")))


def write_events(df: DataFrame, path: str, batch: str | None = None,
                 mode: str = "errorifexists", max_records_per_file: int | None = None) -> str:
    """Write raw events as JSONL; one directory per batch, never overwritten.

    Returns the directory written. Null fields are omitted from the objects,
    as the source generator never writes them either.
    """
    target = f"{path.rstrip('/')}/batch={batch}" if batch else path
    w = df.select(*RAW_SCHEMA.fieldNames()).write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.json(target)
    return target


def write_partitioned(df: DataFrame, path: str, partition_col: str,
                      mode: str = "errorifexists") -> str:
    """Land rows under ``<partition_col>=<value>/`` directories in one job.

    A REBALANCE on the partition column lets AQE merge small batches into one
    task and split a batch that holds a third of the data over many tasks of
    the advisory size, so files stay few and no task is overloaded.
    """
    (df.hint("rebalance", partition_col).write.mode(mode)
       .partitionBy(partition_col).json(path))
    return path


def list_files(spark: SparkSession, path: str, glob: str = "*.json*") -> DataFrame:
    """``path``, ``length`` of every file below ``path`` (content not read)."""
    return (spark.read.format("binaryFile")
            .option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true")
            .load(path)
            .select(F.col("path"), F.col("length")))


def file_inventory(spark: SparkSession, path: str, glob: str = "*.json*") -> DataFrame:
    """Per file: path, file name, size in bytes and KB, and event count."""
    files = list_files(spark, path, glob)
    counts = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
              .text(path)
              .groupBy(F.col("_metadata.file_path").alias("file_path"))
              .agg(F.count(F.lit(1)).alias("event_count")))
    # binaryFile paths and metadata paths can differ in URI spelling
    # (file:/x vs file:///x); join on the normalized form.
    norm = lambda c: F.regexp_replace(c, "^([a-zA-Z0-9]+):/+", "$1:/")
    return (files.join(counts, norm(files.path) == norm(counts.file_path), "left")
            .select(F.col("path"),
                    F.regexp_extract(F.col("path"), r"([^/]+)$", 1).alias("file_name"),
                    F.col("length").alias("size_bytes"),
                    F.round(F.col("length") / F.lit(1024.0), 2).alias("size_kb"),
                    F.coalesce(F.col("event_count"), F.lit(0)).cast("long").alias("event_count")))


def with_presence(spark: SparkSession, path: str, expected: DataFrame, batch: str = "batch",
                  glob: str = "*.json*") -> DataFrame:
    """``expected`` with ``present``: whether a file of its batch lies below
    ``path`` (a null batch has none). One listing serves all; no text is read."""
    landed = (list_files(spark, path, glob)
              .select(F.regexp_extract("path", r"/batch=([^/]+)/[^/]+$", 1).alias("_landed")).distinct()
              .withColumn("_here", F.lit(True)))
    return (expected.join(landed, F.col(batch) == F.col("_landed"), "left")
            .withColumn("present", F.coalesce("_here", F.lit(False))).drop("_landed", "_here"))


def file_exists(spark: SparkSession, path: str, name: str) -> bool:
    """True when ``name`` is below ``path``: a name with folders at just that
    place, a bare name in any folder."""
    if path_exists(spark, f"{path.rstrip('/')}/{name}"):
        return True
    return "/" not in name and list_files(spark, path, name).limit(1).count() > 0
