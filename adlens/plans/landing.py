"""Landing job: generate -> validate -> write one stamped JSONL batch.

The Spark form of the generate-and-upload entry point: synthetic events are
drawn once on the executors and written to a pending folder, whose lines are
validated; the batch is dropped when any event is invalid, otherwise it is
renamed to ``<landing>/batch=<stamp>/``, never over an existing one. Only the
two verdict counts reach the driver.

Every landing leaves a manifest beside its batches (``<landing>/_manifests``):
a row per file with its size, events and invalid events, counted by the
validating pass. ``inventory`` reads these alone, so it never reads the text.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.constants import RAW_COLUMNS
from adlens.operators.synth import synth_from_keys
from adlens.operators.validate import validate_lines
from adlens.session import children, delete_path, materialize, path_exists, rename_path
from adlens.sources.jsonl import batch_stamp, list_files, read_lines


class InvalidBatch(ValueError):
    pass


MANIFEST_SCHEMA = "file_name string, size_bytes long, event_count long, invalid_count long, batch string"


def _manifest(spark: SparkSession, pending: str) -> DataFrame:
    """batch, file_name, size_bytes, event_count, invalid_count of each file below
    ``pending``: one validating pass over the lines, sizes from the listing."""
    name = lambda c: F.regexp_extract(c, r"([^/]+)$", 1)
    folder = lambda c: F.regexp_extract(c, r"/batch=([^/]+)/", 1)
    counts = (validate_lines(read_lines(spark, f"{pending}/batch=*")).groupBy("file_path")
              .agg(F.count(F.lit(1)).alias("event_count"), F.count_if(~F.col("is_valid")).alias("invalid_count"))
              .select(folder("file_path").alias("batch"), name("file_path").alias("file_name"), "event_count", "invalid_count"))
    sizes = list_files(spark, pending).select(folder("path").alias("batch"), name("path").alias("file_name"),
                                              F.col("length").alias("size_bytes"))
    none = F.lit(0).cast("long")
    return sizes.join(counts, ["batch", "file_name"], "left").select(
        "file_name", "size_bytes", F.coalesce("event_count", none).alias("event_count"),
        F.coalesce("invalid_count", none).alias("invalid_count"), "batch")


def _publish(spark: SparkSession, pending: str, landing: str, on_invalid: str) -> list[str]:
    """Manifest, then the batches by rename; none where one is invalid or already there."""
    manifest = materialize(_manifest(spark, pending), "manifest")
    batches = [n[len("batch="):] for n in children(spark, pending) if n.startswith("batch=")]
    if on_invalid == "refuse":
        bad = manifest.agg(F.sum("invalid_count")).first()[0]
        if bad:
            raise InvalidBatch(f"{bad} invalid events; batch not landed")
    taken = [b for b in batches if path_exists(spark, f"{landing}/batch={b}")]
    if taken:
        raise FileExistsError(f"{landing}/batch={taken[0]}")
    # a manifest without its batch is no entry: the rename is what lands a batch
    (manifest.hint("rebalance", "batch").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch").parquet(f"{landing}/_manifests"))
    for b in batches:
        rename_path(spark, f"{pending}/batch={b}", f"{landing}/batch={b}")
    return batches


def land_batches(events: DataFrame, landing_dir: str, batch_col: str = "batch", max_records_per_file: int | None = None,
                 on_invalid: str = "refuse") -> list[str]:
    """Write raw ``events`` once, validate the lines as written, and land a batch
    for each value of ``batch_col``, with its manifest.

    Nothing lands where an event is invalid, unless ``on_invalid="keep"``; the
    manifest then tells how many are.
    """
    if on_invalid not in ("refuse", "keep"):
        raise ValueError("on_invalid must be 'refuse' or 'keep'")
    spark, landing = events.sparkSession, landing_dir.rstrip("/")
    pending = f"{landing}/_pending/{uuid.uuid4().hex}"
    try:
        w = (events.select(*RAW_COLUMNS, F.col(batch_col).alias("batch")).hint("rebalance", "batch").write
             .option("maxRecordsPerFile", max_records_per_file or 0).partitionBy("batch"))
        w.json(pending)
        return _publish(spark, pending, landing, on_invalid)
    finally:
        delete_path(spark, pending)


def land_events(events: DataFrame, landing_dir: str, key_col: str,
                batch: str | None = None) -> str:
    """Land ``events`` as one batch, or drop them when any is invalid."""
    batch, landing = batch or batch_stamp(), landing_dir.rstrip("/")
    spark, pending = events.sparkSession, f"{landing}/_pending/{uuid.uuid4().hex}"
    try:
        events.select(*RAW_COLUMNS).write.json(f"{pending}/batch={batch}")
        _publish(spark, pending, landing, "refuse")
    finally:
        delete_path(spark, pending)
    return f"{landing}/batch={batch}"


def inventory(spark: SparkSession, landing_dir: str) -> DataFrame:
    """batch, file_name, size_bytes, size_kb, event_count, invalid_count of every
    landed file, from the manifests."""
    landing = landing_dir.rstrip("/")
    here = [n[len("batch="):] for n in children(spark, landing) if n.startswith("batch=")]
    if not here or not path_exists(spark, f"{landing}/_manifests"):
        rows = spark.createDataFrame([], MANIFEST_SCHEMA)
    else:  # folder names, as written: null is Hive's name for it
        rows = (spark.read.schema(MANIFEST_SCHEMA).parquet(f"{landing}/_manifests")
                .withColumn("batch", F.coalesce("batch", F.lit("__HIVE_DEFAULT_PARTITION__"))).where(F.col("batch").isin(here)))
    return rows.select("batch", "file_name", "size_bytes", F.round(F.col("size_bytes") / F.lit(1024.0), 2).alias("size_kb"),
                       "event_count", "invalid_count")


def land_synthetic(spark: SparkSession, keys: DataFrame, key_col: str, landing_dir: str,
                   days: int = 30, as_of: _dt.datetime = _dt.datetime(2026, 2, 12),
                   seed: int = 42, batch: str | None = None) -> str:
    """One synthetic event per key row, validated and landed as a batch."""
    events = synth_from_keys(keys, key_col, days, as_of, seed)
    return land_events(events, landing_dir, "synth_key", batch)
