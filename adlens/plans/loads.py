"""Batch loading of landed batches by load marks.

``<table>_loads`` holds a row per landed batch that has been loaded. A run
loads the batches that have none, whatever dates their events fall on, so an
event that lands late for an old date needs no guessed lookback. The mark is
written after the merge: a run that ends between the two loads its batches
again, which changes nothing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.plans.increment import start_table
from adlens.session import children, path_exists
from adlens.sources.jsonl import parse_events
from adlens.streaming.ingest import LANDED, merge_batch, staged_schema

MARK_SCHEMA = "batch string, run string"


def loaded_batches(spark: SparkSession, target: str) -> DataFrame:
    """(batch, run): a row per batch that has been loaded."""
    marks = f"{target.rstrip('/')}_loads"
    if not path_exists(spark, marks):
        return spark.createDataFrame([], MARK_SCHEMA)
    return spark.read.schema(MARK_SCHEMA).parquet(marks).distinct()


def mark_loaded(spark: SparkSession, target: str, batches: list[str], run: str) -> None:
    rows = spark.createDataFrame([(b, run) for b in batches], MARK_SCHEMA)
    rows.coalesce(1).write.mode("append").parquet(f"{target}_loads")


def load_landed(spark: SparkSession, landing: str, target: str, daily_path: str | None = None,
                rejects: str | None = None) -> list[str]:
    """Load every batch below ``landing`` that bears no mark; their names.

    Of several sendings of one event within a run the last batch's wins, across
    runs the later loaded. Rejects go to ``<rejects>/run=<batches>``: a
    repeated run replaces its own.
    """
    landing, target = landing.rstrip("/"), target.rstrip("/")
    start_table(spark, target, staged_schema(spark))
    done = {r.batch for r in loaded_batches(spark, target).collect()}  # one row per batch, as many as folders listed
    batches = [n[len("batch="):] for n in children(spark, landing) if n.startswith("batch=") and n[len("batch="):] not in done]
    if not batches:
        return []
    run = hashlib.sha256("\n".join(batches).encode()).hexdigest()[:16]
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/batch=([^/]+)/", 1)
    lines = spark.read.text([f"{landing}/batch={b}" for b in batches]).select("value", folder.alias(LANDED))
    merge_batch(spark, parse_events(lines, mode="PERMISSIVE"), target,
                f"{(rejects or target + '_rejects').rstrip('/')}/run={run}", 0, daily_path)
    mark_loaded(spark, target, batches, run)
    return batches
