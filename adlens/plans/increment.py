"""Merging staged rows into a stored, date-partitioned table.

``merge_staged`` is what the streaming ingest does per micro-batch and the
batch jobs per run: one row per key, the last sending wins, and only the
touched dates are read and rewritten.

A merge can end anywhere without harm. The new contents of the touched dates
and the dates themselves are first written to ``<table>_journal`` and published
there by one rename; only then are the dates of the table replaced, their key
filters renewed, what depends on them refreshed (``after``), and the entry
deleted. Each of these steps can be repeated: ``recover`` finishes the entries
that an earlier run left, before anything else reads the table. A run that ends
before the rename has changed nothing, and its batch comes again.

A table has one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.operators.incremental import incremental_rows, keyless, upsert, write_partitioned_by_date
from adlens.session import children, delete_path, path_exists, rename_path, stored
from adlens.sources.keyfilter import dates_that_may_hold, write_filters

After = Callable[[list], None]


def drop_dates(spark: SparkSession, path: str, dates: list) -> None:
    for d in dates:
        delete_path(spark, f"{path}/event_date={d}")


def _finish(spark: SparkSession, target: str, entry: str, schema: T.StructType, after: After | None) -> list:
    """Carry out a published entry, from whatever step an earlier run reached."""
    rows = spark.read.schema(schema).parquet(f"{entry}/rows")
    dates = [r.event_date for r in spark.read.parquet(f"{entry}/dates").collect()]  # one row per date
    write_partitioned_by_date(rows, target)
    left = {r.event_date for r in rows.select("event_date").distinct().collect()}
    drop_dates(spark, target, [d for d in dates if d not in left])
    write_filters(spark, rows, f"{target}_keys", dates)
    if after:
        after(dates)
    delete_path(spark, entry)
    return dates


def recover(spark: SparkSession, target: str, schema: T.StructType, after: After | None = None) -> list:
    """Finish the merges that earlier runs published but did not end; their dates."""
    journal, dates = f"{target}_journal", []
    for name in children(spark, journal):
        if name.startswith("entry="):
            dates += _finish(spark, target, f"{journal}/{name}", schema, after)
    delete_path(spark, f"{journal}/_pending")
    return dates


def merge_staged(spark: SparkSession, new: DataFrame, target: str, schema: T.StructType, order: list[str],
                 extra: list[str] | None = None, after: After | None = None) -> list:
    """Merge ``new`` (stored rows) into ``target``; the touched dates.

    Touched are the dates of the new rows and those of earlier rows with one
    of their keys. These are found by the key filters beside the table: only
    the key columns of dates that may hold one of the keys are read.
    ``extra`` columns of ``new`` take part in ``order`` but are not stored.
    """
    recover(spark, target, schema, after)
    held = spark.read.schema(schema).parquet(target)
    dates = earlier_dates(spark, new, held, target)
    # one value per date: a short list
    touched = [r.event_date for r in new.where("event_id IS NOT NULL").select("event_date").union(dates).distinct().collect()]
    if not touched:
        return []
    current = held.filter(F.col("event_date").isin(touched))
    for c in extra or []:
        current = current.withColumn(c, F.lit(None).cast(new.schema[c].dataType))
    merged = upsert(current, new, "event_id", order).select(*schema.fieldNames())
    pending, name = f"{target}_journal/_pending/{uuid.uuid4().hex}", f"entry={uuid.uuid4().hex}"
    merged.write.parquet(f"{pending}/rows")
    spark.createDataFrame([(d,) for d in touched], "event_date date").coalesce(1).write.parquet(f"{pending}/dates")
    rename_path(spark, pending, f"{target}_journal/{name}")
    return _finish(spark, target, f"{target}_journal/{name}", schema, after)


def earlier_dates(spark: SparkSession, new: DataFrame, held: DataFrame, target: str) -> DataFrame:
    """Dates of stored rows that have one of the keys of ``new``."""
    near = dates_that_may_hold(spark, new.select("event_id"), target, f"{target}_keys")
    rows = held.filter(F.col("event_date").isin([F.lit(d).cast("date") for d in near]) if near else F.lit(False))
    return rows.select("event_id", "event_date").join(new.select("event_id").distinct(), "event_id", "left_semi").select("event_date")


def start_table(spark: SparkSession, target: str, schema: T.StructType) -> None:
    """An empty, date-partitioned table where there is none: every merge can
    then read it with its schema, with no probing."""
    if not path_exists(spark, target):
        spark.createDataFrame([], schema).write.mode("append").partitionBy("event_date").parquet(target)


def load_increment(spark: SparkSession, staged: DataFrame, target: str, lookback_days: int = 0,
                   rejects: str | None = None, after: After | None = None) -> list:
    """One batch run: rows newer than the stored table's newest date (minus
    ``lookback_days``) are merged by ``event_id``; the first run loads all.

    The newest date comes from the table's partitions, so the bound reaches a
    date-partitioned source as a partition filter. Rows without an event_id
    are kept with their reason below ``rejects`` (``<target>_rejects``).
    Events that land late for a date already loaded need ``load_landed``,
    which goes by batches instead of dates.
    """
    target = target.rstrip("/")
    start_table(spark, target, staged.schema)
    recover(spark, target, staged.schema, after)
    held = spark.read.schema(staged.schema).parquet(target)
    with stored(incremental_rows(held, staged, lookback_days=lookback_days), "increment") as new:
        nameless = keyless(new).withColumn("reject_reason", F.lit("null_event_id"))
        if not nameless.isEmpty():
            nameless.write.mode("append").parquet(rejects or f"{target}_rejects")
        return merge_staged(spark, new, target, staged.schema, ["event_timestamp"], after=after)
