"""Incremental ingest of landed JSONL batches with Structured Streaming.

The file source remembers which files it has processed (in the query's
checkpoint), so each run with ``availableNow`` picks up exactly the batches
landed since the previous run, however many runs there are, and a failed run
is retried from the last committed offsets. Each micro-batch is merged into a
date-partitioned staged table:

* the batch is parsed and staged once, in quarantine mode, and stored below
  the cluster's checkpoint folder until it is merged; malformed lines (also
  lines of more than one object) keep their text;
* rejects, rows without an ``event_id`` among them, go to
  ``<rejects>/run=<checkpoint>/epoch=<n>``: a retried batch replaces its own
  output and nothing else;
* of several rows of one ``event_id`` the last landed wins (batch folder,
  then event time, then the other columns), within a micro-batch and across
  them, so their number does not matter;
* the dates that the batch or an earlier row of one of its ids falls on are
  read back (static partition filter), merged and written with dynamic
  partition overwrite; a date that an event has left empty is deleted.
  Finding the earlier rows reads the key column only of dates whose key
  filter is hit (``sources.keyfilter``);
* new contents and touched dates are journalled before the table changes
  (``plans.increment``), so a run that ends between the merge and the refresh
  of the daily metrics is finished by the next one.

The default checkpoint and rejects folders are named after the target, so
that later runs go on where the last one ended.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.constants import RAW_SCHEMA
from adlens.operators import metrics as MET
from adlens.operators.incremental import write_partitioned_by_date
from adlens.operators.staging import stage_events, staged_and_rejected
from adlens.plans.increment import drop_dates, merge_staged, recover, start_table
from adlens.session import stored
from adlens.sources.jsonl import parse_events

LANDED = "_landed"  # what orders the sendings of one event


def staged_schema(spark: SparkSession):
    return stage_events(spark.createDataFrame([], RAW_SCHEMA)).schema


def refresh_daily(spark: SparkSession, target: str, touched: list, daily_path: str) -> None:
    """Recompute the daily metrics of the ``touched`` dates from the staged
    table and replace just those ``event_date`` partitions of ``daily_path``.

    Only the touched partitions are read. The sums themselves are kept in
    ``<daily_path>_state``; weekly and monthly metrics rolled up from them
    (``rolled_up``) equal a full rebuild.
    """
    staged = spark.read.schema(staged_schema(spark)).parquet(target).filter(F.col("event_date").isin(touched))
    with stored(MET.daily_parts(staged), "daily-parts") as parts:
        write_partitioned_by_date(parts, _state(daily_path))
        write_partitioned_by_date(MET.publish(parts, "daily", False), daily_path)
        held = {r.event_date for r in parts.select("event_date").distinct().collect()}
    for path in (_state(daily_path), daily_path):
        drop_dates(spark, path, [d for d in touched if d not in held])


def _state(daily_path: str) -> str:
    return f"{daily_path.rstrip('/')}_state"


def rolled_up(spark: SparkSession, daily_path: str, grain: str) -> DataFrame:
    """A grain's metrics from the maintained sums of the days."""
    parts = spark.read.schema(_daily_parts_schema(spark)).parquet(_state(daily_path))
    return MET.publish(MET.roll_up(parts, grain), grain, False)


def read_daily(spark: SparkSession, daily_path: str) -> DataFrame:
    """The incrementally maintained daily table, columns in published order."""
    cols = MET.publish(spark.createDataFrame([], _daily_parts_schema(spark)), "daily", False)
    return spark.read.schema(cols.schema).parquet(daily_path).select(*cols.columns)


def _daily_parts_schema(spark: SparkSession):
    return MET.daily_parts(spark.createDataFrame([], staged_schema(spark))).schema


def merge_batch(spark: SparkSession, batch: DataFrame, target: str, rejects: str, epoch_id: int,
                daily_path: str | None = None) -> None:
    """Merge raw rows into the staged table at ``target``; a ``_landed`` column orders
    the sendings of one event."""
    if LANDED not in batch.columns:
        batch = batch.withColumn(LANDED, F.lit(""))
    with stored(staged_and_rejected(batch, "quarantine", require_id=True, keep=(LANDED,)), "ingest-batch") as rows:
        (rows.filter(F.col("reject_reason").isNotNull()).select("rejected.*", "reject_reason")
         .write.mode("overwrite").parquet(f"{rejects}/epoch={epoch_id}"))
        new = rows.filter(F.col("reject_reason").isNull()).drop("reject_reason", "rejected")
        merge_staged(spark, new, target, staged_schema(spark), [LANDED, "event_timestamp"], [LANDED],
                     refresher(spark, target, daily_path))


def refresher(spark: SparkSession, target: str, daily_path: str | None):
    """What a merge does after replacing dates: refresh their daily metrics."""
    return (lambda dates: refresh_daily(spark, target, dates, daily_path)) if daily_path else None


def ingest(spark: SparkSession, landing_glob: str, target: str, checkpoint: str | None = None,
           rejects: str | None = None, max_files_per_trigger: int | None = None, daily_path: str | None = None) -> None:
    """Process every batch landed under ``landing_glob`` not yet ingested.

    ``max_files_per_trigger`` bounds each micro-batch; ``availableNow`` then
    works through a large backlog in several bounded merges. With
    ``daily_path`` the daily metrics of the dates each micro-batch touched
    are refreshed too (see ``refresh_daily``).
    """
    target = target.rstrip("/")
    checkpoint = checkpoint or f"{target}_checkpoint"
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    rejects = f"{(rejects or target + '_rejects').rstrip('/')}/run={run}"
    start_table(spark, target, staged_schema(spark))
    recover(spark, target, staged_schema(spark), refresher(spark, target, daily_path))
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    path = F.col("_metadata.file_path")
    folder = F.regexp_extract(path, r"/batch=([^/]+)/", 1)
    lines = reader.text(landing_glob).select("value", F.when(folder != "", folder).otherwise(path).alias(LANDED))
    stream = parse_events(lines, mode="PERMISSIVE")
    q = (stream.writeStream
         .foreachBatch(lambda df, epoch: merge_batch(spark, df, target, rejects, epoch, daily_path))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
