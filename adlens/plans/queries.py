"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables under ``sf_dir`` (through the adapter of
``adlens.sources.driver_events``) and returns a DataFrame over the whole
input; none is capped or sampled. Column names equal the oracle's. Queries
over several grains or marts, builds and loads write tables below the shared
checkpoint folder when they are called; the others stay lazy.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.constants import METRIC_DOCS
from adlens.operators import checks as C
from adlens.operators import incremental as INC
from adlens.operators import reports as R
from adlens.operators import synth as G
from adlens.operators import validate as V
from adlens.operators.ordering import positions
from adlens.operators.staging import rejected_events, rejects_by_reason, stage_events, staged_and_rejected
from adlens.plans import pipeline as P
from adlens.plans.increment import load_increment, merge_staged, start_table
from adlens.plans.landing import inventory, land_batches, land_synthetic
from adlens.plans.layers import Layers
from adlens.plans.loads import load_landed
from adlens.session import materialize, scratch_path, stored
from adlens.sources import jsonl as J
from adlens.sources import tables as TB
from adlens.sources.driver_events import (
    dirty_events, extreme_events, landed_lines, lines_from_raw, raw_events, read_driver_events, validation_lines,
)
from adlens.operators import marts as M
from adlens.operators import metrics as MET
from adlens.streaming.ingest import ingest, merge_batch, read_daily, refresher, rolled_up, staged_schema

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def _model(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Layers(spark, sf_dir).table(name)
    run.__name__ = name
    return run


for _name in ("stg_mmp_events", "mart_installs_reinstalls", "mart_click_through_rate", "mart_cost_per_install"):
    QUERIES[_name] = _model(_name)
for _grain in MET.GRAIN_KEY:
    QUERIES[f"int_{_grain}_metrics"] = lambda s, d, g=_grain: Layers(s, d).grain(g)


@query("int_extreme_costs")
def int_extreme_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Install volumes of every grain where some costs are 4e-7, 1e12 or 1e25."""
    return Layers(spark, sf_dir, raw=extreme_events(spark, sf_dir)).mart_installs_reinstalls


# --- Validation and report queries (V1-V12, dashboard views) ---------------


def _l(spark: SparkSession, sf_dir: str) -> Layers:
    return Layers(spark, sf_dir)


_REPORTS: dict[str, Callable[[Layers], DataFrame]] = {
    "v01_record_count": lambda L: R.record_count(L.stg_mmp_events),
    "v02_event_distribution": lambda L: R.event_distribution(L.stg_mmp_events),
    "v03_partner_distribution": lambda L: R.partner_distribution(L.stg_mmp_events),
    "v04_daily_summary": lambda L: R.daily_summary(L.int_daily_metrics),
    "v05_ctr_stats": lambda L: R.ctr_stats(L.mart_click_through_rate),
    "v06_cpi_stats": lambda L: R.cpi_stats(L.mart_cost_per_install),
    "v07_grain_coverage": lambda L: R.grain_coverage(L.mart_installs_reinstalls,
                                                     L.mart_click_through_rate,
                                                     L.mart_cost_per_install),
    "v08_install_volume": lambda L: R.install_volume(L.mart_installs_reinstalls),
    "v09_cost_efficiency": lambda L: R.cost_efficiency(L.mart_cost_per_install),
    "v10_daily_trend": lambda L: R.daily_trend(L.int_daily_metrics),
    "v12_cost_share": lambda L: R.cost_share(L.stg_mmp_events),
    "rep_avg_ctr": lambda L: R.avg_ctr(L.mart_click_through_rate),
    "rep_daily_installs": lambda L: R.daily_installs_by_partner(L.mart_installs_reinstalls),
    "rep_ctr_platform": lambda L: R.ctr_by_platform(L.mart_click_through_rate),
    "rep_cpi_partner": lambda L: R.cpi_by_partner(L.mart_cost_per_install),
}


def _report(name: str) -> QueryFn:
    build = _REPORTS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(_l(spark, sf_dir))
    run.__name__ = name
    return run


for _name in _REPORTS:
    QUERIES[_name] = _report(_name)


# --- Order and load stamp as data (A8, A9, M12, B4) --------------------------


@query("ord_daily_metrics")
def ord_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _l(spark, sf_dir).grain("daily")
    return positions(daily, *MET.present_order(daily)).select("position", "event_date", "partner", "platform", "total_events")


@query("ord_mart_click_through_rate")
def ord_mart_click_through_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = _l(spark, sf_dir).mart_click_through_rate
    return positions(mart, *M.present_order()).select("position", *M.MART_KEYS, "clicks", "impressions")


@query("ord_ctr_stats")
def ord_ctr_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions(R.ctr_stats(_l(spark, sf_dir).mart_click_through_rate), *R.ctr_order())


@query("ord_cpi_stats")
def ord_cpi_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions(R.cpi_stats(_l(spark, sf_dir).mart_cost_per_install), *R.cpi_order())


@query("int_weekly_stamped")
def int_weekly_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly metrics as of the newest event: a load stamp that a rerun repeats."""
    newest = _l(spark, sf_dir).stg_mmp_events.select(F.max("event_timestamp")).scalar()
    return (Layers(spark, sf_dir, load_stamp=newest).grain("weekly")
            .select("week_start_date", "partner", "platform", "total_events", "dbt_updated_at"))


# --- Data tests (T1-T9) ------------------------------------------------------

_CHECK_TABLES = ("stg_mmp_events", "mart_installs_reinstalls", "mart_click_through_rate",
                 "mart_cost_per_install")


def check_tables(L: Layers) -> dict[str, DataFrame]:
    return {t: L.table(t) for t in _CHECK_TABLES}


def _dirty(spark: SparkSession, sf_dir: str, store: bool = False) -> Layers:
    """Models over defective events, without the cost rule: the tests have failures to find.

    ``store`` writes the staged events once, for tests that read them more than once."""
    return Layers(spark, sf_dir, mode="quarantine", raw=dirty_events(spark, sf_dir), check_cost=False, store=store)


def _dq_rows(test_name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        chk = C.check_by_name(test_name)
        return C.failing_rows(chk, _dirty(spark, sf_dir).table(chk.table))
    run.__name__ = test_name
    return run


QUERIES["dq_unique_event_id"] = _dq_rows("unique_stg_mmp_events_event_id")
QUERIES["dq_cost_non_negative"] = _dq_rows("expression_is_true_stg_mmp_events_cost_usd")
QUERIES["dq_ctr_range"] = _dq_rows("expression_is_true_mart_click_through_rate_ctr_in_0_1")
QUERIES["dq_impressions_ge_clicks"] = _dq_rows(
    "expression_is_true_mart_click_through_rate_impressions_ge_clicks")
QUERIES["dq_ctr_percentage_range"] = _dq_rows(
    "accepted_range_mart_click_through_rate_ctr_percentage")
QUERIES["dq_cpi_direct_non_negative"] = _dq_rows(
    "expression_is_true_mart_cost_per_install_cpi_direct_ge_0")
QUERIES["dq_cpi_blended_ge_direct"] = _dq_rows(
    "expression_is_true_mart_cost_per_install_cpi_blended_ge_direct")


@query("v11_null_audit")
def v11_null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over defective events, so that there are nulls to count."""
    return R.null_audit(_dirty(spark, sf_dir).stg_mmp_events)


@query("dq_not_null")
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = [c for c in C.DECLARED_CHECKS if c.kind == "not_null"]
    return (C.run_checks(check_tables(_dirty(spark, sf_dir, store=True)), specs)
            .select("test_name", "table_name", "column_name", "failures"))


@query("dq_accepted_values")
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    L = _dirty(spark, sf_dir, store=True)
    out = None
    for c in (c for c in C.DECLARED_CHECKS if c.kind == "accepted_values"):
        part = (C.failing_rows(c, L.table(c.table))
                .select(F.lit(c.table).alias("table_name"), F.lit(c.column).alias("column_name"),
                        F.col("value_field").cast("string").alias("value_field"), "n_records"))
        out = part if out is None else out.unionByName(part)
    return out


@query("dq_report")
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.run_checks(check_tables(_dirty(spark, sf_dir, store=True)), C.DECLARED_CHECKS)


# --- Sources, sinks, staging extras (S1-S12, P7-P9, F4) ----------------------


def batch_of(ts: F.Column) -> F.Column:
    """Landing batch of an event: one ``mmp_events_<day>_000000`` per day."""
    return F.concat(F.lit(J.BATCH_PREFIX),
                    F.regexp_replace(F.substring(ts, 1, 10), "-", ""), F.lit("_000000"))


@query("src_jsonl_roundtrip")
def src_jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "jsonl")
    J.write_events(raw_events(spark, sf_dir), out)
    return J.read_events(spark, out)


def _land_by_batch(spark: SparkSession, sf_dir: str) -> str:
    out = scratch_path(spark, "landing")
    raw = raw_events(spark, sf_dir).withColumn("batch", batch_of(F.col("timestamp")))
    J.write_partitioned(raw, out, "batch")
    return out


@query("src_batch_counts")
def src_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _land_by_batch(spark, sf_dir)
    back = J.read_events(spark, out, base_path=out)
    return back.groupBy("batch").agg(F.count(F.lit(1)).alias("event_count"),
                                     R.exact_sum("cost_usd").alias("total_cost"))


@query("src_file_inventory")
def src_file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _land_by_batch(spark, sf_dir)
    return J.file_inventory(spark, out).select(
        F.regexp_extract("path", r"batch=([^/]+)/", 1).alias("batch"),
        "file_name", "size_bytes", "size_kb", "event_count")


@query("src_batch_presence")
def src_batch_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the days from the first event to a week after the last have a landed batch."""
    raw = raw_events(spark, sf_dir)
    day = F.substring("timestamp", 1, 10).cast("date")
    span = raw.agg(F.min(day).alias("a"), F.date_add(F.max(day), 7).alias("b"))
    days = span.select(F.explode(F.sequence("a", "b")).alias("day"))
    expected = days.select("day", batch_of(F.col("day").cast("string")).alias("batch"))
    return J.with_presence(spark, _land_by_batch(spark, sf_dir), expected)


@query("src_file_sizes")
def src_file_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per batch: the sizes of the inventory against the bytes of the lines."""
    out = _land_by_batch(spark, sf_dir)
    batch = F.regexp_extract("path", r"batch=([^/]+)/", 1).alias("batch")
    listed = (J.file_inventory(spark, out).groupBy(batch)
              .agg(F.sum("event_count").alias("event_count"), F.sum("size_bytes").alias("size_bytes")))
    lines = (spark.read.option("recursiveFileLookup", "true").text(out)
             .groupBy(F.regexp_extract(F.col("_metadata.file_path"), r"batch=([^/]+)/", 1).alias("batch"))
             .agg(F.sum(F.octet_length("value") + 1).alias("line_bytes")))
    return listed.join(lines, "batch").select("batch", "event_count", (F.col("size_bytes") == F.col("line_bytes")).alias("size_matches"))


@query("out_column_comments")
def out_column_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments of a built table and its columns, as the catalog has them, with
    the number of values under each (of rows, under the table's own)."""
    name = "mart_cost_per_install"
    db = f"adlens_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'catalog')}'")
    try:
        res = P.build(spark, raw_events(spark, sf_dir), scratch_path(spark, "build"), load_stamp=False,
                      run_tests=False, database=db)
        own = spark.catalog.getTable(f"{db}.{name}").description
        docs = {c.name: c.description for c in spark.catalog.listColumns(f"{db}.{name}")}
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")  # entries only: the tables' files are their own
    entry = lambda c, doc, n: F.struct(F.lit(c).cast("string").alias("column_name"), F.lit(doc).cast("string").alias("comment"),
                                       n.alias("n_values"))
    entries = [entry(None, own, F.count(F.lit(1)))] + [entry(c, d, F.count(c)) for c, d in docs.items()]
    return TB.read_table(spark, res.tables[name]).agg(F.array(*entries).alias("e")).select(F.inline("e"))


@query("out_table_roundtrip")
def out_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "int_daily_metrics")
    TB.write_table(_l(spark, sf_dir).int_daily_metrics, path, docs=METRIC_DOCS)
    return TB.read_table(spark, path)


@query("stg_date_parts")
def stg_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_l(spark, sf_dir).stg_mmp_events
            .groupBy("year", "month", "week", "day_of_week")
            .agg(F.count(F.lit(1)).alias("events"), F.min("event_date").alias("first_date"),
                 F.max("event_date").alias("last_date")))


@query("stg_rejects_by_reason")
def stg_rejects_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects_by_reason(raw_events(spark, sf_dir), mode="quarantine")


@query("stg_rejects_all_reasons")
def stg_rejects_all_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rejected line with its reason, and its text where it is malformed."""
    raw = J.parse_events(landed_lines(spark, sf_dir), "line", mode="PERMISSIVE")
    return rejected_events(raw).select("line_id", "reject_reason", F.col("_corrupt_record").alias("record"))


@query("stg_lines_accounted")
def stg_lines_accounted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """accepted + rejected = lines."""
    raw = J.parse_events(landed_lines(spark, sf_dir), "line", mode="PERMISSIVE")
    return staged_and_rejected(raw, "quarantine").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("reject_reason").isNull()).alias("accepted"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"))


# --- Incremental (X1-X3) -----------------------------------------------------

STG_KEEP = ["event_id", "event_date", "event_type", "partner", "platform", "cost_usd"]


def _split_month(stg: DataFrame) -> F.Column:
    """First day of the newest month in the data: target = before it."""
    return stg.select(F.trunc(F.max("event_date"), "month")).scalar()


def _stored_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged events written once, as a stored table's readers find them."""
    return materialize(_l(spark, sf_dir).stg_mmp_events, "staged")


@query("incr_new_rows")
def incr_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = _stored_staging(spark, sf_dir)
    target = stg.filter(F.col("event_date") < _split_month(stg))
    return INC.incremental_rows(target, stg).select(*STG_KEEP)


@query("incr_merge_by_key")
def incr_merge_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new batch repeats keys (one with a later date) and has rows without one."""
    stg = _stored_staging(spark, sf_dir).select("event_timestamp", *STG_KEEP)
    cut = _split_month(stg)
    e = F.col("event_id").cast("bigint")
    target = stg.filter(F.col("event_date") < cut).withColumn("load_batch", F.lit("initial"))
    new = stg.filter(F.col("event_date") >= F.date_sub(cut, 7)).withColumn("load_batch", F.lit("increment"))
    moved = (new.filter(e % 5 == 0).withColumn("event_timestamp", F.col("event_timestamp") + F.expr("INTERVAL 1 DAY"))
             .withColumn("event_date", F.date_add("event_date", 1)).withColumn("load_batch", F.lit("moved")))
    nameless = new.filter(e % 7 == 0).withColumn("event_id", F.lit(None).cast("string"))
    return INC.upsert(target, new.unionByName(moved).unionByName(nameless), "event_id",
                      ["event_timestamp"]).drop("event_timestamp")


@query("incr_batch_job")
def incr_batch_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batch runs against a stored table: the second adds what is newer."""
    stg = _stored_staging(spark, sf_dir)
    target = scratch_path(spark, "increment")
    load_increment(spark, stg.filter(F.col("event_date") < _split_month(stg)), target)
    load_increment(spark, stg, target)
    return spark.read.schema(stg.schema).parquet(target).select(*STG_KEEP)


@query("incr_landed_late")
def incr_landed_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs by load marks: the second run's batches hold events of every
    date, most of them older than what is stored; no lookback is given."""
    raw = raw_events(spark, sf_dir)
    late = F.coalesce(F.col("event_id").cast("bigint") % 3 == 0, F.lit(False))
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "loaded")
    batch = F.when(late, F.lit("mmp_events_99990101_000000")).otherwise(batch_of(F.col("timestamp")))
    rows = raw.withColumn("batch", batch)
    J.write_partitioned(rows.filter(~late), landing, "batch")
    load_landed(spark, landing, target)
    J.write_partitioned(rows.filter(late), landing, "batch", mode="append")
    load_landed(spark, landing, target)
    load_landed(spark, landing, target)  # every batch bears its mark: nothing to do
    return spark.read.parquet(target).select(*STG_KEEP)


@query("incr_retried_merge")
def incr_retried_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily metrics of a merge that is lost between table and metrics and tried again.

    The second batch sends a fifth of the events a day later, so dates lose
    rows; its first run ends where the metrics would be refreshed."""
    raw = raw_events(spark, sf_dir)
    e, at = F.col("event_id").cast("bigint"), F.to_timestamp_ntz("timestamp", F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))
    moved = raw.filter(e % 5 == 0).withColumn(
        "timestamp", F.date_format(at + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    target, daily_path, rejects = (scratch_path(spark, n) for n in ("retried", "daily", "rejects"))
    schema = staged_schema(spark)
    start_table(spark, target, schema)
    merge_batch(spark, raw, target, rejects, 0, daily_path)

    def lost(dates: list) -> None:
        raise ConnectionError("lost before the metrics were refreshed")

    with stored(stage_events(moved), "moved") as new:
        try:
            merge_staged(spark, new, target, schema, ["event_timestamp"], after=lost)
        except ConnectionError:
            pass
        merge_staged(spark, new, target, schema, ["event_timestamp"], after=refresher(spark, target, daily_path))
    return read_daily(spark, daily_path)


@query("out_partition_pruned")
def out_partition_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stg_by_date")
    INC.write_partitioned_by_date(_l(spark, sf_dir).stg_mmp_events, path)
    back = spark.read.parquet(path)
    newest = back.select(F.max("event_date")).scalar()
    return (back.filter(F.col("event_date") > F.date_sub(newest, 7))
                .groupBy("event_date")
                .agg(F.count(F.lit(1)).alias("events"),
                     R.exact_sum("cost_usd").alias("total_cost")))


# --- Raw-event validator (R1-R11) ---------------------------------------------


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.validate_lines(validation_lines(spark, sf_dir))


_VALIDATOR: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "val_missing_fields": lambda s, d: V.missing_fields(_validated(s, d)),
    "val_errors_by_rule": lambda s, d: V.errors_by_rule(_validated(s, d)),
    "val_batch_counts": lambda s, d: V.batch_verdict(_validated(s, d)),
    "val_first_errors": lambda s, d: V.first_errors(_validated(s, d), "line_id", 10),
    "val_event_distribution": lambda s, d: V.event_distribution(validation_lines(s, d)),
    "val_total_cost": lambda s, d: V.total_cost(validation_lines(s, d)),
    "val_extreme_costs": lambda s, d: V.total_cost(lines_from_raw(extreme_events(s, d))),
    "val_summary": lambda s, d: V.batch_summary(V.parsed_events(_validated(s, d))),
}
QUERIES.update(_VALIDATOR)


# --- Synthetic events (G1-G7) ---------------------------------------------------


def _synth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One synthetic event per driver event key (work grows with the table)."""
    return G.synth_from_keys(read_driver_events(spark, sf_dir), "event_id")


QUERIES["gen_events"] = lambda s, d: _synth(s, d)
QUERIES["gen_weighted_choice"] = lambda s, d: G.value_counts(_synth(s, d))
QUERIES["gen_distribution_check"] = lambda s, d: G.distribution_check(_synth(s, d))


# --- Pipeline build and streaming ingest (S8-S11, X1-X3 as a stream) -------------


def _build(spark: SparkSession, sf_dir: str, select=None) -> P.BuildResult:
    return P.build(spark, raw_events(spark, sf_dir), scratch_path(spark, "build"),
                   select=select, load_stamp=False)


@query("build_mart_click_through_rate")
def build_mart_click_through_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart as written by the layered build (roll-ups from the written daily table)."""
    res = _build(spark, sf_dir, select=None)
    return TB.read_table(spark, res.tables["mart_click_through_rate"])


@query("build_extreme_weekly")
def build_extreme_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly metrics that a build rolled up from its stored daily sums, where
    some costs are 4e-7, 1e12 or 1e25."""
    res = P.build(spark, extreme_events(spark, sf_dir), scratch_path(spark, "build"), select=["staging", "intermediate"],
                  load_stamp=False, run_tests=False)
    return TB.read_table(spark, res.tables["int_weekly_metrics"])


@query("build_int_monthly_metrics")
def build_int_monthly_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = _build(spark, sf_dir, select=["intermediate"])
    return TB.read_table(spark, res.tables["int_monthly_metrics"])


@query("build_refresh_replaces")
def build_refresh_replaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A build over a shrunk source leaves nothing of the one before it."""
    raw, out = raw_events(spark, sf_dir), scratch_path(spark, "build")
    newest = raw.select(F.max(F.substring("timestamp", 1, 7))).scalar()
    P.build(spark, raw, out, load_stamp=False, run_tests=False)
    res = P.build(spark, raw.filter(F.substring("timestamp", 1, 7) < newest), out, load_stamp=False, run_tests=False)
    staged = Layers(spark, sf_dir).stg_mmp_events.schema
    return (spark.read.schema(staged).parquet(res.tables["stg_mmp_events"]).groupBy("event_date")
            .agg(F.count(F.lit(1)).alias("events")))


@query("build_view_staging")
def build_view_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same marts over a lazy staging view."""
    res = P.build(spark, raw_events(spark, sf_dir), scratch_path(spark, "build"), load_stamp=False,
                  run_tests=False, staging="view")
    return TB.read_table(spark, res.tables["mart_installs_reinstalls"])


@query("build_test_report")
def build_test_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _build(spark, sf_dir).report


def _two_landings(spark: SparkSession, sf_dir: str, daily_path: str | None = None) -> str:
    """Land events in two runs, ingesting each; returns the staged target's path.

    The second run re-sends a day, then some of its events a day later (the
    last sending counts) and some without an id (rejected)."""
    raw = raw_events(spark, sf_dir).withColumn("batch", batch_of(F.col("timestamp")))
    month = F.substring(F.col("timestamp"), 1, 7)
    first_month = raw.select(F.min(month)).scalar()
    last_day_first = raw.filter(month == first_month).select(F.max("batch")).scalar()
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "staged")
    J.write_partitioned(raw.filter(month == first_month), landing, "batch")
    ingest(spark, f"{landing}/batch=*", target, daily_path=daily_path)
    again = raw.filter(F.col("batch") == last_day_first)
    e = F.col("event_id").cast("bigint")
    at = F.to_timestamp_ntz("timestamp", F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))
    late = (again.filter(e % 11 == 0).withColumn("batch", F.lit("mmp_events_99991231_000000"))
            .withColumn("timestamp", F.date_format(at + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    nameless = again.filter(e % 13 == 0).withColumn("event_id", F.lit(None).cast("string"))
    second = raw.filter(~F.coalesce(month == first_month, F.lit(False))).unionByName(again).unionByName(late).unionByName(nameless)
    J.write_partitioned(second, landing, "batch", mode="append")
    ingest(spark, f"{landing}/batch=*", target, daily_path=daily_path)
    return target


@query("incr_stream_ingest")
def incr_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two incremental runs; the target holds the last sending of every event."""
    return spark.read.parquet(_two_landings(spark, sf_dir)).select(*STG_KEEP)


@query("incr_stream_marts")
def incr_stream_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CTR mart over daily metrics maintained per micro-batch (only the
    touched dates are recomputed); equals a full rebuild."""
    daily_path = scratch_path(spark, "daily")
    _two_landings(spark, sf_dir, daily_path)
    daily = read_daily(spark, daily_path)
    return M.mart_click_through_rate(daily, rolled_up(spark, daily_path, "weekly"),
                                     rolled_up(spark, daily_path, "monthly"))


# --- Landing job (generate -> validate -> stamped JSONL batch) -------------------


@query("gen_landed_batch")
def gen_landed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic events for every driver event key, validated, landed as a
    stamped batch and read back with the fixed raw schema."""
    landing = scratch_path(spark, "landing")
    path = land_synthetic(spark, read_driver_events(spark, sf_dir), "event_id", landing)
    return J.read_events(spark, path)


@query("src_inventory_by_batch")
def src_inventory_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file inventory rolled up per landed batch: files, bytes, events."""
    inv = src_file_inventory(spark, sf_dir)
    return inv.groupBy("batch").agg(F.sum("event_count").alias("event_count"),
                                    (F.sum("size_bytes") > 0).alias("has_bytes"))


FILE_EVENTS = 1000


@query("src_landing_manifest")
def src_landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings of batches, read back from their manifests: no line is read again."""
    raw = raw_events(spark, sf_dir).withColumn("batch", batch_of(F.col("timestamp")))
    landing = scratch_path(spark, "landing")
    early = F.coalesce(F.dayofmonth(F.to_timestamp_ntz("timestamp", F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))) < 15, F.lit(False))
    for part in (early, ~early):
        land_batches(raw.filter(part), landing, "batch", max_records_per_file=FILE_EVENTS, on_invalid="keep")
    return (inventory(spark, landing).groupBy("batch")
            .agg(F.count(F.lit(1)).alias("files"), F.sum("event_count").alias("event_count"),
                 F.sum("invalid_count").alias("invalid_count"), (F.min("size_bytes") > 0).alias("has_bytes")))
