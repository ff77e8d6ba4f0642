"""The model build: staging view -> intermediate tables -> marts -> tests.

``build`` mirrors the layered project: a staging *view* (lazy), three
intermediate *tables* and three mart *tables* (full refresh, Parquet, with
column documentation), then the declared data tests. Layers and tags select
what to build, like a model selector.

Execution plan, chosen for scale:

0. The staged events are written once as a date-partitioned table (or kept
   as a view with ``staging="view"``): the JSON is parsed a single time.
1. One job reads the staged columns it needs and writes the daily table
   (partial aggregation on the map side; the shuffle carries at most one
   row per day/partner/platform per task).
2. The daily sums are written as they add up (decimals and what these can't
   hold, ``int_daily_state``); the daily, weekly and monthly tables are published
   from them, so a roll-up equals a direct aggregation and reads no events.
3. Marts read the written intermediates. Every written table cuts the
   lineage, so a lost executor re-reads files instead of rescanning events.
4. Tests run as one report job per build.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.constants import METRIC_DOCS, STAGED_DOCS, TABLE_DOCS
from adlens.operators import checks as C
from adlens.operators import marts as M
from adlens.operators import metrics as MET
from adlens.operators.incremental import write_partitioned_by_date
from adlens.operators.staging import STAGED_COLUMNS, stage_events, staged_and_rejected
from adlens.session import path_exists, stored
from adlens.sources.tables import create_view, read_table, register_table, with_docs, write_table

LAYERS: dict[str, list[str]] = {
    "staging": ["stg_mmp_events"],
    "intermediate": ["int_daily_metrics", "int_weekly_metrics", "int_monthly_metrics"],
    "marts": ["mart_installs_reinstalls", "mart_click_through_rate", "mart_cost_per_install"],
}
TAGS: dict[str, list[str]] = {
    "staging": ["staging"],
    "intermediate": ["intermediate"],
    "marts": ["marts", "daily_refresh"],
}


def select_models(select: list[str] | None) -> list[str]:
    """Model names for a selection of layer names, tags or model names."""
    if not select:
        return [m for ms in LAYERS.values() for m in ms]
    out: list[str] = []
    for layer, models in LAYERS.items():
        for m in models:
            if m in select or layer in select or any(t in select for t in TAGS[layer]):
                out.append(m)
    return out


@dataclass
class BuildResult:
    tables: dict[str, str] = field(default_factory=dict)
    report: DataFrame | None = None


class BuildFailed(RuntimeError):
    pass


def build(spark: SparkSession, raw: DataFrame, out_dir: str, select: list[str] | None = None,
          mode: str = "strict", load_stamp: bool | Column = True, run_tests: bool = True,
          fail_on_error: bool = False, staging: str = "table",
          exact_cost: bool = True, database: str | None = None) -> BuildResult:
    """Build the selected models under ``out_dir``.

    ``staging="table"`` (default) writes the staged events once, partitioned
    by ``event_date``, so the raw JSON is parsed a single time and every
    later job reads only the Parquet columns it needs. ``staging="view"``
    keeps the staging model lazy, as a view over the raw source.
    The staged table is replaced in full, and the rows it leaves out go to
    ``staging/stg_rejects`` with their reason. ``exact_cost=False`` sums costs
    as doubles at every grain. With ``database`` every built table is also
    entered in that catalog database, with its table and column comments.
    """
    if staging not in ("table", "view"):
        raise ValueError("staging must be 'table' or 'view'")
    models = select_models(select)
    out_dir = out_dir.rstrip("/")
    path = lambda layer, m: f"{out_dir}/{layer}/{m}"
    res = BuildResult()

    stg = with_docs(stage_events(raw, mode), STAGED_DOCS)
    stg_path = path("staging", "stg_mmp_events")
    if staging == "table" and "stg_mmp_events" in models:
        # one parse serves the staged table, replaced in full, and the rejects
        with stored(staged_and_rejected(raw, mode), "staging") as rows:
            kept = rows.filter(F.col("reject_reason").isNull()).select(*STAGED_COLUMNS)
            res.tables["stg_mmp_events"] = write_partitioned_by_date(with_docs(kept, STAGED_DOCS), stg_path, replace_all=True)
            res.tables["stg_rejects"] = write_table(
                rows.filter(F.col("reject_reason").isNotNull()).select("rejected.*", "reject_reason"),
                path("staging", "stg_rejects"))
        if database:
            register_table(spark, f"{database}.stg_mmp_events", stg_path, stg.schema, TABLE_DOCS["stg_mmp_events"], "event_date")
    if staging == "table" and path_exists(spark, stg_path):
        # with the schema: a source without rows leaves a table without files
        stg = spark.read.schema(stg.schema).parquet(stg_path).select(*stg.columns)
    stg = create_view(stg, "stg_mmp_events")
    tables: dict[str, DataFrame] = {"stg_mmp_events": stg}

    def materialize(layer: str, name: str, build_df) -> DataFrame | None:
        """Write a selected model; otherwise use its table if one exists."""
        if name in models:
            df = build_df()
            if df is None:
                raise BuildFailed(f"{name}: an upstream model is neither selected nor built")
            res.tables[name] = write_table(df, path(layer, name), docs=METRIC_DOCS)
        if not path_exists(spark, path(layer, name)):
            return None
        df = read_table(spark, path(layer, name))
        tables[name] = create_view(df, name)
        if database and name in models:
            register_table(spark, f"{database}.{name}", path(layer, name), df.schema, TABLE_DOCS.get(name))
        return df

    state = path("intermediate", "int_daily_state")
    if "int_daily_metrics" in models:
        write_table(MET.daily_parts(stg, exact_cost), state)

    def grain(name: str) -> DataFrame | None:
        """A grain from the stored sums; from the published table where a build of old left no sums."""
        if path_exists(spark, state):
            return MET.publish(MET.roll_up(read_table(spark, state), name), name, load_stamp)
        return daily and MET.roll_up_published(daily, name, load_stamp, exact_cost)

    daily = materialize("intermediate", "int_daily_metrics", lambda: grain("daily"))
    weekly = materialize("intermediate", "int_weekly_metrics", lambda: grain("weekly"))
    monthly = materialize("intermediate", "int_monthly_metrics", lambda: grain("monthly"))
    for name, mart in M.MARTS.items():
        materialize("marts", name,
                    lambda mart=mart: (mart(daily, weekly, monthly)
                                       if all(x is not None for x in (daily, weekly, monthly))
                                       else None))

    if run_tests:
        checks = [c for c in C.DECLARED_CHECKS if c.table in tables]
        report = C.run_checks(tables, checks)
        res.tables["test_report"] = write_table(report, f"{out_dir}/tests/report")
        res.report = read_table(spark, f"{out_dir}/tests/report")
        if fail_on_error and res.report.filter(F.col("status") == "FAIL").limit(1).count():
            raise BuildFailed("data tests failed; see the test report")
    return res
