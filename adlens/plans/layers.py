"""Lazy model layers over a driver test-data directory.

``Layers(spark, sf_dir)`` resolves every model by name (one catalog instead
of per-layer schema names). Staging is lazy; the daily groups behind all
grains and marts are computed once per ``Layers`` and written, so any
query over several marts scans the events a single time.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from adlens.operators import marts as M
from adlens.operators import metrics as MET
from adlens.operators.staging import stage_events
from adlens.session import materialize
from adlens.sources.driver_events import raw_events


class Layers:
    def __init__(self, spark: SparkSession, sf_dir: str, mode: str = "strict",
                 load_stamp=False, raw: DataFrame | None = None, check_cost: bool = True, store: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.mode = mode
        self.load_stamp = load_stamp
        self._raw = raw
        self.check_cost = check_cost
        self.store = store

    @cached_property
    def raw(self) -> DataFrame:
        return self._raw if self._raw is not None else raw_events(self.spark, self.sf_dir)

    @cached_property
    def stg_mmp_events(self) -> DataFrame:
        """Lazy, or with ``store`` written once for all that reads it."""
        staged = stage_events(self.raw, self.mode, self.check_cost)
        return materialize(staged, "staged") if self.store else staged

    @cached_property
    def _daily_parts(self) -> DataFrame:
        """Daily groups with exact measures, written once.

        Their size is days x partners x platforms whatever the event volume,
        and every grain and mart is derived from them; writing them to the
        shared checkpoint folder means a plan that needs several marts scans
        the events once, and lineage stops here.
        """
        return materialize(MET.daily_parts(self.stg_mmp_events), "daily-parts")

    @cached_property
    def _grains(self) -> dict[str, DataFrame]:
        return {g: MET.publish(MET.roll_up(self._daily_parts, g), g, self.load_stamp)
                for g in MET.GRAIN_KEY}

    def grain(self, name: str) -> DataFrame:
        """One grain alone, lazily: nothing else shares its daily groups."""
        return MET.publish(MET.roll_up(MET.daily_parts(self.stg_mmp_events), name), name, self.load_stamp)

    @property
    def int_daily_metrics(self) -> DataFrame:
        return self._grains["daily"]

    @property
    def int_weekly_metrics(self) -> DataFrame:
        return self._grains["weekly"]

    @property
    def int_monthly_metrics(self) -> DataFrame:
        return self._grains["monthly"]

    def mart(self, name: str) -> DataFrame:
        return M.MARTS[name](self.int_daily_metrics, self.int_weekly_metrics,
                             self.int_monthly_metrics)

    @property
    def mart_installs_reinstalls(self) -> DataFrame:
        return self.mart("mart_installs_reinstalls")

    @property
    def mart_click_through_rate(self) -> DataFrame:
        return self.mart("mart_click_through_rate")

    @property
    def mart_cost_per_install(self) -> DataFrame:
        return self.mart("mart_cost_per_install")

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)
