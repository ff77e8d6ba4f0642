"""Intermediate metrics: counts and costs per period, partner and platform.

All ten measures are counts and sums, so they re-aggregate exactly:

* ``daily_parts`` aggregates staged events once (partial aggregation on the
  map side, so a hot partner/day costs one row per map task, not one per
  event); costs are summed as decimals with a double beside them for what
  decimals can't hold, so no value is lost (``functions.numeric``).
* ``roll_up`` re-sums those parts to weeks or months; its input is
  days x partners x platforms, not events.
* ``publish`` casts to the published types (long counts, double costs).

When daily, weekly and monthly tables are built from the same ``daily_parts``
in one plan, Spark reuses the single daily shuffle (``ReusedExchange``), so
the raw events are scanned once for all three grains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.functions.dates import period_start
from adlens.functions.numeric import cost_parts, joined, sum_parts

GRAIN_KEY = {"daily": "event_date", "weekly": "week_start_date", "monthly": "month_start_date"}
COUNT_MEASURES = ["installs", "reinstalls", "clicks", "impressions"]
COST_MEASURES = ["install_cost", "reinstall_cost", "click_cost", "impression_cost", "total_cost"]
MEASURES = COUNT_MEASURES + COST_MEASURES + ["total_events"]
_TYPE_OF = {"installs": "install", "reinstalls": "reinstall", "clicks": "click",
            "impressions": "impression", "install_cost": "install",
            "reinstall_cost": "reinstall", "click_cost": "click",
            "impression_cost": "impression"}


def _event_aggs(exact: bool) -> list[Column]:
    t = F.col("event_type")
    aggs = [F.count_if(t == _TYPE_OF[m]).alias(m) for m in COUNT_MEASURES]
    for m in COST_MEASURES:
        def of(cost: Column, m: str = m) -> Column:
            return F.when(t == _TYPE_OF[m], cost).otherwise(F.lit(0)) if m in _TYPE_OF else cost
        total = (F.struct(F.sum(of(F.col("_cost.d"))).alias("d"), F.sum(of(F.col("_cost.r"))).alias("r"))
                 if exact else F.sum(of(F.col("_cost"))))
        aggs.append(total.alias(m))
    return aggs + [F.count(F.lit(1)).alias("total_events")]


def grain_parts(staged: DataFrame, grain: str, exact_cost: bool = True) -> DataFrame:
    """Aggregate staged events straight to one grain (one shuffle)."""
    key = GRAIN_KEY[grain]
    return (staged.select(period_start(F.col("event_date"), grain).alias(key),
                          "partner", "platform", "event_type",
                          (cost_parts(F.col("cost_usd")) if exact_cost else F.col("cost_usd")).alias("_cost"))
                  .groupBy(key, "partner", "platform")
                  .agg(*_event_aggs(exact_cost)))


def daily_parts(staged: DataFrame, exact_cost: bool = True) -> DataFrame:
    return grain_parts(staged, "daily", exact_cost)


def roll_up(daily: DataFrame, grain: str) -> DataFrame:
    """Re-sum daily parts (or published daily metrics) to a coarser grain."""
    key = GRAIN_KEY[grain]
    if grain == "daily":
        return daily
    return (daily.select(period_start(F.col("event_date"), grain).alias(key),
                         "partner", "platform", *MEASURES)
                 .groupBy(key, "partner", "platform")
                 .agg(*[(sum_parts(F.col(m)) if _split(daily, m) else F.sum(m)).alias(m) for m in MEASURES]))


def _split(parts: DataFrame, measure: str) -> bool:
    return isinstance(parts.schema[measure].dataType, T.StructType)


def publish(parts: DataFrame, grain: str, load_stamp: bool | Column = True) -> DataFrame:
    """Published column types; ``load_stamp`` adds ``dbt_updated_at``.

    Pass a Column (e.g. a literal as-of time) for a repeatable stamp, or
    False to leave it out (as the compared queries do).
    """
    key = GRAIN_KEY[grain]
    cols = [F.col(key), F.col("partner"), F.col("platform")]
    cols += [F.col(m).cast("long").alias(m) for m in COUNT_MEASURES]
    cols += [(joined(F.col(m)) if _split(parts, m) else F.col(m).cast("double")).alias(m) for m in COST_MEASURES]
    cols += [F.col("total_events").cast("long").alias("total_events")]
    if load_stamp is True:
        cols.append(F.current_timestamp().alias("dbt_updated_at"))
    elif isinstance(load_stamp, Column):
        cols.append(load_stamp.alias("dbt_updated_at"))
    return parts.select(*cols)


def grain_metrics(staged: DataFrame, grain: str, exact_cost: bool = True,
                  load_stamp: bool | Column = True) -> DataFrame:
    """``int_<grain>_metrics`` computed directly from staged events."""
    return publish(grain_parts(staged, grain, exact_cost), grain, load_stamp)


def all_grain_metrics(staged: DataFrame, exact_cost: bool = True,
                      load_stamp: bool | Column = True) -> dict[str, DataFrame]:
    """Daily, weekly and monthly tables from one daily aggregation."""
    daily = daily_parts(staged, exact_cost)
    return {g: publish(roll_up(daily, g), g, load_stamp) for g in GRAIN_KEY}


def present_order(metrics: DataFrame) -> list[Column]:
    """Newest period first, then partner, platform."""
    key = next(k for k in GRAIN_KEY.values() if k in metrics.columns)
    return [F.col(key).desc(), F.col("partner"), F.col("platform")]


def present(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(*present_order(metrics))


def roll_up_published(daily: DataFrame, grain: str, load_stamp: bool | Column = True,
                      exact_cost: bool = True) -> DataFrame:
    """Weekly/monthly metrics from a *published* (double-cost) daily table.

    A daily cost is the double nearest its exact sum; its shortest decimal form
    is that sum again, so the roll-up equals a direct aggregation of the events
    wherever daily sums have at most 15 digits, and is correct to a double's
    precision elsewhere. ``exact_cost=False`` adds the doubles as they are. The
    input is one row per day, partner and platform, never the events.
    """
    parts = daily.select("event_date", "partner", "platform", *COUNT_MEASURES, "total_events",
                         *[(cost_parts(F.col(m)) if exact_cost else F.col(m)).alias(m) for m in COST_MEASURES])
    return publish(roll_up(parts, grain), grain, load_stamp)
