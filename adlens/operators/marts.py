"""Marts: one row per grain, period, partner and platform.

Each mart is a narrow projection over the three intermediate tables, tagged
with its grain and stacked with ``unionByName``. Ratios are computed only
here, from re-summed counts and costs (a ratio is never averaged up), with
null-on-zero division and a denominator filter that Catalyst pushes below the
union.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions.numeric import round_half_up, safe_divide
from adlens.operators.metrics import GRAIN_KEY

MART_KEYS = ["grain", "period", "partner", "platform"]


def _over_grains(daily: DataFrame, weekly: DataFrame, monthly: DataFrame,
                 build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    parts = []
    for grain, df in (("daily", daily), ("weekly", weekly), ("monthly", monthly)):
        tagged = df.select(F.lit(grain).alias("grain"),
                           F.col(GRAIN_KEY[grain]).cast("string").alias("period"),
                           *[c for c in df.columns if c not in (GRAIN_KEY[grain],)])
        parts.append(build(tagged))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _installs_reinstalls(df: DataFrame) -> DataFrame:
    total_cost = F.col("install_cost") + F.col("reinstall_cost")
    return df.select(*MART_KEYS, "installs", "reinstalls",
                     (F.col("installs") + F.col("reinstalls")).alias("total_install_events"),
                     total_cost.alias("total_install_cost"),
                     round_half_up(total_cost, 2).alias("total_install_cost_rounded"))


def _click_through_rate(df: DataFrame) -> DataFrame:
    ctr = safe_divide(F.col("clicks"), F.col("impressions"))
    return (df.filter(F.col("impressions") > 0)
              .select(*MART_KEYS, "clicks", "impressions", ctr.alias("ctr"),
                      round_half_up(ctr * 100, 2).alias("ctr_percentage")))


def _cost_per_install(df: DataFrame) -> DataFrame:
    direct = safe_divide(F.col("install_cost"), F.col("installs"))
    blended = safe_divide(F.col("total_cost"), F.col("installs"))
    return (df.filter(F.col("installs") > 0)
              .select(*MART_KEYS, "installs", "install_cost", "total_cost",
                      direct.alias("cpi_direct"), blended.alias("cpi_blended"),
                      round_half_up(direct, 2).alias("cpi_direct_rounded"),
                      round_half_up(blended, 2).alias("cpi_blended_rounded")))


def mart_installs_reinstalls(daily: DataFrame, weekly: DataFrame, monthly: DataFrame) -> DataFrame:
    return _over_grains(daily, weekly, monthly, _installs_reinstalls)


def mart_click_through_rate(daily: DataFrame, weekly: DataFrame, monthly: DataFrame) -> DataFrame:
    return _over_grains(daily, weekly, monthly, _click_through_rate)


def mart_cost_per_install(daily: DataFrame, weekly: DataFrame, monthly: DataFrame) -> DataFrame:
    return _over_grains(daily, weekly, monthly, _cost_per_install)


MARTS: dict[str, Callable[[DataFrame, DataFrame, DataFrame], DataFrame]] = {
    "mart_installs_reinstalls": mart_installs_reinstalls,
    "mart_click_through_rate": mart_click_through_rate,
    "mart_cost_per_install": mart_cost_per_install,
}


def present_order() -> list[Column]:
    """Grain, newest period first, partner, platform."""
    return [F.col("grain"), F.col("period").desc(), F.col("partner"), F.col("platform")]


def present(mart: DataFrame) -> DataFrame:
    return mart.orderBy(*present_order())


def grain_filter(grain: str) -> Column:
    return F.col("grain") == grain
