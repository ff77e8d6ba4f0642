"""Validation and report queries over the staged table and the marts.

Design rules for scale and repeatability:

* Every query is an aggregate whose shuffle input is already combined on the
  map side; a share of the grand total uses a scalar subquery over the
  grouped result (one row), not ``OVER ()`` with all groups in one task.
* Sums and averages of doubles are exact as far as decimals reach and lose
  no value beyond (``functions.numeric``).
* Top-k reports use ``orderBy().limit()`` (TakeOrderedAndProject: each task
  keeps k rows) with a total order; the limit is the feature there.
* Reports keep the source queries' ORDER BY (with a tie-break for a total
  order); they sort small aggregated results only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions.numeric import exact_sum, round_half_up, safe_divide

def exact_avg(c: Column | str) -> Column:
    """Mean of non-null values, summed exactly; null for no values."""
    c = F.col(c) if isinstance(c, str) else c
    return safe_divide(exact_sum(c), F.count(c))


def _share(grouped: DataFrame, col: str, places: int) -> Column:
    # The subquery aggregates every measure of ``grouped`` (not just ``col``)
    # so that its plan equals the main query's and the shuffle is reused.
    numeric = ("bigint", "int", "double", "decimal")
    measures = [c for c, t in grouped.dtypes if c != col and t.startswith(numeric)]
    of = exact_sum if dict(grouped.dtypes)[col] == "double" else F.sum
    total = grouped.select(F.struct(of(col).alias("t"),
                                    *[F.sum(c).alias(c) for c in measures])).scalar()["t"]
    return round_half_up(safe_divide(F.col(col).cast("double") * F.lit(100.0),
                                     total.cast("double")), places)


def record_count(stg: DataFrame) -> DataFrame:
    return stg.agg(F.count(F.lit(1)).alias("total_events"))


def event_distribution(stg: DataFrame) -> DataFrame:
    g = stg.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"),
                                      exact_sum("cost_usd").alias("_cost"))
    return (g.select("event_type", "event_count",
                     _share(g, "event_count", 1).alias("percentage"),
                     round_half_up(F.col("_cost"), 2).alias("total_cost"))
             .orderBy(F.col("event_count").desc(), "event_type"))


def partner_distribution(stg: DataFrame) -> DataFrame:
    g = stg.groupBy("partner").agg(F.count(F.lit(1)).alias("event_count"))
    return (g.select("partner", "event_count", _share(g, "event_count", 1).alias("percentage"))
             .orderBy(F.col("event_count").desc(), "partner"))


def daily_summary(daily: DataFrame, top: int = 20) -> DataFrame:
    ctr = safe_divide(F.col("clicks"), F.col("impressions")) * 100
    return (daily.select("event_date", "partner", "platform", "installs", "clicks",
                         "impressions", round_half_up(ctr, 2).alias("ctr_pct"),
                         round_half_up(F.col("total_cost"), 2).alias("total_cost"))
                 .orderBy(F.col("event_date").desc(), "partner", "platform")
                 .limit(top))


def _ratio_stats(mart: DataFrame, keys: list[str], col: str, prefix: str) -> DataFrame:
    return mart.groupBy(*keys).agg(
        round_half_up(exact_avg(col), 2).alias(f"avg_{prefix}"),
        round_half_up(F.min(col), 2).alias(f"min_{prefix}"),
        round_half_up(F.max(col), 2).alias(f"max_{prefix}"),
        F.count(F.lit(1)).alias("record_count"))


def ctr_order() -> list[Column]:
    """Grain, best rate first, partner."""
    return [F.col("grain"), F.col("avg_ctr_pct").desc(), F.col("partner")]


def ctr_stats(ctr_mart: DataFrame) -> DataFrame:
    return (_ratio_stats(ctr_mart, ["grain", "partner"], "ctr_percentage", "ctr_pct")
            .orderBy(*ctr_order()))


def cpi_order() -> list[Column]:
    """Grain, least cost first, platform."""
    return [F.col("grain"), F.col("avg_cpi"), F.col("platform")]


def cpi_stats(cpi_mart: DataFrame) -> DataFrame:
    return (_ratio_stats(cpi_mart, ["grain", "platform"], "cpi_direct_rounded", "cpi")
            .orderBy(*cpi_order()))


def grain_coverage(ir: DataFrame, ctr: DataFrame, cpi: DataFrame) -> DataFrame:
    out = None
    for name, mart in (("installs_reinstalls", ir), ("click_through_rate", ctr),
                       ("cost_per_install", cpi)):
        part = (mart.groupBy("grain").agg(F.count(F.lit(1)).alias("record_count"))
                    .select(F.lit(name).alias("mart_name"), "grain", "record_count"))
        out = part if out is None else out.unionByName(part)
    return out.orderBy("mart_name", "grain")


def install_volume(ir: DataFrame) -> DataFrame:
    return (ir.filter(F.col("grain") == "monthly").groupBy("partner", "platform")
              .agg(F.sum("installs").alias("total_installs"),
                   F.sum("reinstalls").alias("total_reinstalls"),
                   round_half_up(exact_sum("total_install_cost"), 2).alias("total_cost"))
              .orderBy(F.col("total_installs").desc(), "partner", "platform"))


def cost_efficiency(cpi: DataFrame) -> DataFrame:
    return (cpi.filter(F.col("grain") == "daily").groupBy("partner")
               .agg(round_half_up(exact_avg("cpi_direct_rounded"), 2).alias("avg_cpi"),
                    F.sum("installs").alias("total_installs"),
                    round_half_up(exact_sum("install_cost"), 2).alias("total_spend"))
               .orderBy("avg_cpi", "partner"))


def daily_trend(daily: DataFrame, top: int = 30) -> DataFrame:
    """Installs, clicks and impressions per day, newest ``top`` days.

    Read from the daily metrics, which carry all three counts.
    """
    return (daily.groupBy(F.col("event_date").cast("string").alias("period"))
                 .agg(F.sum("installs").alias("total_installs"),
                      F.sum("clicks").alias("total_clicks"),
                      F.sum("impressions").alias("total_impressions"))
                 .orderBy(F.col("period").desc())
                 .limit(top))


def null_audit(stg: DataFrame) -> DataFrame:
    return stg.agg(F.count_if(F.col("event_id").isNull()).alias("null_event_id"),
                   F.count_if(F.col("event_timestamp").isNull()).alias("null_timestamp"),
                   F.count_if(F.col("event_type").isNull()).alias("null_event_type"),
                   F.count_if(F.col("partner").isNull()).alias("null_partner"),
                   F.count_if(F.col("cost_usd").isNull()).alias("null_cost"),
                   F.count(F.lit(1)).alias("total_records"))


def cost_share(stg: DataFrame) -> DataFrame:
    g = stg.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"),
                                      exact_sum("cost_usd").alias("_cost"),
                                      F.count("cost_usd").alias("_n"))
    return (g.select("event_type", "event_count",
                     round_half_up(F.col("_cost"), 2).alias("total_cost"),
                     round_half_up(safe_divide(F.col("_cost"), F.col("_n")), 4)
                     .alias("avg_cost_per_event"),
                     _share(g, "_cost", 1).alias("cost_percentage"))
             .orderBy(F.col("total_cost").desc(), "event_type"))


# Dashboard measures and views documented for the BI layer.
def avg_ctr(ctr: DataFrame) -> DataFrame:
    return ctr.groupBy("grain", "partner", "platform").agg(
        exact_avg("ctr_percentage").alias("avg_ctr"))


def daily_installs_by_partner(ir: DataFrame) -> DataFrame:
    return (ir.filter(F.col("grain") == "daily").groupBy("period", "partner")
              .agg(F.sum("installs").alias("installs"),
                   F.sum("reinstalls").alias("reinstalls")))


def ctr_by_platform(ctr: DataFrame) -> DataFrame:
    """CTR across platforms from re-summed clicks and impressions."""
    return (ctr.groupBy("grain", "period", "platform")
               .agg(F.sum("clicks").alias("clicks"), F.sum("impressions").alias("impressions"))
               .withColumn("ctr", safe_divide(F.col("clicks"), F.col("impressions")))
               .withColumn("ctr_percentage", round_half_up(F.col("ctr") * 100, 2)))


def cpi_by_partner(cpi: DataFrame) -> DataFrame:
    """CPI per grain, period and partner from re-summed installs and costs."""
    g = cpi.groupBy("grain", "period", "partner").agg(
        F.sum("installs").alias("installs"),
        exact_sum("install_cost").alias("_ic"), exact_sum("total_cost").alias("_tc"))
    return g.select("grain", "period", "partner", "installs",
                    F.col("_ic").alias("install_cost"),
                    F.col("_tc").alias("total_cost"),
                    round_half_up(safe_divide(F.col("_ic"), F.col("installs")), 2)
                    .alias("cpi_direct"),
                    round_half_up(safe_divide(F.col("_tc"), F.col("installs")), 2)
                    .alias("cpi_blended"))
