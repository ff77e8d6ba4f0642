"""Repeatable synthetic attribution events, generated as a Spark job.

Each row's fields are drawn from a hash of (seed, field, key), not from
``rand()``: the table is identical whatever the partitioning, and a retried
task regenerates exactly the rows it lost. Generation is a single narrow
projection over the key range, so it scales with the number of tasks.

Distributions follow the fixed configuration: weighted choice for event
type, partner, platform and country; uniform choice of app and campaign;
cost uniform in the type's range, rounded to cents; a timestamp uniform in
the ``days`` before ``as_of``.
"""

from __future__ import annotations

import datetime as _dt
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.constants import (
    COST_RANGES, COUNTRY_WEIGHTS, EVENT_TYPE_WEIGHTS, PARTNER_WEIGHTS, PLATFORM_WEIGHTS,
    SAMPLE_APPS, SAMPLE_CAMPAIGNS,
)
from adlens.functions.dates import timestamp_text
from adlens.functions.hashing import uniform_draw, uuid_from_hash
from adlens.functions.numeric import round_half_up

WEIGHTED_FIELDS = {
    "event_type": EVENT_TYPE_WEIGHTS,
    "partner": PARTNER_WEIGHTS,
    "platform": PLATFORM_WEIGHTS,
    "country_code": COUNTRY_WEIGHTS,
}


def cumulative(weights: list[tuple[str, float]]) -> list[tuple[str, float]]:
    """(value, upper bound) pairs; the last bound is open."""
    bounds = list(accumulate(w for _, w in weights))
    return [(v, b) for (v, _), b in zip(weights, bounds)]


def weighted_choice(u: Column, weights: list[tuple[str, float]]) -> Column:
    cum = cumulative(weights)
    out = F.lit(cum[-1][0])
    for value, bound in reversed(cum[:-1]):
        out = F.when(u < F.lit(bound), F.lit(value)).otherwise(out)
    return out


def uniform_choice(u: Column, values: list[str]) -> Column:
    idx = (F.floor(u * len(values)) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx)


def cost_in_range(u: Column, event_type: Column) -> Column:
    out = None
    for t, (lo, hi) in COST_RANGES.items():
        val = round_half_up(F.lit(lo) + F.lit(hi - lo) * u, 2)
        out = F.when(event_type == t, val) if out is None else out.when(event_type == t, val)
    return out


def synth_from_keys(keys: DataFrame, key_col: str, days: int = 30,
                    as_of: _dt.datetime = _dt.datetime(2026, 2, 12),
                    seed: int = 42) -> DataFrame:
    """One synthetic raw event per row of ``keys`` (its ``key_col`` is the
    draw key; the generated rows keep it as ``synth_key``)."""
    df = keys.select(F.col(key_col).cast("long").alias("synth_key"))
    k = F.col("synth_key")

    def draw(field: str) -> Column:
        return uniform_draw(seed, field, k)
    span = days * 24 * 60 * 60 + 1  # seconds in [0, span)
    secs = F.floor(draw("timestamp") * span).cast("long")
    start = F.to_timestamp_ntz(F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")))
    at = start - F.make_dt_interval(secs=secs)
    df = df.withColumn("event_type", weighted_choice(draw("event_type"), EVENT_TYPE_WEIGHTS))
    return df.select(
        "synth_key",
        uuid_from_hash(seed, k).alias("event_id"),
        timestamp_text(at).alias("timestamp"),
        "event_type",
        weighted_choice(draw("partner"), PARTNER_WEIGHTS).alias("partner"),
        cost_in_range(draw("cost_usd"), F.col("event_type")).alias("cost_usd"),
        uniform_choice(draw("app_id"), SAMPLE_APPS).alias("app_id"),
        uniform_choice(draw("campaign_id"), SAMPLE_CAMPAIGNS).alias("campaign_id"),
        weighted_choice(draw("platform"), PLATFORM_WEIGHTS).alias("platform"),
        weighted_choice(draw("country_code"), COUNTRY_WEIGHTS).alias("country_code"),
    )


def synth_events(spark: SparkSession, n: int, days: int = 30,
                 as_of: _dt.datetime = _dt.datetime(2026, 2, 12), seed: int = 42,
                 num_partitions: int | None = None) -> DataFrame:
    """``n`` synthetic raw events over ``spark.range(n)`` (raw schema)."""
    keys = spark.range(0, n, 1, num_partitions) if num_partitions else spark.range(n)
    return synth_from_keys(keys, "id", days, as_of, seed).drop("synth_key")


def value_counts(events: DataFrame) -> DataFrame:
    """(field, value, events) for every weighted field, in one aggregate."""
    fields = list(WEIGHTED_FIELDS)
    g = (events.groupingSets([[f] for f in fields], *fields)
               .agg(F.count(F.lit(1)).alias("events"), F.grouping_id().alias("_gid")))
    n = len(fields)
    field = None
    for i, f in enumerate(fields):
        gid = (1 << n) - 1 - (1 << (n - 1 - i))
        field = (F.when(F.col("_gid") == gid, F.lit(f)) if field is None
                 else field.when(F.col("_gid") == gid, F.lit(f)))
    return g.select(field.alias("field"), F.coalesce(*fields).alias("value"), "events")


def distribution_check(events: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Observed share of each value against its configured weight."""
    counts = value_counts(events)
    # any one field's counts add up to the number of events; the subquery
    # aggregates every column, so its plan equals the main query's
    total = counts.select(F.struct(F.sum(F.when(F.col("field") == "platform", F.col("events"))).alias("n"),
                                   F.count("value").alias("k"))).scalar()["n"]
    weight = F.lit(None).cast("double")
    for f, ws in WEIGHTED_FIELDS.items():
        for v, w in ws:
            weight = F.when((F.col("field") == f) & (F.col("value") == v), F.lit(w)).otherwise(weight)
    share = F.col("events") / total.cast("double")
    return counts.select("field", "value", "events", share.alias("share"), weight.alias("weight"),
                         (F.abs(share - weight) <= F.lit(tolerance)).alias("within_tolerance"))
