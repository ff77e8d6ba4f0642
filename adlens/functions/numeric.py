"""Numeric expressions: safe division, rounding, exact cost accumulation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Costs below EXACT_BELOW are summed as decimals of twelve places, so their
# sums do not depend on partitioning or on the roll-up path; what a decimal of
# that scale can't hold (finer digits, larger values, non-finite ones) is
# summed as doubles beside it. Nothing is dropped, capped or refused, and the
# decimal sum would need 1e16 rows to overflow.
EXACT_DECIMAL = "decimal(38,12)"
EXACT_BELOW = 1e10


def cost_parts(c: Column) -> Column:
    """A double as (d, r): its decimal part and the remainder as a double."""
    c = c.cast("double")
    inside = F.abs(c) < F.lit(EXACT_BELOW)
    d = F.when(inside, c.cast(EXACT_DECIMAL)).when(c.isNotNull(), F.lit(0).cast(EXACT_DECIMAL))
    return F.struct(d.alias("d"), F.when(inside, c - d.cast("double")).otherwise(c).alias("r"))


def sum_parts(parts: Column) -> Column:
    """Aggregate: (d, r) of the sum of (d, r) values."""
    return F.struct(F.sum(parts["d"]).alias("d"), F.sum(parts["r"]).alias("r"))


def joined(parts: Column) -> Column:
    """(d, r) as one double."""
    return parts["d"].cast("double") + parts["r"]


def exact_sum(c: Column | str) -> Column:
    """Aggregate: sum of doubles, exact as far as decimals reach (above)."""
    return joined(sum_parts(cost_parts(F.col(c) if isinstance(c, str) else c)))


def safe_divide(a: Column, b: Column) -> Column:
    """Null when the divisor is zero or null (never raises)."""
    return F.try_divide(a, b)


def round_half_up(x: Column, places: int) -> Column:
    """ROUND with ties away from zero, on the shortest decimal form."""
    return F.round(x, places)
