"""Date and timestamp expressions.

Every date is derived from a zone-less timestamp (``timestamp_ntz``), so the
results do not depend on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Raw layout: 2026-02-12T14:30:00Z (no fraction, two-digit fields, literal Z).
_RAW_TS_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$"


def timestamp_shape_ok(ts: Column) -> Column:
    return ts.rlike(_RAW_TS_SHAPE)


def _parse_ntz(ts: Column) -> Column:
    """Null unless ``ts`` is a real instant in the raw layout."""
    part = lambda start, n: F.substring(ts, start, n).cast("int")
    made = F.try_make_timestamp_ntz(part(1, 4), part(6, 2), part(9, 2),
                                    part(12, 2), part(15, 2), part(18, 2))
    # make_timestamp turns second 60 into the next minute; the layout does not.
    return F.when(timestamp_shape_ok(ts) & (part(18, 2) <= 59), made)


def parse_event_timestamp(ts: Column, strict: bool = True) -> Column:
    """Parse ``yyyy-MM-dd'T'HH:mm:ss'Z'`` into ``timestamp_ntz``.

    ``strict`` raises on a non-null string that does not parse (the source
    model fails the whole load); otherwise the value becomes null so the
    caller can route the row to quarantine. Both modes accept exactly the
    same strings, whatever the ANSI setting.
    """
    parsed = _parse_ntz(ts)
    if not strict:
        return parsed
    return F.when(ts.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit("Invalid event timestamp: "), ts))
                  ).otherwise(parsed)


def sunday_week_of_year(d: Column) -> Column:
    """Week number counted from the first Sunday (days before it are week 0)."""
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("long")


def day_of_week(d: Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(d).cast("long")


def period_start(d: Column, grain: str) -> Column:
    """Bucket a date: the day itself, its Monday, or the first of its month."""
    if grain == "daily":
        return d
    if grain == "weekly":
        return F.trunc(d, "week")
    if grain == "monthly":
        return F.trunc(d, "month")
    raise ValueError(f"unknown grain {grain!r}")


def timestamp_text(ts_ntz: Column) -> Column:
    """Format a zone-less timestamp as ``YYYY-MM-DDTHH:MM:SSZ``.

    Built from the string cast, which for ``timestamp_ntz`` never consults
    the session zone (``date_format`` would).
    """
    return F.concat(F.regexp_replace(F.substring(ts_ntz.cast("string"), 1, 19), " ", "T"),
                    F.lit("Z"))
