"""Staging: raw events -> typed, normalized events (plus their rejects).

The filters read the *raw* columns, before any normalization: ``event_type``
membership is case-sensitive (``'Install'`` is dropped, not lower-cased), a
null type or cost drops the row (SQL three-valued logic), while a null
partner or platform survives and forms its own group. Everything is one
narrow projection over the scan, so Catalyst pushes the null/range filters
into the file reader and prunes unused columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.constants import EVENT_TYPES
from adlens.functions.dates import day_of_week, parse_event_timestamp, sunday_week_of_year

STAGED_COLUMNS = [
    "event_id", "event_timestamp", "event_date", "event_type", "partner", "cost_usd",
    "app_id", "campaign_id", "platform", "country_code", "year", "month", "week",
    "day_of_week",
]

# Reject reasons in the order the rules are checked.
REASON_MALFORMED = "malformed_record"
REASON_NULL_TIMESTAMP = "null_timestamp"
REASON_EVENT_TYPE = "invalid_event_type"
REASON_COST = "invalid_cost"
REASON_TIMESTAMP_FORMAT = "invalid_timestamp_format"
REASON_NO_ID = "null_event_id"  # only where rows are merged by their id


def _cost_ok(c: Column) -> Column:
    # NaN >= 0 is true in Spark but false in SQL engines; infinity is not a cost.
    return (c >= 0) & ~F.isnan(c) & (c < F.lit(float("inf")))


def staging_predicate(check_cost: bool = True) -> Column:
    """The source model's WHERE clause, on raw columns (null -> not kept).

    ``check_cost=False`` leaves out the cost rule (any finite cost stays), for
    data tests of what that rule keeps away.
    """
    cost = F.col("cost_usd")
    return (F.col("timestamp").isNotNull()
            & F.col("event_type").isin(*EVENT_TYPES)
            & (_cost_ok(cost) if check_cost else F.abs(cost) < F.lit(float("inf"))))


def _normalize(df: DataFrame, ts: Column, *keep: str) -> DataFrame:
    """Project raw rows to the 14 staged columns and those to ``keep``."""
    d = F.col("event_timestamp").cast("date")
    return (df.select(
                "event_id", ts.alias("event_timestamp"), "event_type", "partner",
                "cost_usd", "app_id", "campaign_id", "platform", "country_code", *keep)
            .select(
                "event_id",
                "event_timestamp",
                d.alias("event_date"),
                F.lower("event_type").alias("event_type"),
                F.lower("partner").alias("partner"),
                F.col("cost_usd").cast("double").alias("cost_usd"),
                "app_id",
                "campaign_id",
                F.upper("platform").alias("platform"),
                F.upper("country_code").alias("country_code"),
                F.year(d).cast("long").alias("year"),
                F.month(d).cast("long").alias("month"),
                sunday_week_of_year(d).alias("week"),
                day_of_week(d).alias("day_of_week"),
                *keep,
            ))


def stage_events(raw: DataFrame, mode: str = "strict", check_cost: bool = True) -> DataFrame:
    """Typed and normalized events.

    ``mode="strict"`` fails the job on a timestamp that does not parse (as the
    source model does); ``mode="quarantine"`` drops such rows here and
    ``rejected_events`` reports them.
    """
    if mode not in ("strict", "quarantine"):
        raise ValueError("mode must be 'strict' or 'quarantine'")
    kept = raw.filter(staging_predicate(check_cost))
    if "_corrupt_record" in raw.columns:
        kept = kept.filter(F.col("_corrupt_record").isNull())
    # Parse once into a column; the strict check then only reads it. The filter
    # of quarantine reads it too, and would be rewritten into the parse (the
    # timestamp's own expression once per digit group) but for the generator.
    parsed = parse_event_timestamp(F.col("timestamp"), strict=False)
    kept = kept.select("*", (F.explode(F.array(parsed)) if mode == "quarantine" else parsed).alias("_parsed"))
    ts = F.col("_parsed")
    if mode == "strict":
        ts = F.when(F.col("_parsed").isNull(),
                    F.raise_error(F.concat(F.lit("Invalid event timestamp: "), F.col("timestamp")))
                    ).otherwise(F.col("_parsed"))
    staged = _normalize(kept, ts)
    if mode == "quarantine":
        staged = staged.filter(F.col("event_timestamp").isNotNull())
    return staged


def reject_reason(mode: str = "strict", corrupt_col: str | None = None) -> Column:
    """First failing rule for a raw row, null when the row is staged.

    With ``corrupt_col`` (the JSON reader's corrupt-record column in
    PERMISSIVE mode) a line that did not parse is reported as malformed.
    """
    rules = [(F.col("timestamp").isNull(), REASON_NULL_TIMESTAMP),
             (~F.coalesce(F.col("event_type").isin(*EVENT_TYPES), F.lit(False)), REASON_EVENT_TYPE),
             (~F.coalesce(_cost_ok(F.col("cost_usd")), F.lit(False)), REASON_COST)]
    if corrupt_col:
        rules.insert(0, (F.col(corrupt_col).isNotNull(), REASON_MALFORMED))
    if mode == "quarantine":
        parsed = parse_event_timestamp(F.col("timestamp"), strict=False)
        rules.append((parsed.isNull(), REASON_TIMESTAMP_FORMAT))
    reason = F.when(rules[0][0], F.lit(rules[0][1]))
    for cond, name in rules[1:]:
        reason = reason.when(cond, F.lit(name))
    return reason


def rejected_events(raw: DataFrame, mode: str = "quarantine") -> DataFrame:
    """Raw rows that staging does not keep, with a ``reject_reason``.

    The null-safe complement of the staging filter: ``accepted + rejected``
    always equals the raw row count.
    """
    corrupt = "_corrupt_record" if "_corrupt_record" in raw.columns else None
    return (raw.withColumn("reject_reason", reject_reason(mode, corrupt))
               .filter(F.col("reject_reason").isNotNull()))


def staged_and_rejected(raw: DataFrame, mode: str = "strict", require_id: bool = False,
                        keep: tuple[str, ...] = ()) -> DataFrame:
    """Every raw row once: the staged columns, ``reject_reason`` (null when
    staged), ``rejected`` (the raw columns of a rejected row) and the columns
    to ``keep``. Written once, it serves both outputs from one parse."""
    corrupt = "_corrupt_record" if "_corrupt_record" in raw.columns else None
    reason = reject_reason(mode, corrupt)
    if require_id:
        reason = F.coalesce(reason, F.when(F.col("event_id").isNull(), F.lit(REASON_NO_ID)))
    df = raw.withColumn("reject_reason", reason).withColumn(
        "_parsed", parse_event_timestamp(F.col("timestamp"), strict=False))
    df = df.withColumn("rejected", F.when(F.col("reject_reason").isNotNull(), F.struct(
        *[c for c in raw.columns if c not in keep])))
    ts = F.col("_parsed")
    if mode == "strict":
        ts = F.when(F.col("_parsed").isNull() & F.col("reject_reason").isNull(),
                    F.raise_error(F.concat(F.lit("Invalid event timestamp: "), F.col("timestamp")))).otherwise(ts)
    return _normalize(df, ts, "reject_reason", "rejected", *keep)


def rejects_by_reason(raw: DataFrame, mode: str = "quarantine") -> DataFrame:
    return (rejected_events(raw, mode).groupBy("reject_reason")
            .agg(F.count(F.lit(1)).alias("rejected_rows")))
