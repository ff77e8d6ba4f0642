"""Adapter from the driver's generic ``events`` table to raw attribution events.

The driver table is ``event_id bigint, ts timestamp_ntz, user_id bigint,
event_type string, value double, props string``. It is mapped in one
projection (no shuffle, no filter: every input row becomes one raw event) and
seeded with the defects the staging filters exist for: null timestamps,
unknown event types, negative costs and lower-case country codes. The Spark
form and the DuckDB form are kept side by side so that they cannot drift.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.constants import COUNTRY_CODES, PARTNERS, SAMPLE_APPS, SAMPLE_CAMPAIGNS
from adlens.functions.dates import timestamp_text

# Mapping of the driver's event types onto attribution types; others are kept
# as they are ("click" stays valid, "error" is rejected by staging).
TYPE_MAP = {"view": "impression", "signup": "install", "purchase": "reinstall"}

# Defect seeding by key residue (all rows are kept; these only shape values).
NULL_TS_MOD = 101
NEGATIVE_COST_MOD = 97
LOWER_COUNTRY_MOD = 2
SHIFT_USER_DIV = 25
SHIFT_DAYS = 31


def _pick(values: list[str], idx) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def raw_from_events(events: DataFrame) -> DataFrame:
    """Project the driver ``events`` frame onto the raw event schema."""
    eid, uid = F.col("event_id"), F.col("user_id")
    shift = ((F.floor(uid / SHIFT_USER_DIV) % 3) * SHIFT_DAYS).cast("int")
    shifted = F.col("ts") + F.make_dt_interval(days=shift)
    etype = F.col("event_type")
    for src, dst in TYPE_MAP.items():
        etype = F.when(F.col("event_type") == src, F.lit(dst)).otherwise(etype)
    country = _pick(COUNTRY_CODES, uid % 10)
    return events.select(
        eid.cast("string").alias("event_id"),
        F.when(eid % NULL_TS_MOD == 0, F.lit(None).cast("string"))
         .otherwise(timestamp_text(shifted)).alias("timestamp"),
        etype.alias("event_type"),
        _pick(PARTNERS, uid % 5).alias("partner"),
        F.when(eid % NEGATIVE_COST_MOD == 0, -F.col("value"))
         .otherwise(F.col("value")).alias("cost_usd"),
        _pick(SAMPLE_APPS, uid % 5).alias("app_id"),
        _pick(SAMPLE_CAMPAIGNS, eid % 8).alias("campaign_id"),
        F.when(F.floor(uid / 5) % 5 < 2, F.lit("iOS")).otherwise(F.lit("Android")).alias("platform"),
        F.when(eid % LOWER_COUNTRY_MOD == 0, F.lower(country)).otherwise(country).alias("country_code"),
    )


def read_driver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw attribution events derived from ``<sf_dir>/events.parquet``."""
    return raw_from_events(read_driver_events(spark, sf_dir))


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


# DuckDB form of ``raw_from_events`` over the pre-registered ``events`` view.
RAW_SQL = f"""
SELECT
  CAST(event_id AS VARCHAR) AS event_id,
  CASE WHEN event_id % {NULL_TS_MOD} = 0 THEN NULL
       ELSE strftime(ts + to_days(CAST(((user_id // {SHIFT_USER_DIV}) % 3) * {SHIFT_DAYS} AS INTEGER)),
                     '%Y-%m-%dT%H:%M:%SZ') END AS "timestamp",
  CASE event_type {' '.join(f"WHEN '{s}' THEN '{d}'" for s, d in TYPE_MAP.items())}
       ELSE event_type END AS event_type,
  list_extract({_sql_list(PARTNERS)}, CAST(user_id % 5 + 1 AS INTEGER)) AS partner,
  CASE WHEN event_id % {NEGATIVE_COST_MOD} = 0 THEN -value ELSE value END AS cost_usd,
  list_extract({_sql_list(SAMPLE_APPS)}, CAST(user_id % 5 + 1 AS INTEGER)) AS app_id,
  list_extract({_sql_list(SAMPLE_CAMPAIGNS)}, CAST(event_id % 8 + 1 AS INTEGER)) AS campaign_id,
  CASE WHEN (user_id // 5) % 5 < 2 THEN 'iOS' ELSE 'Android' END AS platform,
  CASE WHEN event_id % {LOWER_COUNTRY_MOD} = 0
       THEN lower(list_extract({_sql_list(COUNTRY_CODES)}, CAST(user_id % 10 + 1 AS INTEGER)))
       ELSE list_extract({_sql_list(COUNTRY_CODES)}, CAST(user_id % 10 + 1 AS INTEGER)) END AS country_code
FROM events
"""


# Further defects, for the data tests: what a source without this library's
# staging rules could deliver (again by key residue, every row kept).
DUPLICATE_ID_MOD, NULL_ID_MOD, NULL_PARTNER_MOD, NULL_PLATFORM_MOD, OTHER_PLATFORM_MOD = 103, 107, 109, 113, 127
NULL_COUNTRY_MOD, NULL_APP_MOD, BAD_TIMESTAMP_MOD, NULL_COST_MOD = 131, 137, 139, 151
# Costs far outside the usual range.
TINY_COST_MOD, LARGE_COST_MOD, HUGE_COST_MOD = 7, 997, 2003
TINY_COST, LARGE_COST, HUGE_COST = 4e-7, 1e12, 1e25


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events with repeated and null ids, nulls, an unknown platform and unparsable timestamps."""
    raw = raw_events(spark, sf_dir).withColumn("_e", F.col("event_id").cast("bigint"))
    e = F.col("_e")

    def null_at(column: str, mod: int) -> F.Column:
        return F.when(e % mod != 0, F.col(column))
    return raw.withColumns({
        "event_id": F.when(e % DUPLICATE_ID_MOD == 0, (e + 1).cast("string")).otherwise(null_at("event_id", NULL_ID_MOD)),
        "timestamp": F.when(e % BAD_TIMESTAMP_MOD == 0, F.lit("2026-13-01T00:00:00Z")).otherwise(F.col("timestamp")),
        "partner": null_at("partner", NULL_PARTNER_MOD),
        "platform": F.when(e % OTHER_PLATFORM_MOD == 0, F.lit("Web")).otherwise(null_at("platform", NULL_PLATFORM_MOD)),
        "country_code": null_at("country_code", NULL_COUNTRY_MOD),
        "app_id": null_at("app_id", NULL_APP_MOD),
        "cost_usd": null_at("cost_usd", NULL_COST_MOD),
    }).drop("_e")


DIRTY_SQL = f"""
SELECT CASE WHEN e % {DUPLICATE_ID_MOD} = 0 THEN CAST(e + 1 AS VARCHAR) WHEN e % {NULL_ID_MOD} <> 0 THEN event_id END AS event_id,
  CASE WHEN e % {BAD_TIMESTAMP_MOD} = 0 THEN '2026-13-01T00:00:00Z' ELSE "timestamp" END AS "timestamp", event_type,
  CASE WHEN e % {NULL_PARTNER_MOD} <> 0 THEN partner END AS partner,
  CASE WHEN e % {NULL_COST_MOD} <> 0 THEN cost_usd END AS cost_usd,
  CASE WHEN e % {NULL_APP_MOD} <> 0 THEN app_id END AS app_id, campaign_id,
  CASE WHEN e % {OTHER_PLATFORM_MOD} = 0 THEN 'Web' WHEN e % {NULL_PLATFORM_MOD} <> 0 THEN platform END AS platform,
  CASE WHEN e % {NULL_COUNTRY_MOD} <> 0 THEN country_code END AS country_code
FROM (SELECT *, CAST(event_id AS BIGINT) AS e FROM ({RAW_SQL}) r) d
"""


def extreme_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events some of which cost 4e-7, 1e12 or 1e25."""
    e = F.col("event_id").cast("bigint")
    cost = (F.when(e % HUGE_COST_MOD == 0, F.lit(HUGE_COST)).when(e % LARGE_COST_MOD == 0, F.lit(LARGE_COST))
            .when(e % TINY_COST_MOD == 0, F.lit(TINY_COST)).otherwise(F.col("cost_usd")))
    return raw_events(spark, sf_dir).withColumn("cost_usd", cost)


EXTREME_SQL = f"""
SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % {HUGE_COST_MOD} = 0 THEN CAST('1e25' AS DOUBLE)
                       WHEN CAST(event_id AS BIGINT) % {LARGE_COST_MOD} = 0 THEN CAST('1e12' AS DOUBLE)
                       WHEN CAST(event_id AS BIGINT) % {TINY_COST_MOD} = 0 THEN CAST('4e-7' AS DOUBLE)
                       ELSE cost_usd END AS cost_usd)
FROM ({RAW_SQL}) r
"""


# ---------------------------------------------------------------------------
# JSON text lines for the validator: adapter rows written as JSON objects,
# with defects by key residue (again: every row becomes exactly one line).
# ---------------------------------------------------------------------------
NULL_ID_AND_TYPE_MOD = 89      # "event_id": null and "event_type": null
NUMERIC_ID_MOD = 59            # "event_id": 123 (a number)
DROP_PARTNER_PLATFORM_MOD = 53  # two keys absent at once
LOWER_PLATFORM_MOD = 61        # "ios" / "android"
BAD_MONTH_MOD = 71             # month 13 in the timestamp
SPACE_SEPARATOR_MOD = 67       # "2024-01-05 10:00:00Z" (valid ISO, not staging's form)
STRING_COST_MOD = 73           # "cost_usd": "12.31"
TEXT_COST_MOD = 79             # "cost_usd": "n/a"
TRUNCATED_MOD = 83             # line cut after 20 characters
TWO_OBJECTS_MOD = 157          # in landed lines only: two objects on one line


def _json_scalar(c: F.Column) -> F.Column:
    """JSON text of one value (escaped by the JSON writer, brackets cut)."""
    t = F.to_json(F.array(c))
    return t.substr(F.lit(2), F.length(t) - 2)


def _pair(key: str, value_json: F.Column) -> F.Column:
    return F.concat(F.lit(f'"{key}":'), value_json)


def lines_from_raw(raw: DataFrame) -> DataFrame:
    """``line_id`` (the driver key) and ``line`` (JSON text) per raw event."""
    e = F.col("event_id").cast("bigint")
    ts0 = F.col("timestamp")
    ts = (F.when(e % BAD_MONTH_MOD == 0,
                 F.concat(F.substring(ts0, 1, 5), F.lit("13"), F.substring(ts0, 8, 100)))
           .when(e % SPACE_SEPARATOR_MOD == 0, F.regexp_replace(ts0, "T", " "))
           .otherwise(ts0))
    platform = F.when(e % LOWER_PLATFORM_MOD == 0, F.lower("platform")).otherwise(F.col("platform"))
    fields = [
        _pair("event_id", F.when(e % NULL_ID_AND_TYPE_MOD == 0, F.lit("null"))
                           .when(e % NUMERIC_ID_MOD == 0, e.cast("string"))
                           .otherwise(_json_scalar(F.col("event_id")))),
        F.when(ts.isNotNull(), _pair("timestamp", _json_scalar(ts))),
        _pair("event_type", F.when(e % NULL_ID_AND_TYPE_MOD == 0, F.lit("null"))
                             .otherwise(_json_scalar(F.col("event_type")))),
        F.when(e % DROP_PARTNER_PLATFORM_MOD != 0, _pair("partner", _json_scalar(F.col("partner")))),
        _pair("cost_usd", F.when(e % TEXT_COST_MOD == 0, F.lit('"n/a"'))
                           .when(e % STRING_COST_MOD == 0,
                                 _json_scalar(F.col("cost_usd").cast("string")))
                           .otherwise(_json_scalar(F.col("cost_usd")))),
        _pair("app_id", _json_scalar(F.col("app_id"))),
        _pair("campaign_id", _json_scalar(F.col("campaign_id"))),
        F.when(e % DROP_PARTNER_PLATFORM_MOD != 0, _pair("platform", _json_scalar(platform))),
        _pair("country_code", _json_scalar(F.col("country_code"))),
    ]
    line = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
    line = F.when(e % TRUNCATED_MOD == 0, F.substring(line, 1, 20)).otherwise(line)
    return raw.select(e.alias("line_id"), line.alias("line"))


def validation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_from_raw(raw_events(spark, sf_dir))


def _sql_pair(key: str, value_sql: str) -> str:
    return f"""'"{key}":' || ({value_sql})"""


# DuckDB form of ``lines_from_raw`` over the ``raw`` CTE.
LINES_SQL = f"""
SELECT line_id, CASE WHEN line_id % {TRUNCATED_MOD} = 0 THEN substr(l, 1, 20) ELSE l END AS line
FROM (
  SELECT line_id, '{{' || concat_ws(',',
    {_sql_pair('event_id', f"CASE WHEN line_id % {NULL_ID_AND_TYPE_MOD} = 0 THEN 'null' "
                           f"WHEN line_id % {NUMERIC_ID_MOD} = 0 THEN CAST(line_id AS VARCHAR) "
                           f"ELSE to_json(event_id) END")},
    CASE WHEN ts IS NOT NULL THEN {_sql_pair('timestamp', 'to_json(ts)')} END,
    {_sql_pair('event_type', f"CASE WHEN line_id % {NULL_ID_AND_TYPE_MOD} = 0 THEN 'null' "
                             f"ELSE to_json(event_type) END")},
    CASE WHEN line_id % {DROP_PARTNER_PLATFORM_MOD} <> 0 THEN {_sql_pair('partner', 'to_json(partner)')} END,
    {_sql_pair('cost_usd', f"""CASE WHEN line_id % {TEXT_COST_MOD} = 0 THEN '"n/a"' """
                           f"WHEN line_id % {STRING_COST_MOD} = 0 THEN to_json(CAST(cost_usd AS VARCHAR)) "
                           f"ELSE to_json(cost_usd) END")},
    {_sql_pair('app_id', 'to_json(app_id)')},
    {_sql_pair('campaign_id', 'to_json(campaign_id)')},
    CASE WHEN line_id % {DROP_PARTNER_PLATFORM_MOD} <> 0 THEN {_sql_pair('platform', 'to_json(pf)')} END,
    {_sql_pair('country_code', 'to_json(country_code)')}
  ) || '}}' AS l
  FROM (
    SELECT *, CAST(event_id AS BIGINT) AS line_id,
      CASE WHEN CAST(event_id AS BIGINT) % {BAD_MONTH_MOD} = 0
             THEN substr("timestamp", 1, 5) || '13' || substr("timestamp", 8)
           WHEN CAST(event_id AS BIGINT) % {SPACE_SEPARATOR_MOD} = 0 THEN replace("timestamp", 'T', ' ')
           ELSE "timestamp" END AS ts,
      CASE WHEN CAST(event_id AS BIGINT) % {LOWER_PLATFORM_MOD} = 0 THEN lower(platform)
           ELSE platform END AS pf
    FROM raw) r
) x
"""


def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``validation_lines`` some of which hold their object twice."""
    lines = validation_lines(spark, sf_dir)
    # a generator: the parser's several uses of a line then don't write it out again each time
    lines = lines.select("line_id", F.explode(F.array("line")).alias("line"))
    return lines.withColumn("line", F.when(
        F.col("line_id") % TWO_OBJECTS_MOD == 0, F.concat("line", F.lit(" "), "line")).otherwise(F.col("line")))


LANDED_SQL = f"""
SELECT line_id, CASE WHEN line_id % {TWO_OBJECTS_MOD} = 0 THEN line || ' ' || line ELSE line END AS line FROM ({LINES_SQL}) l
"""
