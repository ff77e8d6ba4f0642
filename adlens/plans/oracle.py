"""DuckDB oracle SQL for the registered queries.

Plain SQL over the driver's pre-registered views, following the same model
definitions. The declared data tests, the accepted lists, the validator's
text patterns and the generator's weights are the library's own (an error in
those passes both sides; unit tests state them again). Engine differences
are handled explicitly:

* ROUND: Spark rounds the shortest decimal form of a double, half away from
  zero; the oracle rounds ``CAST(CAST(x AS VARCHAR) AS DECIMAL)`` (``rnd``).
* Costs are summed in their written decimal form, huge ones as doubles.
* ``count_if``/``sum(bigint)`` are HUGEINT in DuckDB: cast to BIGINT.
* Day of week is 0-based in DuckDB: add 1.
"""

from __future__ import annotations

from adlens.constants import (
    EVENT_TYPES, METRIC_DOCS, REQUIRED_FIELDS, SAMPLE_APPS, SAMPLE_CAMPAIGNS, TABLE_DOCS, VALID_EVENT_TYPES, VALID_PLATFORMS,
)
from adlens.operators.checks import Check, DECLARED_CHECKS
from adlens.operators.synth import COST_RANGES, WEIGHTED_FIELDS, cumulative
from adlens.operators.validate import _ISO, _NUMERIC_STRING, _OFFSET, _TIME, _pylist
from adlens.sources.driver_events import DIRTY_SQL, EXTREME_SQL, LANDED_SQL, LINES_SQL, RAW_SQL


def rnd(x: str, places: int) -> str:
    """Rounded half away from zero on the written form; doubles from 1e15 on have no such places."""
    return (f"(CASE WHEN abs({x}) >= 1e15 THEN {x} ELSE "
            f"CAST(ROUND(TRY_CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,17)), {places}) AS DOUBLE) END)")


def sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def total(x: str) -> str:
    """Sum of doubles: by their written decimal form, values from 1e10 on apart."""
    return (f"(CAST(SUM(CASE WHEN abs({x}) < 1e10 THEN CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,12)) "
            f"WHEN ({x}) IS NOT NULL THEN 0 END) AS DOUBLE) "
            f"+ COALESCE(SUM(CASE WHEN abs({x}) >= 1e10 THEN {x} END), 0))")


def big(x: str) -> str:
    return f"CAST(({x}) AS BIGINT)"


STG_SQL = f"""
SELECT event_id, event_timestamp, event_date,
       lower(event_type) AS event_type, lower(partner) AS partner,
       CAST(cost_usd AS DOUBLE) AS cost_usd, app_id, campaign_id,
       upper(platform) AS platform, upper(country_code) AS country_code,
       CAST(year(event_date) AS BIGINT) AS year,
       CAST(month(event_date) AS BIGINT) AS month,
       CAST((dayofyear(event_date) + 7 - (dayofweek(event_date) + 1)) // 7 AS BIGINT) AS week,
       CAST(dayofweek(event_date) + 1 AS BIGINT) AS day_of_week
FROM (
  SELECT *, CAST(event_timestamp AS DATE) AS event_date
  FROM (
    SELECT *, strptime("timestamp", '%Y-%m-%dT%H:%M:%SZ') AS event_timestamp
    FROM raw
    WHERE "timestamp" IS NOT NULL
      AND event_type IN ({sql_list(EVENT_TYPES)})
      AND cost_usd >= 0 AND isfinite(cost_usd)
  ) p
) q
"""

_TYPES = [("installs", "install"), ("reinstalls", "reinstall"), ("clicks", "click"),
          ("impressions", "impression")]
_COSTS = [("install_cost", "install"), ("reinstall_cost", "reinstall"),
          ("click_cost", "click"), ("impression_cost", "impression")]


def _metric_select(key_expr: str, key_name: str) -> str:
    cols = [f"{key_expr} AS {key_name}", "partner", "platform"]
    cols += [f"{big(f'count_if(event_type = {chr(39)}{t}{chr(39)})')} AS {n}" for n, t in _TYPES]
    cols += [f"COALESCE({total('(CASE WHEN event_type = ' + chr(39) + t + chr(39) + ' THEN cost_usd END)')}, 0) AS {n}"
             for n, t in _COSTS]
    cols += [f"{total('cost_usd')} AS total_cost",
             f"{big('COUNT(*)')} AS total_events"]
    return (f"SELECT {', '.join(cols)} FROM stg_mmp_events "
            f"GROUP BY {key_expr}, partner, platform")


DAILY_SQL = _metric_select("event_date", "event_date")
WEEKLY_SQL = _metric_select("CAST(date_trunc('week', event_date) AS DATE)", "week_start_date")
MONTHLY_SQL = _metric_select("CAST(date_trunc('month', event_date) AS DATE)", "month_start_date")

_GRAIN_SOURCES = [("daily", "int_daily_metrics", "event_date"),
                  ("weekly", "int_weekly_metrics", "week_start_date"),
                  ("monthly", "int_monthly_metrics", "month_start_date")]


def _over_grains(select_body: str, where: str = "") -> str:
    parts = []
    for grain, table, key in _GRAIN_SOURCES:
        w = f" WHERE {where}" if where else ""
        parts.append(f"SELECT '{grain}' AS grain, CAST({key} AS VARCHAR) AS period, "
                     f"partner, platform, {select_body} FROM {table}{w}")
    return "\nUNION ALL\n".join(parts)


MART_IR_SQL = _over_grains(
    "installs, reinstalls, installs + reinstalls AS total_install_events, "
    "install_cost + reinstall_cost AS total_install_cost, "
    f"{rnd('install_cost + reinstall_cost', 2)} AS total_install_cost_rounded")

MART_CTR_SQL = _over_grains(
    "clicks, impressions, clicks / NULLIF(impressions, 0) AS ctr, "
    f"{rnd('clicks / NULLIF(impressions, 0) * 100', 2)} AS ctr_percentage",
    "impressions > 0")

MART_CPI_SQL = _over_grains(
    "installs, install_cost, total_cost, "
    "install_cost / NULLIF(installs, 0) AS cpi_direct, "
    "total_cost / NULLIF(installs, 0) AS cpi_blended, "
    f"{rnd('install_cost / NULLIF(installs, 0)', 2)} AS cpi_direct_rounded, "
    f"{rnd('total_cost / NULLIF(installs, 0)', 2)} AS cpi_blended_rounded",
    "installs > 0")

# Model CTEs in dependency order; every oracle query is "WITH <all> <body>".
MODEL_CTES = [
    ("raw", RAW_SQL),
    ("stg_mmp_events", STG_SQL),
    ("int_daily_metrics", DAILY_SQL),
    ("int_weekly_metrics", WEEKLY_SQL),
    ("int_monthly_metrics", MONTHLY_SQL),
    ("mart_installs_reinstalls", MART_IR_SQL),
    ("mart_click_through_rate", MART_CTR_SQL),
    ("mart_cost_per_install", MART_CPI_SQL),
]


# Staging of the defective events: unparsable timestamps are quarantined, any finite cost stays.
DIRTY_STG_SQL = (STG_SQL.replace("strptime(", "try_strptime(").replace("cost_usd >= 0 AND ", "")
                 + " WHERE event_timestamp IS NOT NULL")
DIRTY_CTES = [("raw", DIRTY_SQL), ("stg_mmp_events", DIRTY_STG_SQL), *MODEL_CTES[2:]]
EXTREME_CTES = [("raw", EXTREME_SQL), *MODEL_CTES[1:]]


def with_models(body: str, extra_ctes: list[tuple[str, str]] | None = None, models: list | None = None) -> str:
    ctes = (models or MODEL_CTES) + list(extra_ctes or [])
    return "WITH " + ",\n".join(f"{n} AS (\n{s}\n)" for n, s in ctes) + "\n" + body


ORACLE: dict[str, str] = {}


def register(name: str, body: str, extra_ctes=None, models=None) -> None:
    ORACLE[name] = with_models(body, extra_ctes, models)


register("stg_mmp_events", "SELECT * FROM stg_mmp_events")
register("int_daily_metrics", "SELECT * FROM int_daily_metrics")
register("int_weekly_metrics", "SELECT * FROM int_weekly_metrics")
register("int_monthly_metrics", "SELECT * FROM int_monthly_metrics")
register("mart_installs_reinstalls", "SELECT * FROM mart_installs_reinstalls")
register("mart_click_through_rate", "SELECT * FROM mart_click_through_rate")
register("mart_cost_per_install", "SELECT * FROM mart_cost_per_install")
register("int_extreme_costs", "SELECT * FROM mart_installs_reinstalls", models=EXTREME_CTES)


# --- Validation and report queries ------------------------------------------
def _share(x: str, total: str, places: int) -> str:
    return rnd(f"CAST({x} AS DOUBLE) * 100.0 / NULLIF(CAST({total} AS DOUBLE), 0)", places)


def _exact_avg(x: str) -> str:
    return f"({total(x)} / NULLIF(COUNT({x}), 0))"


register("v01_record_count", f"SELECT {big('COUNT(*)')} AS total_events FROM stg_mmp_events")

register("v02_event_distribution", f"""
SELECT event_type, event_count, {_share('event_count', 'SUM(event_count) OVER ()', 1)} AS percentage,
       {rnd('CAST(c AS DOUBLE)', 2)} AS total_cost
FROM (SELECT event_type, {big('COUNT(*)')} AS event_count, {total('cost_usd')} AS c
      FROM stg_mmp_events GROUP BY event_type) g""")

register("v03_partner_distribution", f"""
SELECT partner, event_count, {_share('event_count', 'SUM(event_count) OVER ()', 1)} AS percentage
FROM (SELECT partner, {big('COUNT(*)')} AS event_count FROM stg_mmp_events GROUP BY partner) g""")

register("v04_daily_summary", f"""
SELECT event_date, partner, platform, installs, clicks, impressions,
       {rnd('clicks / NULLIF(impressions, 0) * 100', 2)} AS ctr_pct,
       {rnd('total_cost', 2)} AS total_cost
FROM int_daily_metrics
ORDER BY event_date DESC, partner, platform
LIMIT 20""")


def _ratio_stats(table: str, keys: str, col: str, prefix: str) -> str:
    return f"""
SELECT {keys}, {rnd(_exact_avg(col), 2)} AS avg_{prefix}, {rnd(f'MIN({col})', 2)} AS min_{prefix},
       {rnd(f'MAX({col})', 2)} AS max_{prefix}, {big('COUNT(*)')} AS record_count
FROM {table} GROUP BY {keys}"""


register("v05_ctr_stats", _ratio_stats("mart_click_through_rate", "grain, partner",
                                       "ctr_percentage", "ctr_pct"))
register("v06_cpi_stats", _ratio_stats("mart_cost_per_install", "grain, platform",
                                       "cpi_direct_rounded", "cpi"))

register("v07_grain_coverage", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS mart_name, grain, {big('COUNT(*)')} AS record_count FROM {t} GROUP BY grain"
    for n, t in (("installs_reinstalls", "mart_installs_reinstalls"),
                 ("click_through_rate", "mart_click_through_rate"),
                 ("cost_per_install", "mart_cost_per_install"))))

register("v08_install_volume", f"""
SELECT partner, platform, {big('SUM(installs)')} AS total_installs,
       {big('SUM(reinstalls)')} AS total_reinstalls,
       {rnd(total('total_install_cost'), 2)} AS total_cost
FROM mart_installs_reinstalls WHERE grain = 'monthly' GROUP BY partner, platform""")

register("v09_cost_efficiency", f"""
SELECT partner, {rnd(_exact_avg('cpi_direct_rounded'), 2)} AS avg_cpi,
       {big('SUM(installs)')} AS total_installs,
       {rnd(total('install_cost'), 2)} AS total_spend
FROM mart_cost_per_install WHERE grain = 'daily' GROUP BY partner""")

register("v10_daily_trend", f"""
SELECT CAST(event_date AS VARCHAR) AS period, {big('SUM(installs)')} AS total_installs,
       {big('SUM(clicks)')} AS total_clicks, {big('SUM(impressions)')} AS total_impressions
FROM int_daily_metrics GROUP BY event_date ORDER BY period DESC LIMIT 30""")

register("v11_null_audit", f"""
SELECT {big('count_if(event_id IS NULL)')} AS null_event_id,
       {big('count_if(event_timestamp IS NULL)')} AS null_timestamp,
       {big('count_if(event_type IS NULL)')} AS null_event_type,
       {big('count_if(partner IS NULL)')} AS null_partner,
       {big('count_if(cost_usd IS NULL)')} AS null_cost,
       {big('COUNT(*)')} AS total_records
FROM stg_mmp_events""", models=DIRTY_CTES)

register("v12_cost_share", f"""
SELECT event_type, event_count, {rnd('CAST(c AS DOUBLE)', 2)} AS total_cost,
       {rnd('CAST(c AS DOUBLE) / NULLIF(n, 0)', 4)} AS avg_cost_per_event,
       {_share('c', 'SUM(c) OVER ()', 1)} AS cost_percentage
FROM (SELECT event_type, {big('COUNT(*)')} AS event_count, {total('cost_usd')} AS c,
             COUNT(cost_usd) AS n
      FROM stg_mmp_events GROUP BY event_type) g""")

register("rep_avg_ctr", f"""
SELECT grain, partner, platform, {_exact_avg('ctr_percentage')} AS avg_ctr
FROM mart_click_through_rate GROUP BY grain, partner, platform""")

register("rep_daily_installs", f"""
SELECT period, partner, {big('SUM(installs)')} AS installs, {big('SUM(reinstalls)')} AS reinstalls
FROM mart_installs_reinstalls WHERE grain = 'daily' GROUP BY period, partner""")

register("rep_ctr_platform", f"""
SELECT grain, period, platform, clicks, impressions, clicks / NULLIF(impressions, 0) AS ctr,
       {rnd('clicks / NULLIF(impressions, 0) * 100', 2)} AS ctr_percentage
FROM (SELECT grain, period, platform, {big('SUM(clicks)')} AS clicks,
             {big('SUM(impressions)')} AS impressions
      FROM mart_click_through_rate GROUP BY grain, period, platform) g""")

register("rep_cpi_partner", f"""
SELECT grain, period, partner, installs, CAST(ic AS DOUBLE) AS install_cost,
       CAST(tc AS DOUBLE) AS total_cost,
       {rnd('CAST(ic AS DOUBLE) / NULLIF(installs, 0)', 2)} AS cpi_direct,
       {rnd('CAST(tc AS DOUBLE) / NULLIF(installs, 0)', 2)} AS cpi_blended
FROM (SELECT grain, period, partner, {big('SUM(installs)')} AS installs,
             {total('install_cost')} AS ic, {total('total_cost')} AS tc
      FROM mart_cost_per_install GROUP BY grain, period, partner) g""")


# --- Order and load stamp as data ----------------------------------------------


def _placed(order: str, cols: str, table: str) -> str:
    return f"SELECT {cols}, {big(f'row_number() OVER (ORDER BY {order})')} AS position FROM {table}"


register("ord_daily_metrics", _placed(
    "event_date DESC NULLS LAST, partner NULLS FIRST, platform NULLS FIRST",
    "event_date, partner, platform, total_events", "int_daily_metrics"))
register("ord_mart_click_through_rate", _placed(
    "grain, period DESC, partner NULLS FIRST, platform NULLS FIRST",
    "grain, period, partner, platform, clicks, impressions", "mart_click_through_rate"))
register("ord_ctr_stats", _placed("grain, avg_ctr_pct DESC NULLS LAST, partner NULLS FIRST", "*", "(" + _ratio_stats(
    "mart_click_through_rate", "grain, partner", "ctr_percentage", "ctr_pct") + ") s"))
register("ord_cpi_stats", _placed("grain, avg_cpi NULLS FIRST, platform NULLS FIRST", "*", "(" + _ratio_stats(
    "mart_cost_per_install", "grain, platform", "cpi_direct_rounded", "cpi") + ") s"))
register("int_weekly_stamped", """
SELECT week_start_date, partner, platform, total_events,
       (SELECT MAX(event_timestamp) FROM stg_mmp_events) AS dbt_updated_at
FROM int_weekly_metrics""")


# --- Data tests ---------------------------------------------------------------


def _check_expr(c: Check) -> str:
    if c.kind == "expression_is_true":
        return f"{c.column} {c.expression}" if c.column else c.expression
    if c.kind == "accepted_range":
        return f"{c.column} >= {c.lo} AND {c.column} <= {c.hi}"
    raise ValueError(c.kind)


def _failing_sql(c: Check) -> str:
    if c.kind == "unique":
        return (f"SELECT {c.column} AS unique_field, {big('COUNT(*)')} AS n_records FROM {c.table} "
                f"WHERE {c.column} IS NOT NULL GROUP BY {c.column} HAVING COUNT(*) > 1")
    if c.kind == "not_null":
        return f"SELECT * FROM {c.table} WHERE {c.column} IS NULL"
    if c.kind == "accepted_values":
        return (f"SELECT * FROM (SELECT {c.column} AS value_field, {big('COUNT(*)')} AS n_records "
                f"FROM {c.table} GROUP BY {c.column}) v WHERE value_field NOT IN ({sql_list(c.values)})")
    where = f"({c.where}) AND " if c.where else ""
    return f"SELECT * FROM {c.table} WHERE {where}NOT ({_check_expr(c)})"


def _meta_sql(c: Check) -> str:
    col = f"'{c.column}'" if c.column else "CAST(NULL AS VARCHAR)"
    return (f"'{c.test_name}' AS test_name, '{c.table}' AS table_name, {col} AS column_name, "
            f"'{c.severity}' AS severity")


def _count_sql(c: Check) -> str:
    return f"SELECT {_meta_sql(c)}, {big('COUNT(*)')} AS failures FROM ({_failing_sql(c)}) f"


def _report_sql(checks) -> str:
    body = "\nUNION ALL\n".join(_count_sql(c) for c in checks)
    return (f"SELECT *, CASE WHEN failures = 0 THEN 'PASS' WHEN severity = 'warn' THEN 'WARN' "
            f"ELSE 'FAIL' END AS status FROM (\n{body}\n) r")


def _by_name(n: str) -> Check:
    return next(c for c in DECLARED_CHECKS if c.test_name == n)


for _key, _test in (
        ("dq_unique_event_id", "unique_stg_mmp_events_event_id"),
        ("dq_cost_non_negative", "expression_is_true_stg_mmp_events_cost_usd"),
        ("dq_ctr_range", "expression_is_true_mart_click_through_rate_ctr_in_0_1"),
        ("dq_impressions_ge_clicks", "expression_is_true_mart_click_through_rate_impressions_ge_clicks"),
        ("dq_ctr_percentage_range", "accepted_range_mart_click_through_rate_ctr_percentage"),
        ("dq_cpi_direct_non_negative", "expression_is_true_mart_cost_per_install_cpi_direct_ge_0"),
        ("dq_cpi_blended_ge_direct", "expression_is_true_mart_cost_per_install_cpi_blended_ge_direct")):
    register(_key, _failing_sql(_by_name(_test)), models=DIRTY_CTES)

register("dq_not_null", "SELECT test_name, table_name, column_name, failures FROM (\n"
         + "\nUNION ALL\n".join(_count_sql(c) for c in DECLARED_CHECKS if c.kind == "not_null")
         + "\n) r", models=DIRTY_CTES)
register("dq_accepted_values", "\nUNION ALL\n".join(
    f"SELECT '{c.table}' AS table_name, '{c.column}' AS column_name, "
    f"CAST(value_field AS VARCHAR) AS value_field, n_records FROM ({_failing_sql(c)}) f"
    for c in DECLARED_CHECKS if c.kind == "accepted_values"), models=DIRTY_CTES)
register("dq_report", _report_sql(DECLARED_CHECKS), models=DIRTY_CTES)


# --- Sources, staging extras, incremental -------------------------------------
register("src_jsonl_roundtrip", "SELECT * FROM raw")

register("src_batch_counts", f"""
SELECT 'mmp_events_' || replace(substr("timestamp", 1, 10), '-', '') || '_000000' AS batch,
       {big('COUNT(*)')} AS event_count, {total('cost_usd')} AS total_cost
FROM raw GROUP BY 1""")

register("src_batch_presence", """
SELECT day, 'mmp_events_' || strftime(day, '%Y%m%d') || '_000000' AS batch,
       day IN (SELECT CAST(substr("timestamp", 1, 10) AS DATE) FROM raw WHERE "timestamp" IS NOT NULL) AS present
FROM (SELECT CAST(unnest(generate_series(MIN(d), MAX(d) + INTERVAL 7 DAY, INTERVAL 1 DAY)) AS DATE) AS day
      FROM (SELECT CAST(substr("timestamp", 1, 10) AS DATE) AS d FROM raw) r) s""")

register("src_file_sizes", f"""
SELECT COALESCE('mmp_events_' || replace(substr("timestamp", 1, 10), '-', '') || '_000000',
                '__HIVE_DEFAULT_PARTITION__') AS batch,
       {big('COUNT(*)')} AS event_count, true AS size_matches
FROM raw GROUP BY 1""")

_CPI_COLUMNS = ["grain", "period", "partner", "platform", "installs", "install_cost", "total_cost",
                "cpi_direct", "cpi_blended", "cpi_direct_rounded", "cpi_blended_rounded"]


def _text(s: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if s is None else "'" + s.replace("'", "''") + "'"


register("out_column_comments", "\nUNION ALL\n".join(
    f"SELECT {_text(c)} AS column_name, {_text(doc)} AS comment, {big(f'COUNT({c or chr(42)})')} AS n_values "
    "FROM mart_cost_per_install"
    for c, doc in [(None, TABLE_DOCS["mart_cost_per_install"])] + [(c, METRIC_DOCS.get(c)) for c in _CPI_COLUMNS]))

register("out_table_roundtrip", "SELECT * FROM int_daily_metrics")

register("stg_date_parts", f"""
SELECT year, month, week, day_of_week, {big('COUNT(*)')} AS events,
       MIN(event_date) AS first_date, MAX(event_date) AS last_date
FROM stg_mmp_events GROUP BY year, month, week, day_of_week""")

register("stg_rejects_by_reason", f"""
SELECT reject_reason, {big('COUNT(*)')} AS rejected_rows FROM (
  SELECT CASE WHEN "timestamp" IS NULL THEN 'null_timestamp'
              WHEN NOT COALESCE(event_type IN ({sql_list(EVENT_TYPES)}), false) THEN 'invalid_event_type'
              WHEN NOT COALESCE(cost_usd >= 0 AND isfinite(cost_usd), false) THEN 'invalid_cost'
              WHEN try_strptime("timestamp", '%Y-%m-%dT%H:%M:%SZ') IS NULL THEN 'invalid_timestamp_format'
         END AS reject_reason
  FROM raw) r
WHERE reject_reason IS NOT NULL GROUP BY reject_reason""")

_STG_KEEP = "event_id, event_date, event_type, partner, platform, cost_usd"
_CUT = "(SELECT CAST(date_trunc('month', MAX(event_date)) AS DATE) FROM stg_mmp_events)"

register("incr_new_rows", f"""
SELECT {_STG_KEEP} FROM stg_mmp_events
WHERE COALESCE(event_date > (SELECT MAX(event_date) FROM stg_mmp_events WHERE event_date < {_CUT}), true)""")

_SENT = f"""
SELECT {_STG_KEEP}, 'increment' AS load_batch FROM stg_mmp_events
WHERE event_date >= CAST({_CUT} - INTERVAL 7 DAY AS DATE) AND CAST(event_id AS BIGINT) % 5 <> 0
UNION ALL
SELECT event_id, CAST(event_date + INTERVAL 1 DAY AS DATE), event_type, partner, platform, cost_usd, 'moved'
FROM stg_mmp_events
WHERE event_date >= CAST({_CUT} - INTERVAL 7 DAY AS DATE) AND CAST(event_id AS BIGINT) % 5 = 0"""
register("incr_merge_by_key", f"""
SELECT {_STG_KEEP}, 'initial' AS load_batch FROM stg_mmp_events t
WHERE event_date < {_CUT} AND event_id NOT IN (SELECT event_id FROM sent)
UNION ALL SELECT * FROM sent""", [("sent", _SENT)])
register("incr_landed_late", f"SELECT {_STG_KEEP} FROM stg_mmp_events")
register("incr_batch_job", f"SELECT {_STG_KEEP} FROM stg_mmp_events")

register("out_partition_pruned", f"""
SELECT event_date, {big('COUNT(*)')} AS events, {total('cost_usd')} AS total_cost
FROM stg_mmp_events
WHERE event_date > CAST((SELECT MAX(event_date) FROM stg_mmp_events) - INTERVAL 7 DAY AS DATE)
GROUP BY event_date""")


# --- Raw-event validator --------------------------------------------------------


def _t(f: str) -> str:
    return f"json_type(sl, '$.{f}')"


def _s(f: str) -> str:
    return f"json_extract_string(sl, '$.{f}')"


def _py(f: str) -> str:
    t, s = _t(f), _s(f)
    return (f"(CASE WHEN {t} = 'VARCHAR' THEN {s} WHEN {t} = 'NULL' THEN 'None' "
            f"WHEN {t} = 'BOOLEAN' THEN (CASE WHEN {s} = 'true' THEN 'True' ELSE 'False' END) "
            f"WHEN {t} = 'DOUBLE' THEN CAST(CAST({s} AS DOUBLE) AS VARCHAR) ELSE {s} END)")


def _str(f: str) -> str:
    return f"(CASE WHEN {_t(f)} = 'VARCHAR' THEN {_s(f)} END)"


_COST_NUM = (f"(CASE WHEN {_t('cost_usd')} IN ('UBIGINT', 'BIGINT', 'DOUBLE') "
             f"THEN CAST({_s('cost_usd')} AS DOUBLE) "
             f"WHEN {_t('cost_usd')} = 'BOOLEAN' THEN CAST({_s('cost_usd')} = 'true' AS DOUBLE) "
             f"WHEN {_t('cost_usd')} = 'VARCHAR' AND regexp_matches({_s('cost_usd')}, '{_NUMERIC_STRING}') "
             f"THEN TRY_CAST(trim({_s('cost_usd')}) AS DOUBLE) END)")

_TS2 = f"replace({_str('timestamp')}, 'Z', '+00:00')"


def _g(pattern: str, i: int) -> str:
    return f"COALESCE(TRY_CAST(NULLIF(regexp_extract({_TS2}, '{pattern}', {i}), '') AS INTEGER), 0)"


_TS_OK = (f"COALESCE(regexp_matches({_TS2}, '{_ISO}') AND TRY_CAST(substr({_TS2}, 1, 4) AS INTEGER) >= 1 "
          f"AND TRY_CAST(substr({_TS2}, 1, 10) AS DATE) IS NOT NULL "
          f"AND {_g(_TIME, 1)} <= 23 AND {_g(_TIME, 3)} <= 59 AND {_g(_TIME, 5)} <= 59 "
          f"AND {_g(_OFFSET, 1)} * 3600 + {_g(_OFFSET, 2)} * 60 + {_g(_OFFSET, 4)} < 86400, false)")

_RULES = f"""list_filter([
  CASE WHEN NOT COALESCE({_str('event_type')} IN ({sql_list(VALID_EVENT_TYPES)}), false)
       THEN 'Invalid event_type: ' || {_py('event_type')} || '. Must be one of {_pylist(VALID_EVENT_TYPES).replace("'", "''")}' END,
  CASE WHEN NOT COALESCE({_str('platform')} IN ({sql_list(VALID_PLATFORMS)}), false)
       THEN 'Invalid platform: ' || {_py('platform')} || '. Must be one of {_pylist(VALID_PLATFORMS).replace("'", "''")}' END,
  CASE WHEN {_COST_NUM} IS NULL OR NOT isfinite({_COST_NUM}) THEN 'Invalid cost_usd value: ' || {_py('cost_usd')}
       WHEN {_COST_NUM} < 0 THEN 'Cost must be non-negative: ' || CAST({_COST_NUM} AS VARCHAR) END,
  CASE WHEN NOT {_TS_OK} THEN 'Invalid timestamp format: ' || {_py('timestamp')} END,
  CASE WHEN NOT COALESCE(length({_str('event_id')}) > 0, false) THEN 'event_id must be a non-empty string' END
], lambda x: x IS NOT NULL)"""

_REQ = "[" + sql_list(REQUIRED_FIELDS) + "]"

VALIDATED_SQL = f"""
SELECT line_id, line, keys, sl,
  CASE WHEN keys IS NULL THEN ['Event is not a JSON object']
       WHEN len(missing) > 0 THEN missing
       ELSE {_RULES} END AS errors
FROM (
  SELECT *, list_transform(list_filter({_REQ}, lambda f: NOT list_contains(keys, f)),
                           lambda f: 'Missing required field: ' || f) AS missing
  FROM (
    SELECT line_id, line, sl, CASE WHEN json_type(sl) = 'OBJECT' THEN json_keys(sl) END AS keys
    FROM (SELECT *, CASE WHEN json_valid(line) THEN line ELSE 'null' END AS sl FROM val_lines) a
  ) b
) c
"""

_VAL_CTES = [("val_lines", LINES_SQL), ("validated", VALIDATED_SQL)]

_RULE_OF = """CASE WHEN msg = 'Event is not a JSON object' THEN 'not_object'
  WHEN starts_with(msg, 'Missing required field: ') THEN 'missing_field'
  WHEN starts_with(msg, 'Invalid event_type') THEN 'event_type'
  WHEN starts_with(msg, 'Invalid platform') THEN 'platform'
  WHEN starts_with(msg, 'Invalid cost_usd') THEN 'cost_invalid'
  WHEN starts_with(msg, 'Cost must be') THEN 'cost_negative'
  WHEN starts_with(msg, 'Invalid timestamp') THEN 'timestamp'
  WHEN msg = 'event_id must be a non-empty string' THEN 'event_id' ELSE 'other' END"""

register("val_missing_fields", f"""
SELECT substr(msg, length('Missing required field: ') + 1) AS field, {big('COUNT(*)')} AS events
FROM (SELECT unnest(errors) AS msg FROM validated) m
WHERE starts_with(msg, 'Missing required field: ') GROUP BY 1""", _VAL_CTES)

register("val_errors_by_rule", f"""
SELECT {_RULE_OF} AS rule, {big('COUNT(*)')} AS errors
FROM (SELECT unnest(errors) AS msg FROM validated) m GROUP BY 1""", _VAL_CTES)

register("val_batch_counts", f"""
SELECT {big('count_if(len(errors) = 0)')} AS valid_count,
       {big('count_if(len(errors) > 0)')} AS invalid_count FROM validated""", _VAL_CTES)

register("val_first_errors", """
SELECT line_id, 'Event ' || CAST(line_id AS VARCHAR) || ': ' || array_to_string(errors, '; ') AS summary
FROM validated WHERE len(errors) > 0 ORDER BY line_id LIMIT 10""", _VAL_CTES)

register("val_event_distribution", f"""
SELECT CASE WHEN keys IS NOT NULL AND list_contains(keys, 'event_type') THEN {_py('event_type')}
            ELSE 'unknown' END AS event_type, {big('COUNT(*)')} AS events
FROM validated GROUP BY 1""", _VAL_CTES)

_TOTAL_COST = f"""
SELECT {total('c')} AS total_cost
FROM (SELECT CASE WHEN {_COST_NUM} IS NOT NULL AND isfinite({_COST_NUM}) THEN {_COST_NUM} ELSE 0.0 END AS c
      FROM validated) v"""
register("val_total_cost", _TOTAL_COST, _VAL_CTES)

register("val_extreme_costs", _TOTAL_COST, _VAL_CTES, models=EXTREME_CTES)

_LANDED = f"""
SELECT *, CASE WHEN json_valid(line) THEN line ELSE 'null' END AS sl FROM ({LANDED_SQL}) l"""
_BAD_COST = f"({_t('cost_usd')} <> 'NULL' AND ({_COST_NUM} IS NULL OR NOT isfinite({_COST_NUM})))"
_REASONS = f"""
SELECT line_id, line, CASE
    WHEN NOT json_valid(line) OR json_type(sl) <> 'OBJECT' OR COALESCE({_BAD_COST}, false) THEN 'malformed_record'
    WHEN {_s('timestamp')} IS NULL THEN 'null_timestamp'
    WHEN NOT COALESCE({_s('event_type')} IN ({sql_list(EVENT_TYPES)}), false) THEN 'invalid_event_type'
    WHEN NOT COALESCE({_COST_NUM} >= 0, false) THEN 'invalid_cost'
    WHEN try_strptime({_s('timestamp')}, '%Y-%m-%dT%H:%M:%SZ') IS NULL THEN 'invalid_timestamp_format'
  END AS reject_reason
FROM landed"""
_REJECT_CTES = [("landed", _LANDED), ("reasons", _REASONS)]
register("stg_rejects_all_reasons", """
SELECT line_id, reject_reason, CASE WHEN reject_reason = 'malformed_record' THEN line END AS record
FROM reasons WHERE reject_reason IS NOT NULL""", _REJECT_CTES)
register("stg_lines_accounted", f"""
SELECT {big('COUNT(*)')} AS lines, {big('count_if(reject_reason IS NULL)')} AS accepted,
       {big('count_if(reject_reason IS NOT NULL)')} AS rejected FROM reasons""", _REJECT_CTES)

_OK_EVENTS = f"""
SELECT {_str('event_type')} AS event_type, {_str('partner')} AS partner, {_str('platform')} AS platform,
       {_COST_NUM} AS cost_usd
FROM validated WHERE len(errors) = 0"""

register("val_summary", f"""
SELECT dimension, value, events, cost,
       {rnd('events * 100.0 / NULLIF(CAST(n AS DOUBLE), 0)', 1)} AS percentage,
       n AS total_events, c AS total_cost, {rnd('c / NULLIF(n, 0)', 2)} AS avg_cost
FROM (
  SELECT 'event_type' AS dimension, event_type AS value, {big('COUNT(*)')} AS events,
         {total('cost_usd')} AS cost FROM ok_events GROUP BY event_type
  UNION ALL
  SELECT 'partner', partner, {big('COUNT(*)')}, {total('cost_usd')}
  FROM ok_events GROUP BY partner
  UNION ALL
  SELECT 'platform', platform, {big('COUNT(*)')}, {total('cost_usd')}
  FROM ok_events GROUP BY platform
  UNION ALL
  SELECT 'total', NULL, {big('COUNT(*)')}, {total('cost_usd')}
  FROM ok_events
) g, (SELECT {big('COUNT(*)')} AS n, {total('cost_usd')} AS c FROM ok_events) t
""", _VAL_CTES + [("ok_events", _OK_EVENTS)])


# --- Synthetic events -----------------------------------------------------------

_SEED, _DAYS, _AS_OF = 42, 30, "2026-02-12 00:00:00"


def _dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _u(field: str) -> str:
    h = f"md5('{_SEED}:{field}:' || CAST(event_id AS VARCHAR))"
    return f"(CAST(('0x' || substr({h}, 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE))"


def _weighted(field: str) -> str:
    cum = cumulative(WEIGHTED_FIELDS[field])
    whens = " ".join(f"WHEN {_u(field)} < {_dbl(b)} THEN '{v}'" for v, b in cum[:-1])
    return f"(CASE {whens} ELSE '{cum[-1][0]}' END)"


def _uniform(field: str, values) -> str:
    return f"list_extract([{sql_list(values)}], CAST(floor({_u(field)} * {len(values)}) + 1 AS INTEGER))"


_H = f"md5('{_SEED}:event_id:' || CAST(event_id AS VARCHAR))"
_COST = "(CASE " + " ".join(
    f"WHEN event_type = '{t}' THEN {rnd(f'{_dbl(lo)} + {_dbl(hi - lo)} * u_cost', 2)}"
    for t, (lo, hi) in COST_RANGES.items()) + " END)"

GEN_SQL = f"""
SELECT synth_key, event_id, "timestamp", event_type, partner, {_COST} AS cost_usd,
       app_id, campaign_id, platform, country_code
FROM (
  SELECT CAST(event_id AS BIGINT) AS synth_key,
    substr({_H}, 1, 8) || '-' || substr({_H}, 9, 4) || '-' || substr({_H}, 13, 4) || '-'
      || substr({_H}, 17, 4) || '-' || substr({_H}, 21, 12) AS event_id,
    strftime(TIMESTAMP '{_AS_OF}' - to_seconds(CAST(floor({_u('timestamp')} * {_DAYS * 86400 + 1}) AS BIGINT)),
             '%Y-%m-%dT%H:%M:%SZ') AS "timestamp",
    {_weighted('event_type')} AS event_type,
    {_weighted('partner')} AS partner,
    {_u('cost_usd')} AS u_cost,
    {_uniform('app_id', SAMPLE_APPS)} AS app_id,
    {_uniform('campaign_id', SAMPLE_CAMPAIGNS)} AS campaign_id,
    {_weighted('platform')} AS platform,
    {_weighted('country_code')} AS country_code
  FROM events) g
"""

_GEN_CTES = [("gen", GEN_SQL)]
register("gen_events", "SELECT * FROM gen", _GEN_CTES)

_COUNTS = "\nUNION ALL\n".join(
    f"SELECT '{f}' AS field, {f} AS value, {big('COUNT(*)')} AS events FROM gen GROUP BY {f}"
    for f in WEIGHTED_FIELDS)
register("gen_weighted_choice", _COUNTS, _GEN_CTES)

_WEIGHTS = "\nUNION ALL\n".join(
    f"SELECT '{f}' AS field, '{v}' AS value, {_dbl(w)} AS weight"
    for f, ws in WEIGHTED_FIELDS.items() for v, w in ws)
register("gen_distribution_check", f"""
SELECT c.field, c.value, c.events, c.events / CAST(t.n AS DOUBLE) AS share, w.weight,
       abs(c.events / CAST(t.n AS DOUBLE) - w.weight) <= 0.05 AS within_tolerance
FROM ({_COUNTS}) c
LEFT JOIN ({_WEIGHTS}) w ON c.field = w.field AND c.value = w.value,
     (SELECT COUNT(*) AS n FROM gen) t""", _GEN_CTES)


# --- Pipeline build and streaming ingest -------------------------------------------
register("build_mart_click_through_rate", "SELECT * FROM mart_click_through_rate")
register("build_extreme_weekly", "SELECT * FROM int_weekly_metrics", models=EXTREME_CTES)
register("build_int_monthly_metrics", "SELECT * FROM int_monthly_metrics")
register("build_test_report", _report_sql(DECLARED_CHECKS))
register("build_refresh_replaces", f"""
SELECT event_date, {big('COUNT(*)')} AS events FROM stg_mmp_events
WHERE event_date < (SELECT CAST(MAX(substr("timestamp", 1, 7)) || '-01' AS DATE) FROM raw) GROUP BY event_date""")
register("build_view_staging", "SELECT * FROM mart_installs_reinstalls")
# events of the first month's last day whose id divides by 11 were last sent a day later
_MOVED_RAW = f"""
SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 11 = 0 AND substr("timestamp", 1, 10) = (
    SELECT MAX(substr("timestamp", 1, 10)) FROM ({RAW_SQL}) a
    WHERE substr("timestamp", 1, 7) = (SELECT MIN(substr("timestamp", 1, 7)) FROM ({RAW_SQL}) b))
  THEN strftime(strptime("timestamp", '%Y-%m-%dT%H:%M:%SZ') + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%SZ')
  ELSE "timestamp" END AS "timestamp")
FROM ({RAW_SQL}) r"""
_MOVED_CTES = [("raw", _MOVED_RAW), *MODEL_CTES[1:]]
_LATER_RAW = f"""
SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 5 = 0
  THEN strftime(strptime("timestamp", '%Y-%m-%dT%H:%M:%SZ') + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%SZ')
  ELSE "timestamp" END AS "timestamp")
FROM ({RAW_SQL}) r"""
register("incr_retried_merge", "SELECT * FROM int_daily_metrics", models=[("raw", _LATER_RAW), *MODEL_CTES[1:]])
register("incr_stream_ingest", f"SELECT {_STG_KEEP} FROM stg_mmp_events", models=_MOVED_CTES)
register("incr_stream_marts", "SELECT * FROM mart_click_through_rate", models=_MOVED_CTES)
register("gen_landed_batch", 'SELECT event_id, "timestamp", event_type, partner, cost_usd, app_id, '
         "campaign_id, platform, country_code FROM gen", _GEN_CTES)
register("src_inventory_by_batch", f"""
SELECT COALESCE('mmp_events_' || replace(substr("timestamp", 1, 10), '-', '') || '_000000',
                '__HIVE_DEFAULT_PARTITION__') AS batch,
       {big('COUNT(*)')} AS event_count, true AS has_bytes
FROM raw GROUP BY 1""")
register("src_landing_manifest", f"""
SELECT COALESCE('mmp_events_' || replace(substr("timestamp", 1, 10), '-', '') || '_000000',
                '__HIVE_DEFAULT_PARTITION__') AS batch,
       {big('ceil(COUNT(*) / 1000)')} AS files, {big('COUNT(*)')} AS event_count,
       {big(f"""COUNT(*) FILTER (WHERE NOT COALESCE(event_id <> '' AND "timestamp" IS NOT NULL AND partner IS NOT NULL
         AND app_id IS NOT NULL AND campaign_id IS NOT NULL AND country_code IS NOT NULL AND cost_usd >= 0
         AND event_type IN ({sql_list(VALID_EVENT_TYPES)}) AND platform IN ({sql_list(VALID_PLATFORMS)}), false))""")} AS invalid_count,
       true AS has_bytes
FROM raw GROUP BY 1""")
