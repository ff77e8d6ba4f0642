"""Raw-event validator over JSON text lines, as one Spark projection.

Each line is parsed once (``try_parse_json`` -> variant); every rule is a
column expression producing an optional message, and the messages are
gathered in rule order with ``array_compact(array(...))``. No
Python runs per row, nothing is collected: verdicts, counts and summaries
are aggregates.

Rules, in order:

1. the line must be a JSON object (malformed lines, arrays and scalars fail
   once; text after a complete object is ignored, as the JSON reader does);
2. every required key must be present (a JSON ``null`` counts as present);
   when any is missing only the missing-key messages are reported;
3. ``event_type`` and ``platform`` must be one of the accepted strings
   (case-sensitive);
4. ``cost_usd`` must convert to a number (numbers, booleans and numeric
   strings do) and be >= 0;
5. ``timestamp`` must be an ISO 8601 string (``YYYY-MM-DD`` + any separator
   + ``HH[:MM[:SS[.fff|.ffffff]]]`` + optional ``+HH:MM`` offset, a ``Z``
   meaning ``+00:00``) naming a real date and time;
6. ``event_id`` must be a non-empty string.

Deliberate differences from a Python ``float()``: NaN, infinity and
underscore digit groups in a string cost are rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.constants import REQUIRED_FIELDS, VALID_EVENT_TYPES, VALID_PLATFORMS
from adlens.functions.numeric import exact_sum, round_half_up, safe_divide

NOT_OBJECT = "Event is not a JSON object"
MISSING = "Missing required field: "
BAD_EVENT_ID = "event_id must be a non-empty string"

_NUMERIC_STRING = r"^\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"
# YYYY-MM-DD, any one separator, HH[:MM[:SS[.fff|.ffffff]]], optional offset.
_ISO = (r"^([0-9]{4})-([0-9]{2})-([0-9]{2})"
        r"(.([0-9]{2})(:([0-9]{2})(:([0-9]{2})([.]([0-9]{3}|[0-9]{6}))?)?)?"
        r"([+-]([0-9]{2}):([0-9]{2})(:([0-9]{2})([.][0-9]{6})?)?)?)?$")
# Parts of a string that matched _ISO: time fields, then the UTC offset.
_TIME = r"^.{11}([0-9]{2})(:([0-9]{2})(:([0-9]{2}))?)?"
_OFFSET = r"[+-]([0-9]{2}):([0-9]{2})(:([0-9]{2})([.][0-9]{6})?)?$"


def _pylist(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_CHECKED = ["event_type", "platform", "cost_usd", "timestamp", "event_id"]
_NUMBER_KIND = r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$"
_FRACTION_KIND = r"^(DOUBLE|FLOAT|DECIMAL.*)$"


def _c(name: str) -> Column:
    return F.col(name)


_JSON_SCHEMA = ", ".join(f"{f} variant" for f in REQUIRED_FIELDS) + ", _corrupt string"
_JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def _parse(lines: DataFrame, line_col: str, fields: list[str]) -> DataFrame:
    """Parse each line once, then derive per-field columns in small steps.

    One ``from_json`` into a struct of variants gives, per required key,
    SQL NULL when the key is absent and a variant (JSON null included) when
    it is present; a line that is not a JSON object lands in ``_corrupt``.
    Every later step is its own projection over named columns, so no
    expression tree repeats another. Adds ``_is_object``, ``_present_f``
    for all required keys and, per checked field f, ``_v_f`` (variant),
    ``_k_f`` (its type name) and ``_s_f`` (string value or null).
    """
    df = lines.withColumn("_j", F.from_json(_c(line_col), _JSON_SCHEMA, _JSON_OPTIONS))
    df = df.withColumns({
        "_is_object": F.coalesce(_c("_j").isNotNull() & _c("_j._corrupt").isNull(), F.lit(False)),
        **{f"_v_{f}": _c(f"_j.{f}") for f in REQUIRED_FIELDS},
        **{f"_present_{f}": _c(f"_j.{f}").isNotNull() for f in REQUIRED_FIELDS},
    })
    df = df.withColumns({f"_k_{f}": F.schema_of_variant(_c(f"_v_{f}")) for f in fields})
    df = df.withColumns({f"_s_{f}": F.when(_c(f"_k_{f}") == "STRING",
                                           F.try_variant_get(_c(f"_v_{f}"), "$", "string"))
                         for f in fields})
    return df.drop("_j")


def _text(f: str) -> Column:
    """Field ``f`` as Python's ``str()`` prints the parsed JSON value.

    Used only inside the failing branch of a message, so it is evaluated
    for invalid lines only.
    """
    v, k = _c(f"_v_{f}"), _c(f"_k_{f}")
    return (F.when(k == "STRING", _c(f"_s_{f}"))
             .when(k == "VOID", F.lit("None"))
             .when(k == "BOOLEAN", F.when(F.try_variant_get(v, "$", "boolean"), F.lit("True"))
                   .otherwise(F.lit("False")))
             .when(k.rlike(_FRACTION_KIND), F.try_variant_get(v, "$", "double").cast("string"))
             .when(k.rlike(_NUMBER_KIND), F.try_variant_get(v, "$", "bigint").cast("string"))
             .otherwise(F.to_json(v)))


def _with_cost_number(df: DataFrame) -> DataFrame:
    k, v, s = _c("_k_cost_usd"), _c("_v_cost_usd"), _c("_s_cost_usd")
    num = (F.when(k.rlike(_NUMBER_KIND), F.try_variant_get(v, "$", "double"))
            .when(k == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("double"))
            .when(s.rlike(_NUMERIC_STRING), F.trim(s).try_cast("double")))
    df = df.withColumn("_num", num)
    return df.withColumn("_num_ok", F.coalesce(~F.isnan("_num") & (F.abs("_num") != F.lit(float("inf"))),
                                               F.lit(False)))


# The common shape (what the generator writes): checked with one regex and a
# calendar check; only other strings go through the full grammar.
_FAST_TS = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}.[0-9]{2}:[0-9]{2}:[0-9]{2}[+]00:00$"


def _full_timestamp_ok(s: Column) -> Column:
    def num(pattern: str, i: int) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(s, pattern, i), F.lit("")).try_cast("int"),
                          F.lit(0))
    date = F.try_make_timestamp_ntz(num(_ISO, 1), num(_ISO, 2), num(_ISO, 3),
                                    F.lit(0), F.lit(0), F.lit(0))
    return (s.rlike(_ISO) & (num(_ISO, 1) >= 1) & date.isNotNull()
            & (num(_TIME, 1) <= 23) & (num(_TIME, 3) <= 59) & (num(_TIME, 5) <= 59)
            & ((num(_OFFSET, 1) * 3600 + num(_OFFSET, 2) * 60 + num(_OFFSET, 4)) < 86400))


def _fast_timestamp_ok(s: Column) -> Column:
    part = lambda start, n: F.substring(s, start, n).cast("int")
    made = F.try_make_timestamp_ntz(part(1, 4), part(6, 2), part(9, 2),
                                    part(12, 2), part(15, 2), part(18, 2))
    # make_timestamp rolls second 60 over to the next minute; ISO does not.
    return (part(1, 4) >= 1) & (part(18, 2) <= 59) & made.isNotNull()


def _with_timestamp_ok(df: DataFrame) -> DataFrame:
    df = df.withColumn("_ts", F.replace(_c("_s_timestamp"), F.lit("Z"), F.lit("+00:00")))
    s = _c("_ts")
    ok = F.when(s.rlike(_FAST_TS), _fast_timestamp_ok(s)).otherwise(_full_timestamp_ok(s))
    return df.withColumn("_ts_ok", F.coalesce(ok, F.lit(False)))


def _member(f: str, values) -> Column:
    return F.coalesce(_c(f"_s_{f}").isin(*values), F.lit(False))


def _drop_work(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def validate_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Add ``errors`` (array<string>, rule order), ``is_valid`` and ``event``
    (the typed fields: strings, and ``cost_usd`` as a double)."""
    df = _with_timestamp_ok(_with_cost_number(_parse(lines, line_col, _CHECKED)))
    df = df.withColumns({
        "_m_type": F.when(~_member("event_type", VALID_EVENT_TYPES),
                          F.concat(F.lit("Invalid event_type: "), _text("event_type"),
                                   F.lit(f". Must be one of {_pylist(VALID_EVENT_TYPES)}"))),
        "_m_platform": F.when(~_member("platform", VALID_PLATFORMS),
                              F.concat(F.lit("Invalid platform: "), _text("platform"),
                                       F.lit(f". Must be one of {_pylist(VALID_PLATFORMS)}"))),
        "_m_cost": F.when(~_c("_num_ok"),
                          F.concat(F.lit("Invalid cost_usd value: "), _text("cost_usd")))
                    .when(_c("_num") < 0, F.concat(F.lit("Cost must be non-negative: "),
                                                   _c("_num").cast("string"))),
        "_m_ts": F.when(~_c("_ts_ok"), F.concat(F.lit("Invalid timestamp format: "),
                                               _text("timestamp"))),
        "_m_id": F.when(~F.coalesce(F.length(_c("_s_event_id")) > 0, F.lit(False)),
                        F.lit(BAD_EVENT_ID)),
        "_missing": F.array_compact(F.array(*[F.when(~_c(f"_present_{f}"), F.lit(MISSING + f))
                                              for f in REQUIRED_FIELDS])),
    })
    # array_compact (no lambda) keeps the plan canonical, so a shuffle over
    # validated rows can be reused by a subquery of the same query.
    rules = F.array_compact(F.array("_m_type", "_m_platform", "_m_cost", "_m_ts", "_m_id"))
    errors = (F.when(~_c("_is_object"), F.array(F.lit(NOT_OBJECT)))
               .when(F.size("_missing") > 0, _c("_missing"))
               .otherwise(rules))
    df = df.withColumn("_errors", errors)
    typed = F.struct(*[(_c(f"_s_{f}") if f in _CHECKED
                        else F.try_variant_get(_c(f"_v_{f}"), "$", "string")).alias(f)
                       for f in REQUIRED_FIELDS if f != "cost_usd"],
                     _c("_num").alias("cost_usd"))
    verdict = F.struct(_c("_errors").alias("errors"), (F.size("_errors") == 0).alias("is_valid"),
                       typed.alias("event"))
    # The verdict leaves through a one-element generator. A later filter on
    # it (is_valid, a non-empty explode) then stays above the generator; a
    # plain projection would let the optimizer inline the whole parse chain
    # into the pushed-down filter and evaluate it twice per line.
    return df.select(*lines.columns, F.inline(F.array(verdict)))


def error_rule(msg: Column) -> Column:
    """Rule name of an error message."""
    return (F.when(msg == NOT_OBJECT, F.lit("not_object"))
             .when(msg.startswith(MISSING), F.lit("missing_field"))
             .when(msg.startswith("Invalid event_type"), F.lit("event_type"))
             .when(msg.startswith("Invalid platform"), F.lit("platform"))
             .when(msg.startswith("Invalid cost_usd"), F.lit("cost_invalid"))
             .when(msg.startswith("Cost must be"), F.lit("cost_negative"))
             .when(msg.startswith("Invalid timestamp"), F.lit("timestamp"))
             .when(msg == BAD_EVENT_ID, F.lit("event_id"))
             .otherwise(F.lit("other")))


def batch_verdict(validated: DataFrame) -> DataFrame:
    """valid_count, invalid_count over the whole batch (one aggregate)."""
    return validated.agg(F.count_if(F.col("is_valid")).alias("valid_count"),
                         F.count_if(~F.col("is_valid")).alias("invalid_count"))


def error_summaries(validated: DataFrame, key: str | list[str]) -> DataFrame:
    """``Event <key>: e1; e2`` for every invalid line (stays distributed).

    ``key`` names the column(s) that locate a line, e.g. ``["file_path",
    "line_id"]`` for landed files (joined with ``:``); a distributed read
    has no global line number.
    """
    keys = [key] if isinstance(key, str) else list(key)
    where = F.concat_ws(":", *[F.col(k).cast("string") for k in keys])
    return (validated.filter(~F.col("is_valid"))
                     .select(*keys, F.concat(F.lit("Event "), where, F.lit(": "),
                                             F.concat_ws("; ", "errors")).alias("summary")))


def first_errors(validated: DataFrame, key: str | list[str], n: int = 10) -> DataFrame:
    """The first ``n`` error summaries by key (top-k, each task keeps n)."""
    keys = [key] if isinstance(key, str) else list(key)
    return error_summaries(validated, keys).orderBy(*keys).limit(n)


def errors_by_rule(validated: DataFrame) -> DataFrame:
    return (validated.select(F.explode("errors").alias("msg"))
                     .groupBy(error_rule(F.col("msg")).alias("rule"))
                     .agg(F.count(F.lit(1)).alias("errors")))


def missing_fields(validated: DataFrame) -> DataFrame:
    return (validated.select(F.explode("errors").alias("msg"))
                     .filter(F.col("msg").startswith(MISSING))
                     .groupBy(F.substring_index("msg", ": ", -1).alias("field"))
                     .agg(F.count(F.lit(1)).alias("events")))


def event_distribution(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Count per event type; an absent key (or a non-object line) counts as
    ``unknown``, an explicit null as ``None``."""
    df = _parse(lines, line_col, ["event_type"])
    etype = (F.when(_c("_is_object") & _c("_present_event_type"), _text("event_type"))
              .otherwise(F.lit("unknown")))
    return df.groupBy(etype.alias("event_type")).agg(F.count(F.lit(1)).alias("events"))


def total_cost(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Sum of convertible costs (absent -> 0), accumulated exactly."""
    df = _with_cost_number(_parse(lines, line_col, ["cost_usd"]))
    return df.agg(exact_sum(F.when(_c("_num_ok"), _c("_num")).otherwise(F.lit(0.0))).alias("total_cost"))


def parsed_events(validated: DataFrame) -> DataFrame:
    """Typed fields of valid lines (carried out of ``validate_lines``)."""
    return validated.filter(_c("is_valid")).select("event.*")


def batch_summary(events: DataFrame) -> DataFrame:
    """Batch totals plus per-type, per-partner and per-platform counts,
    costs and shares.

    One grouping-sets aggregate gives the dimension rows; the batch totals are
    the sum of the platform rows, read as a scalar subquery whose shuffle is
    reused, so the lines are parsed once. It has one row even for an empty
    batch: the ``total`` row, with zero events and null shares. No dimension
    is gathered into a single task.
    """
    g = (events.groupingSets([["event_type"], ["partner"], ["platform"]],
                             "event_type", "partner", "platform")
               .agg(F.count(F.lit(1)).alias("events"), exact_sum("cost_usd").alias("_cost"),
                    F.grouping_id().alias("_gid")))
    # every group column is aggregated, so that the subquery's plan equals the main query's
    one = F.col("_gid") == 6
    totals = g.select(F.struct(
        F.coalesce(F.sum(F.when(one, F.col("events"))), F.lit(0)).cast("long").alias("n"),
        exact_sum(F.when(one, F.col("_cost"))).alias("c"),
        *[F.count(c).alias(f"k_{c}") for c in ("event_type", "partner", "platform")])).scalar()
    n, c = totals.getField("n"), totals.getField("c")

    def shares(events_col: Column, cost_col: Column) -> list[Column]:
        return [events_col.alias("events"), cost_col.alias("cost"),
                round_half_up(safe_divide(events_col * F.lit(100.0), n.cast("double")), 1)
                .alias("percentage"),
                n.alias("total_events"), c.alias("total_cost"),
                round_half_up(safe_divide(c, n), 2).alias("avg_cost")]
    dim = (F.when(F.col("_gid") == 3, F.lit("event_type"))
            .when(F.col("_gid") == 5, F.lit("partner")).otherwise(F.lit("platform")))
    value = F.coalesce(F.col("event_type"), F.col("partner"), F.col("platform"))
    rows = g.select(dim.alias("dimension"), value.alias("value"),
                    *shares(F.col("events"), F.col("_cost")))
    # One-row carrier for the scalar totals (no data of its own).
    total = events.sparkSession.range(1).select(
        F.lit("total").alias("dimension"), F.lit(None).cast("string").alias("value"),
        *shares(n, c))
    return rows.unionByName(total)
