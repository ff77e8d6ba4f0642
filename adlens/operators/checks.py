"""Declarative data tests: each test is a query returning failing rows.

Generic tests (semantics of the usual schema-test package):

* ``unique``            - values of ``c`` seen more than once (nulls ignored)
* ``not_null``          - rows where ``c`` is null
* ``accepted_values``   - distinct non-null values of ``c`` outside the list
* ``expression_is_true`` - rows where (``where``) holds and ``expr`` is false
                          (a null expression passes)
* ``accepted_range``    - rows where (``where``) holds and ``c`` is outside
                          ``[lo, hi]`` (null passes)

``run_checks`` evaluates a whole suite as one Spark job: per table one
aggregate for all row-level and accepted-values tests, whose shuffle holds
one row per value and task, and for each ``unique`` test a pass of its own over
the key column, which moves eight bytes per distinct key; whole keys move only
where their hash came twice. Only counts reach the report; failing rows stay
distributed and are returned by the per-test functions.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.constants import GRAINS, STAGED_PLATFORMS, VALID_EVENT_TYPES
from adlens.session import materialize


@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    column: str | None = None
    values: tuple = ()
    expression: str | None = None
    where: str | None = None
    lo: float | None = None
    hi: float | None = None
    severity: str = "error"
    name: str = field(default="")

    @property
    def test_name(self) -> str:
        if self.name:
            return self.name
        return f"{self.kind}_{self.table}_{self.column}"


# Hashes seen twice that are broadcast (some 32 MB as a hash table); beyond
# them so many keys repeat that all are grouped.
SUSPECTS = 1_000_000


# --- failing-row queries ----------------------------------------------------
def unique(df: DataFrame, c: str, suspects: int = SUSPECTS) -> DataFrame:
    """Values of ``c`` seen more than once, with their number.

    The first pass counts 64-bit hashes and stores those seen twice; the
    second groups only the values with such a hash, exactly. It reads the
    column twice, so ``df`` is best a stored table.
    """
    keys = df.select(F.col(c).alias("unique_field")).filter(F.col("unique_field").isNotNull())
    h = F.xxhash64("unique_field")
    twice = materialize(keys.groupBy(h.alias("_h")).agg(F.count(F.lit(1)).alias("n"))
                        .filter("n > 1").select("_h"), "suspects")
    if twice.count() <= suspects:
        keys = keys.withColumn("_h", h).join(F.broadcast(twice), "_h", "left_semi")
    return (keys.groupBy("unique_field").agg(F.count(F.lit(1)).alias("n_records"))
                .filter(F.col("n_records") > 1))


def not_null(df: DataFrame, c: str) -> DataFrame:
    return df.filter(F.col(c).isNull())


def accepted_values(df: DataFrame, c: str, values) -> DataFrame:
    return (df.groupBy(F.col(c).alias("value_field"))
              .agg(F.count(F.lit(1)).alias("n_records"))
              .filter(~F.col("value_field").isin(*values)))


def _expr(e: str | Column) -> Column:
    return F.expr(e) if isinstance(e, str) else e


def expression_is_true(df: DataFrame, expression: str | Column,
                       where: str | Column | None = None) -> DataFrame:
    if where is not None:
        df = df.filter(_expr(where))
    return df.filter(~_expr(expression))


def accepted_range(df: DataFrame, c: str, lo=None, hi=None,
                   where: str | Column | None = None) -> DataFrame:
    return expression_is_true(df, _range_ok(c, lo, hi), where)


def _range_ok(c: str, lo, hi) -> Column:
    ok = F.lit(True)
    if lo is not None:
        ok = ok & (F.col(c) >= F.lit(lo))
    if hi is not None:
        ok = ok & (F.col(c) <= F.lit(hi))
    return ok


def failing_rows(check: Check, df: DataFrame) -> DataFrame:
    k = check.kind
    if k == "unique":
        return unique(df, check.column)
    if k == "not_null":
        return not_null(df, check.column)
    if k == "accepted_values":
        return accepted_values(df, check.column, check.values)
    if k == "expression_is_true":
        expr = check.expression
        if check.column:  # column form: "<column> <expression>"
            expr = f"{check.column} {expr}"
        return expression_is_true(df, expr, check.where)
    if k == "accepted_range":
        return accepted_range(df, check.column, check.lo, check.hi, check.where)
    raise ValueError(f"unknown check kind {k!r}")


# --- suite ------------------------------------------------------------------
def _row_failure(check: Check) -> Column:
    """Per-row failure predicate for row-level tests (null -> pass)."""
    if check.kind == "not_null":
        return F.col(check.column).isNull()
    if check.kind == "expression_is_true":
        expr = check.expression
        if check.column:
            expr = f"{check.column} {expr}"
        fail = ~_expr(expr)
    elif check.kind == "accepted_range":
        fail = ~_range_ok(check.column, check.lo, check.hi)
    else:
        raise ValueError(check.kind)
    if check.where:
        fail = _expr(check.where) & fail
    return F.coalesce(fail, F.lit(False))


def _meta(check: Check) -> list[Column]:
    return [F.lit(check.test_name).alias("test_name"), F.lit(check.table).alias("table_name"),
            F.lit(check.column).cast("string").alias("column_name"),
            F.lit(check.severity).alias("severity")]


def _unique_failures(df: DataFrame, check: Check) -> DataFrame:
    """How many values are seen more than once."""
    return (unique(df.select(check.column), check.column)
            .agg(F.count(F.lit(1)).alias("failures")).select(*_meta(check), "failures"))


def _table_failures(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Failure counts of the ``checks`` on one table other than ``unique``,
    from one scan.

    A set of grouping sets serves every test: one per column under an
    ``accepted_values`` test (few values, combined on the map side) and the
    empty set, whose single group carries one ``count_if`` per row-level test.
    A global aggregate over the groups then yields every count.
    """
    group_cols = sorted({c.column for c in checks if c.kind == "accepted_values"})
    row_level = [c for c in checks if c.kind != "accepted_values"]
    aggs = [F.count_if(_row_failure(c)).alias(f"_f{i}") for i, c in enumerate(row_level)]
    sets = [[c] for c in group_cols] + [[]]
    g = (df.groupingSets(sets, *group_cols) if group_cols else df.groupBy())
    g = g.agg(*(aggs or [F.count(F.lit(1)).alias("_n")]), *([F.grouping_id().alias("_gid")] if group_cols else []))
    full = (1 << len(group_cols)) - 1

    def in_set(col: str) -> Column:
        return F.col("_gid") == full - (1 << (len(group_cols) - 1 - group_cols.index(col)))
    counts = []
    for c in checks:
        if c.kind == "accepted_values":
            cond = in_set(c.column) & F.col(c.column).isNotNull() & ~F.col(c.column).isin(*c.values)
            counts.append(F.count_if(cond))
        else:
            f = F.col(f"_f{row_level.index(c)}")
            counts.append(F.sum(F.when(F.col("_gid") == full, f)) if group_cols else F.sum(f))
    totals = g.agg(*[F.coalesce(x, F.lit(0)).cast("long").alias(f"t{i}")
                     for i, x in enumerate(counts)])
    rows = F.explode(F.array(*[F.struct(*_meta(c), F.col(f"t{i}").alias("failures"))
                               for i, c in enumerate(checks)]))
    return totals.select(rows.alias("r")).select("r.*")


def run_checks(tables: Mapping[str, DataFrame], specs: list[Check]) -> DataFrame:
    """One row per test: test_name, table_name, column_name, severity,
    failures, status (PASS, WARN for a failing warn test, FAIL otherwise).
    Each table is scanned once for all of its tests but ``unique``."""
    by_table: dict[str, list[Check]] = {}
    for c in specs:
        by_table.setdefault(c.table, []).append(c)
    out = None
    for table, checks in by_table.items():
        apart = [c for c in checks if c.kind == "unique"]
        parts = [_unique_failures(tables[table], c) for c in apart]
        if len(apart) < len(checks):
            parts.append(_table_failures(tables[table], [c for c in checks if c.kind != "unique"]))
        for part in parts:
            out = part if out is None else out.unionByName(part)
    status = (F.when(F.col("failures") == 0, F.lit("PASS"))
               .when(F.col("severity") == "warn", F.lit("WARN")).otherwise(F.lit("FAIL")))
    return out.withColumn("failures", F.col("failures").cast("long")).withColumn("status", status)


# --- the declared suite (30 tests) -----------------------------------------
def _nn(table: str, *cols: str) -> list[Check]:
    return [Check("not_null", table, c) for c in cols]


_STG = "stg_mmp_events"
_MARTS = ("mart_installs_reinstalls", "mart_click_through_rate", "mart_cost_per_install")

DECLARED_CHECKS: list[Check] = [
    Check("unique", _STG, "event_id"),
    *_nn(_STG, "event_id", "event_timestamp", "event_date", "event_type"),
    Check("accepted_values", _STG, "event_type", tuple(VALID_EVENT_TYPES)),
    *_nn(_STG, "partner", "cost_usd"),
    Check("expression_is_true", _STG, "cost_usd", expression=">= 0", severity="warn"),
    *_nn(_STG, "app_id", "platform"),
    Check("accepted_values", _STG, "platform", tuple(STAGED_PLATFORMS)),
    *_nn(_STG, "country_code"),
]
for _m in _MARTS:
    DECLARED_CHECKS.append(Check("accepted_values", _m, "grain", tuple(GRAINS)))
    DECLARED_CHECKS.extend(_nn(_m, "period", "partner", "platform"))
DECLARED_CHECKS += [
    Check("expression_is_true", "mart_click_through_rate", expression="ctr >= 0 AND ctr <= 1",
          where="ctr IS NOT NULL", name="expression_is_true_mart_click_through_rate_ctr_in_0_1"),
    Check("expression_is_true", "mart_click_through_rate", expression="impressions >= clicks",
          name="expression_is_true_mart_click_through_rate_impressions_ge_clicks"),
    Check("accepted_range", "mart_click_through_rate", "ctr_percentage", lo=0, hi=100,
          where="ctr_percentage IS NOT NULL"),
    Check("expression_is_true", "mart_cost_per_install", expression="cpi_direct >= 0",
          where="cpi_direct IS NOT NULL",
          name="expression_is_true_mart_cost_per_install_cpi_direct_ge_0"),
    Check("expression_is_true", "mart_cost_per_install", expression="cpi_blended >= cpi_direct",
          where="cpi_blended IS NOT NULL AND cpi_direct IS NOT NULL",
          name="expression_is_true_mart_cost_per_install_cpi_blended_ge_direct"),
]


def check_by_name(name: str) -> Check:
    return next(c for c in DECLARED_CHECKS if c.test_name == name)
