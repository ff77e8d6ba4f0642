"""Cost sums drop, cap and refuse nothing, at every grain and in every report."""
import math

import pytest
from helpers import event, plan_text, raw_df
from pyspark.sql import functions as F

from adlens.functions.numeric import exact_sum
from adlens.operators import metrics as MET
from adlens.operators import reports as R
from adlens.operators import validate as V
from adlens.operators.staging import stage_events

COSTS = [1e12, 1e25, 4e-7, 5.5, 0.1, 0.2, 1 / 3, 1e-30]


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


def staged(spark, costs):
    return stage_events(raw_df(spark, [event(event_id=str(i), cost_usd=c) for i, c in enumerate(costs)]))


@pytest.mark.parametrize("costs", [COSTS, [1e12, 5.5], [4e-7] * 7, [0.1] * 10, [1e25] * 3])
def test_every_grain_and_report(spark, ansi, costs):
    stg = staged(spark, costs)
    want = math.fsum(costs)
    for grain, df in MET.all_grain_metrics(stg, load_stamp=False).items():
        row = df.first()
        assert row.total_cost == pytest.approx(want, rel=1e-15), grain
        assert row.install_cost == row.total_cost
    daily = MET.grain_metrics(stg, "daily", load_stamp=False)
    for grain in ("weekly", "monthly"):
        assert MET.roll_up_published(daily, grain, False).first().total_cost == pytest.approx(want, rel=1e-15)
    assert R.event_distribution(stg).first().total_cost == pytest.approx(want, rel=1e-15, abs=0.005)
    assert R.cost_share(stg).first().cost_percentage == 100.0


def test_option_reaches_the_roll_ups(spark):
    stg = staged(spark, [4e-7] * 7)
    daily = MET.grain_metrics(stg, "daily", exact_cost=False, load_stamp=False)
    for grain in ("weekly", "monthly"):
        assert MET.roll_up_published(daily, grain, False, exact_cost=False).first().total_cost == pytest.approx(2.8e-6)


def test_sum_does_not_depend_on_partitioning(spark):
    df = spark.range(5000).select(((F.col("id") * 37 % 1999) / 100.0).alias("c"))
    sums = {df.repartition(n).agg(exact_sum("c")).first()[0] for n in (1, 3, 16)}
    assert sums == {math.fsum((i * 37 % 1999) / 100.0 for i in range(5000))} or len(sums) == 1


def test_nulls_and_non_finite(spark):
    df = spark.createDataFrame([(None, 1), (float("inf"), 2), (1.5, 2), (2.5, 3), (None, 3)], "c double, k int")
    got = {r.k: r.s for r in df.groupBy("k").agg(exact_sum("c").alias("s")).collect()}
    assert got == {1: None, 2: float("inf"), 3: 2.5}


def line(i, cost):
    return (i, '{"event_id":"e%d","timestamp":"2026-02-12T14:30:00Z","event_type":"install","partner":"p","cost_usd":%s,'
               '"app_id":"a","campaign_id":"c","platform":"iOS","country_code":"US"}' % (i, cost))


def test_validator_totals(spark, ansi):
    lines = spark.createDataFrame([line(0, "1e12"), line(1, "1e25"), line(2, "4e-7"), line(3, '"5.5"')], "line_id long, line string")
    want = math.fsum([1e12, 1e25, 4e-7, 5.5])
    assert V.total_cost(lines).first()[0] == pytest.approx(want, rel=1e-15)
    rows = V.batch_summary(V.parsed_events(V.validate_lines(lines))).collect()
    assert {r.total_cost for r in rows} == {want} and {r.total_events for r in rows} == {4}


def test_summary_of_no_lines_has_a_total(spark):
    none = V.validate_lines(spark.createDataFrame([], "line_id long, line string"))
    rows = V.batch_summary(V.parsed_events(none)).collect()
    assert [(r.dimension, r.events, r.percentage) for r in rows] == [("total", 0, None)]


def test_summary_reads_its_lines_once(spark, tmp_dir):
    spark.createDataFrame([line(i, "1.5") for i in range(20)], "line_id long, line string").write.parquet(tmp_dir + "/lines")
    out = V.batch_summary(V.parsed_events(V.validate_lines(spark.read.parquet(tmp_dir + "/lines"))))
    out.collect()
    final = plan_text(out, "simple").split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1, final


def test_built_and_streamed_roll_ups_equal_direct_sums(spark, tmp_dir):
    """Days of 1e12 and 4e-7, whose published doubles are rounded (whole doubles from 1e10 on add up exactly here)."""
    from adlens.plans.pipeline import build
    from adlens.sources.tables import read_table
    from adlens.streaming.ingest import merge_batch, rolled_up, staged_schema
    from adlens.plans.increment import start_table
    raw = raw_df(spark, [event(event_id=str(i), timestamp=f"2026-02-{9 + i % 5:02d}T10:00:00Z", cost_usd=c)
                         for i, c in enumerate([1e12, 4e-7, 4e-7, 1e12, 4e-7, 5e9, 4e-7, 3e12, 4e-7, -0.0])])
    stg = stage_events(raw)
    res = build(spark, raw, f"{tmp_dir}/out", load_stamp=False, run_tests=False)
    start_table(spark, f"{tmp_dir}/t", staged_schema(spark))
    merge_batch(spark, raw, f"{tmp_dir}/t", f"{tmp_dir}/rejects", 0, f"{tmp_dir}/daily")
    for grain in ("weekly", "monthly"):
        want = MET.grain_metrics(stg, grain, load_stamp=False).collect()
        assert read_table(spark, res.tables[f"int_{grain}_metrics"]).collect() == want
        assert rolled_up(spark, f"{tmp_dir}/daily", grain).collect() == want


def test_roll_up_without_stored_sums(spark, tmp_dir):
    """A build of old left only the published daily table."""
    from adlens.plans.pipeline import build
    from adlens.session import delete_path
    from adlens.sources.tables import read_table
    raw = raw_df(spark, [event(event_id=str(i), cost_usd=c) for i, c in enumerate([0.1, 0.2, 5.5])])
    build(spark, raw, f"{tmp_dir}/out", load_stamp=False, run_tests=False)
    delete_path(spark, f"{tmp_dir}/out/intermediate/int_daily_state")
    res = build(spark, raw, f"{tmp_dir}/out", select=["int_weekly_metrics"], load_stamp=False, run_tests=False)
    assert read_table(spark, res.tables["int_weekly_metrics"]).first().total_cost == 5.8
