import pytest
from helpers import event, plan_text, raw_df
from pyspark.sql import functions as F

from adlens.operators.staging import rejected_events, stage_events


def _rows(df):
    return [r.asDict() for r in df.orderBy("event_id").collect()]


def test_filters_read_raw_case(spark):
    raw = raw_df(spark, [event(event_id="a", event_type="Install"), event(event_id="b")])
    assert [r["event_id"] for r in _rows(stage_events(raw))] == ["b"]


def test_normalization(spark):
    raw = raw_df(spark, [event(partner="AppsFlyer", platform="iOS", country_code="us")])
    r = _rows(stage_events(raw))[0]
    assert (r["partner"], r["platform"], r["country_code"]) == ("appsflyer", "IOS", "US")


def test_null_handling(spark):
    raw = raw_df(spark, [event(event_id="ts", timestamp=None), event(event_id="ty", event_type=None),
                         event(event_id="co", cost_usd=None), event(event_id="pa", partner=None)])
    rows = _rows(stage_events(raw))
    assert [r["event_id"] for r in rows] == ["pa"] and rows[0]["partner"] is None


def test_non_finite_costs_dropped_and_reported(spark):
    raw = raw_df(spark, [event(event_id="n", cost_usd=float("nan")),
                         event(event_id="p", cost_usd=float("inf")),
                         event(event_id="m", cost_usd=float("-inf")),
                         event(event_id="ok", cost_usd=0.0)])
    assert [r["event_id"] for r in _rows(stage_events(raw))] == ["ok"]
    rej = {r["event_id"]: r["reject_reason"] for r in rejected_events(raw).collect()}
    assert rej == {"n": "invalid_cost", "p": "invalid_cost", "m": "invalid_cost"}


@pytest.mark.parametrize("ts", ["2026-02-12 14:30", "2026-02-12T14:30:00.5Z",
                                "2026-2-12T14:30:00Z", "2026-02-30T14:30:00Z"])
def test_bad_timestamp_strict_raises_quarantine_rejects(spark, ts):
    raw = raw_df(spark, [event(timestamp=ts)])
    with pytest.raises(Exception):
        stage_events(raw, "strict").collect()
    assert stage_events(raw, "quarantine").count() == 0
    assert [r["reject_reason"] for r in rejected_events(raw, "quarantine").collect()] == [
        "invalid_timestamp_format"]


def test_time_zone_independent(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        raw = raw_df(spark, [event(event_id="a", timestamp="2026-02-12T02:30:00Z"),
                             event(event_id="b", timestamp="2026-03-08T02:30:00Z")])
        got = [str(r["event_date"]) for r in _rows(stage_events(raw))]
        hours = [r["event_timestamp"].hour for r in _rows(stage_events(raw))]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == ["2026-02-12", "2026-03-08"] and hours == [2, 2]


@pytest.mark.parametrize("day,week", [("2026-01-01", 0), ("2026-01-04", 1), ("2025-12-31", 52),
                                      ("2023-01-01", 1), ("2028-12-31", 53)])
def test_sunday_week_number(spark, day, week):
    r = _rows(stage_events(raw_df(spark, [event(timestamp=f"{day}T10:00:00Z")])))[0]
    assert r["week"] == week


def test_day_of_week_and_parts(spark):
    raw = raw_df(spark, [event(event_id="a", timestamp="2026-01-04T10:00:00Z"),
                         event(event_id="b", timestamp="2026-01-03T10:00:00Z")])
    rows = _rows(stage_events(raw))
    assert [r["day_of_week"] for r in rows] == [1, 7]
    assert (rows[0]["year"], rows[0]["month"]) == (2026, 1)
    types = dict(stage_events(raw).dtypes)
    assert types["year"] == types["week"] == types["day_of_week"] == "bigint"
    assert types["event_timestamp"] == "timestamp_ntz" and types["event_date"] == "date"


def test_accepted_plus_rejected_is_raw(spark):
    from adlens.sources.driver_events import raw_events
    raw = raw_events(spark, "/root/testdata/sf0.001")
    assert stage_events(raw).count() + rejected_events(raw).count() == raw.count()


def test_filter_pushed_to_scan(spark, tmp_dir):
    from adlens.constants import RAW_SCHEMA
    spark.createDataFrame([tuple(event().values())], RAW_SCHEMA).write.parquet(tmp_dir + "/r")
    staged = stage_events(spark.read.parquet(tmp_dir + "/r")).select("event_date")
    plan = plan_text(staged)
    pushed = plan.split("PushedFilters: ")[1].split("\n")[0]
    for f in ("IsNotNull(timestamp)", "In(event_type", "GreaterThanOrEqual(cost_usd,0.0)"):
        assert f in pushed
    assert "ReadSchema: struct<timestamp:string,event_type:string,cost_usd:double>" in plan
    assert "PythonUDF" not in plan and F is not None
