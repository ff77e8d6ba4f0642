from pyspark.sql import functions as F

from adlens.constants import COST_RANGES, EVENT_TYPES, PARTNERS, PLATFORMS
from adlens.operators import synth as G
from adlens.operators import validate as V


def test_batch_size_fields_and_ranges(spark):
    ev = G.synth_events(spark, 1000)
    rows = ev.collect()
    assert len(rows) == 1000
    for r in rows:
        assert r["event_type"] in EVENT_TYPES and r["partner"] in PARTNERS
        assert r["platform"] in PLATFORMS
        lo, hi = COST_RANGES[r["event_type"]]
        assert round(lo, 2) <= r["cost_usd"] <= round(hi, 2)


def test_generated_events_pass_validation(spark):
    lines = G.synth_events(spark, 200).select(F.monotonically_increasing_id().alias("line_id"),
                                              F.to_json(F.struct("*")).alias("line"))
    v = V.batch_verdict(V.validate_lines(lines)).collect()[0]
    assert (v["valid_count"], v["invalid_count"]) == (200, 0)


def test_distribution_within_tolerance(spark):
    chk = G.distribution_check(G.synth_events(spark, 1000))
    by = {(r["field"], r["value"]): r for r in chk.collect()}
    assert 0.55 <= by[("event_type", "impression")]["share"] <= 0.65
    assert 0.20 <= by[("event_type", "click")]["share"] <= 0.30
    assert all(r["within_tolerance"] for r in by.values())


def test_repeatable_and_partition_independent(spark):
    a = sorted(tuple(r) for r in G.synth_events(spark, 300, num_partitions=1).collect())
    b = sorted(tuple(r) for r in G.synth_events(spark, 300, num_partitions=7).collect())
    c = sorted(tuple(r) for r in G.synth_events(spark, 300, seed=7).collect())
    assert a == b and a != c


def test_landing_refuses_invalid_batch(spark, tmp_dir):
    import pytest
    from adlens.plans.landing import InvalidBatch, land_events, land_synthetic
    from adlens.sources.jsonl import read_events
    keys = spark.range(50)
    path = land_synthetic(spark, keys, "id", tmp_dir + "/land", batch="b1")
    assert read_events(spark, path).count() == 50
    bad = G.synth_from_keys(keys, "id").withColumn("platform", F.lit("ios"))
    with pytest.raises(InvalidBatch):
        land_events(bad, tmp_dir + "/land", "synth_key", batch="b2")
    import os
    assert not os.path.exists(tmp_dir + "/land/batch=b2")
