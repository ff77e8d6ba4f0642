import json
import os

import pytest
from helpers import SF_SMALL, event, raw_df
from pyspark.sql import functions as F

from adlens.constants import METRIC_DOCS, STAGED_DOCS
from adlens.operators import incremental as INC
from adlens.operators.staging import stage_events
from adlens.sources import jsonl as J
from adlens.sources import tables as TB
from adlens.sources.driver_events import raw_events


def test_jsonl_roundtrip_and_no_overwrite(spark, tmp_dir):
    raw = raw_events(spark, SF_SMALL)
    J.write_events(raw, tmp_dir + "/e", batch="b1")
    back = J.read_events(spark, tmp_dir + "/e/batch=b1")
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0
    with pytest.raises(Exception):
        J.write_events(raw, tmp_dir + "/e", batch="b1")


def test_failfast_and_permissive(spark, tmp_dir):
    p = tmp_dir + "/bad.jsonl"
    with open(p, "w") as f:
        f.write(json.dumps(event()) + "\n{bad\n")
    with pytest.raises(Exception):
        J.read_events(spark, p).collect()
    rows = J.read_events(spark, p, mode="PERMISSIVE").collect()
    assert sum(1 for r in rows if r[J.CORRUPT_COLUMN] is not None) == 1


def test_nan_token_refused(spark, tmp_dir):
    p = tmp_dir + "/nan.jsonl"
    with open(p, "w") as f:
        f.write(json.dumps(event()).replace("5.5", "NaN") + "\n")
    with pytest.raises(Exception):
        J.read_events(spark, p).collect()


def test_file_inventory(spark, tmp_dir):
    raw = raw_events(spark, SF_SMALL).repartition(3)
    J.write_events(raw, tmp_dir + "/inv", batch=J.batch_stamp())
    inv = J.file_inventory(spark, tmp_dir + "/inv").collect()
    assert sum(r["event_count"] for r in inv) == raw.count()
    assert all(r["size_bytes"] == os.path.getsize(r["path"].replace("file:", "")) for r in inv)
    name = inv[0]["file_name"]
    assert J.file_exists(spark, tmp_dir + "/inv", name)
    assert not J.file_exists(spark, tmp_dir + "/inv", "nope.json")


def test_batch_stamp_format():
    import datetime as dt
    assert J.batch_stamp(dt.datetime(2026, 2, 12, 14, 30, 5)) == "mmp_events_20260212_143005"


def test_table_docs_persist(spark, tmp_dir):
    stg = TB.with_docs(stage_events(raw_df(spark, [event()])), STAGED_DOCS)
    TB.write_table(stg, tmp_dir + "/t", docs=METRIC_DOCS)
    docs = TB.column_docs(TB.read_table(spark, tmp_dir + "/t"))
    assert docs["event_type"] == STAGED_DOCS["event_type"]


def test_incremental_rows(spark):
    src = stage_events(raw_df(spark, [event(event_id=str(i), timestamp=f"2026-02-1{i}T10:00:00Z")
                                      for i in range(1, 5)]))
    empty = src.filter(F.lit(False))
    assert INC.incremental_rows(empty, src).count() == 4  # first run takes everything
    target = src.filter(F.col("event_date") <= "2026-02-12")
    assert sorted(r["event_id"] for r in INC.incremental_rows(target, src).collect()) == ["3", "4"]
    assert INC.incremental_rows(target, src, lookback_days=1).count() == 3


def test_upsert_new_row_wins(spark):
    t = spark.createDataFrame([("a", 1), ("b", 1)], "event_id string, v int")
    n = spark.createDataFrame([("b", 2), ("c", 2)], "event_id string, v int")
    assert sorted(tuple(r) for r in INC.upsert(t, n).collect()) == [("a", 1), ("b", 2), ("c", 2)]


def test_partitioned_write_dynamic_overwrite(spark, tmp_dir):
    stg = stage_events(raw_events(spark, SF_SMALL))
    path = tmp_dir + "/by_date"
    INC.write_partitioned_by_date(stg, path)
    one_day = stg.filter(F.col("event_date") == "2024-01-05")
    INC.write_partitioned_by_date(one_day.limit(1), path)
    back = spark.read.parquet(path)
    assert back.filter(F.col("event_date") == "2024-01-05").count() == 1
    assert back.count() == stg.count() - one_day.count() + 1


def test_stream_ingest_exactly_once(spark, tmp_dir):
    from adlens.streaming.ingest import ingest
    raw = raw_events(spark, SF_SMALL)
    J.write_events(raw.filter(F.col("event_id").cast("int") < 500), tmp_dir + "/land", batch="b1")
    ingest(spark, tmp_dir + "/land/batch=*", tmp_dir + "/tgt", tmp_dir + "/ck", tmp_dir + "/rej")
    J.write_events(raw.filter(F.col("event_id").cast("int") >= 400), tmp_dir + "/land", batch="b2")
    ingest(spark, tmp_dir + "/land/batch=*", tmp_dir + "/tgt", tmp_dir + "/ck", tmp_dir + "/rej")
    ingest(spark, tmp_dir + "/land/batch=*", tmp_dir + "/tgt", tmp_dir + "/ck", tmp_dir + "/rej")
    tgt = spark.read.parquet(tmp_dir + "/tgt")
    assert tgt.count() == stage_events(raw).count() == tgt.select("event_id").distinct().count()


def test_permissive_read_quarantines_malformed(spark, tmp_dir):
    from adlens.operators.staging import rejected_events
    p = tmp_dir + "/mixed.jsonl"
    with open(p, "w") as f:
        f.write(json.dumps(event(event_id="a")) + "\n{bad\n" + json.dumps(event(event_id="b")) + "\n")
    raw = J.read_events(spark, p, mode="PERMISSIVE")
    assert stage_events(raw, "quarantine").count() == 2
    assert [r["reject_reason"] for r in rejected_events(raw).collect()] == ["malformed_record"]


def test_build_selection_and_docs(spark, tmp_dir):
    from adlens.plans import pipeline as P
    assert P.select_models(["daily_refresh"]) == P.LAYERS["marts"]
    assert P.select_models(["int_daily_metrics"]) == ["int_daily_metrics"]
    raw = raw_events(spark, SF_SMALL)
    with pytest.raises(P.BuildFailed):
        P.build(spark, raw, tmp_dir + "/b", select=["marts"], run_tests=False)
    res = P.build(spark, raw, tmp_dir + "/b", load_stamp=False)
    assert set(res.tables) >= {"stg_mmp_events", "int_daily_metrics", "mart_cost_per_install",
                               "test_report"}
    stg = TB.read_table(spark, res.tables["stg_mmp_events"])
    assert TB.column_docs(stg)["event_type"] == STAGED_DOCS["event_type"]
    assert res.report.count() == 30


def test_stream_ingest_bounded_micro_batches(spark, tmp_dir):
    from adlens.streaming.ingest import ingest
    raw = raw_events(spark, SF_SMALL).repartition(4)
    J.write_events(raw, tmp_dir + "/land", batch="b1")
    ingest(spark, tmp_dir + "/land/batch=*", tmp_dir + "/tgt", tmp_dir + "/ck",
           max_files_per_trigger=1)
    assert spark.read.parquet(tmp_dir + "/tgt").count() == stage_events(raw).count()
    assert len([p for p in os.listdir(tmp_dir + "/ck/commits") if p.isdigit()]) == 4


def test_catalog_table_with_relation_and_column_comments(spark):
    name = "adlens_test_docs"
    df = spark.createDataFrame([(1, 2.0)], "installs long, total_cost double")
    try:
        TB.save_table(spark, df, name, docs=METRIC_DOCS, table_comment="Daily metrics")
        rows = {r["col_name"]: (r["data_type"], r["comment"])
                for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        assert rows["installs"][1] == METRIC_DOCS["installs"]
        assert rows["Comment"][0] == "Daily metrics"
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_stream_merge_is_idempotent_on_retry(spark, tmp_dir):
    from adlens.streaming.ingest import merge_batch, read_daily, staged_schema
    raw = raw_events(spark, SF_SMALL)
    target, daily = tmp_dir + "/tgt", tmp_dir + "/daily"
    spark.createDataFrame([], staged_schema(spark)).write.partitionBy("event_date").parquet(target)
    merge_batch(spark, raw, target, tmp_dir + "/rej", 0, daily)
    first = sorted(tuple(r) for r in spark.read.parquet(target).collect())
    first_daily = sorted(tuple(r) for r in read_daily(spark, daily).collect())
    merge_batch(spark, raw, target, tmp_dir + "/rej", 0, daily)  # the same epoch, retried
    assert sorted(tuple(r) for r in spark.read.parquet(target).collect()) == first
    assert sorted(tuple(r) for r in read_daily(spark, daily).collect()) == first_daily
    assert spark.read.parquet(tmp_dir + "/rej").count() == raw.count() - len(first)


def test_presence_of_batches_from_one_listing(spark, tmp_dir):
    rows = [event(event_id=str(i)) for i in range(3)]
    J.write_events(raw_df(spark, rows), f"{tmp_dir}/l", batch="a")
    expected = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "batch string, path int")
    out = J.with_presence(spark, f"{tmp_dir}/l", expected)
    assert sorted(map(tuple, out.collect()), key=lambda r: r[1]) == [("a", 1, True), ("b", 2, False), (None, 3, False), ("a", 4, True)]
