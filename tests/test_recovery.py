"""Runs that end anywhere, late batches, key filters, replaced tables, manifests."""
import datetime as dt
import json
import os

import pytest
from helpers import event, plan_text, raw_df
from pyspark.sql import functions as F

from adlens.operators.metrics import grain_metrics
from adlens.operators.staging import stage_events
from adlens.plans import increment as I
from adlens.plans.landing import InvalidBatch, inventory, land_batches, land_events
from adlens.plans.loads import load_landed, loaded_batches
from adlens.session import children
from adlens.sources import keyfilter as K
from adlens.sources import tables as TB
from adlens.streaming import ingest as S


def day(d):
    return f"2026-02-{d:02d}T10:00:00Z"


def staged(spark, *rows):
    return stage_events(raw_df(spark, [event(event_id=i, timestamp=day(d), cost_usd=c) for i, d, c in rows]))


def stored_rows(spark, target):
    return sorted((r.event_id, r.event_date.day, r.cost_usd) for r in spark.read.schema(S.staged_schema(spark)).parquet(target).collect())


class Lost(Exception):
    pass


def lose(*args, **kw):
    raise Lost


def tables_in(folder):
    """What is there, the empty folder for replacements aside."""
    assert not os.path.exists(f"{folder}/_replacing") or os.listdir(f"{folder}/_replacing") == []
    return [n for n in os.listdir(folder) if n != "_replacing"]


@pytest.mark.parametrize("step", ["rows", "publish", "table", "filters", "metrics", "delete"])
def test_a_merge_lost_at_any_step_is_finished_or_repeated(spark, tmp_dir, monkeypatch, step):
    """Event a moves from the 12th to the 13th; whatever the lost run had done,
    the next one gives the table and the metrics of a full rebuild."""
    target, daily, schema = f"{tmp_dir}/t", f"{tmp_dir}/daily", S.staged_schema(spark)
    after = S.refresher(spark, target, daily)
    I.start_table(spark, target, schema)
    I.merge_staged(spark, staged(spark, ("a", 12, 1.0), ("b", 12, 2.0), ("c", 11, 3.0)), target, schema, ["event_timestamp"], after=after)
    new = staged(spark, ("a", 13, 9.0), ("c", 14, 4.0))

    def half_written(*args, **kw):
        I.drop_dates(spark, target, ["2026-02-12"])  # a date is already gone when the run ends
        raise Lost

    broken = {"rows": (I, "upsert"), "publish": (I, "rename_path"), "table": (I, "write_partitioned_by_date"),
              "filters": (I, "write_filters"), "metrics": (S, "refresh_daily"), "delete": (I, "delete_path")}[step]
    with monkeypatch.context() as m:
        if step == "delete":
            real = I.delete_path
            m.setattr(I, "delete_path", lambda s, p: lose() if "entry=" in p else real(s, p))
        else:
            m.setattr(*broken, half_written if step == "table" else lose)
        with pytest.raises(Lost):
            I.merge_staged(spark, new, target, schema, ["event_timestamp"], after=after)
    if step in ("table", "filters", "metrics", "delete"):  # published: recovery alone finishes it
        assert I.recover(spark, target, schema, after)
        assert stored_rows(spark, target) == [("a", 13, 9.0), ("b", 12, 2.0), ("c", 14, 4.0)]
    I.merge_staged(spark, new, target, schema, ["event_timestamp"], after=after)
    assert stored_rows(spark, target) == [("a", 13, 9.0), ("b", 12, 2.0), ("c", 14, 4.0)]
    full = grain_metrics(spark.read.schema(schema).parquet(target), "daily", load_stamp=False)
    assert sorted(S.read_daily(spark, daily).collect()) == sorted(full.collect())
    assert not [n for n in children(spark, f"{target}_journal") if n.startswith("entry=")]
    assert K.dates_of(spark, target) == K.dates_of(spark, f"{target}_keys/ranges") == ["2026-02-12", "2026-02-13", "2026-02-14"]


def land(folder, batch, rows):
    os.makedirs(f"{folder}/batch={batch}")
    with open(f"{folder}/batch={batch}/part-0.json", "w") as f:
        f.write("\n".join(map(json.dumps, rows)) + "\n")


def test_late_batches_of_old_dates_are_loaded_once(spark, tmp_dir):
    landing, target, daily = (f"{tmp_dir}/{n}" for n in ("in", "t", "daily"))
    assert load_landed(spark, landing, target) == []
    land(landing, "b2", [event(event_id="1", timestamp=day(20)), event(event_id="2", timestamp=day(21), cost_usd=1.0)])
    assert load_landed(spark, landing, target, daily) == ["b2"]
    land(landing, "b1", [event(event_id="3", timestamp=day(2), cost_usd=2.0), event(event_id=None, timestamp=day(3))])
    land(landing, "b3", [event(event_id="2", timestamp=day(4), cost_usd=7.0)])
    assert load_landed(spark, landing, target, daily) == ["b1", "b3"]
    assert load_landed(spark, landing, target, daily) == []
    assert stored_rows(spark, target) == [("1", 20, 5.5), ("2", 4, 7.0), ("3", 2, 2.0)]
    assert sorted(r.batch for r in loaded_batches(spark, target).collect()) == ["b1", "b2", "b3"]
    full = grain_metrics(spark.read.schema(S.staged_schema(spark)).parquet(target), "daily", load_stamp=False)
    assert sorted(S.read_daily(spark, daily).collect()) == sorted(full.collect())
    rejects = [r.reject_reason for r in spark.read.parquet(f"{target}_rejects").collect()]
    assert rejects == ["null_event_id"]


def test_a_run_lost_before_its_mark_changes_nothing_when_repeated(spark, tmp_dir, monkeypatch):
    from adlens.plans import loads
    landing, target = f"{tmp_dir}/in", f"{tmp_dir}/t"
    land(landing, "b1", [event(event_id="1", timestamp=day(2)), event(event_id=None)])
    with monkeypatch.context() as m:
        m.setattr(loads, "mark_loaded", lose)
        with pytest.raises(Lost):
            load_landed(spark, landing, target)
    before = stored_rows(spark, target)
    assert load_landed(spark, landing, target) == ["b1"]
    assert stored_rows(spark, target) == before == [("1", 2, 5.5)]
    assert spark.read.parquet(f"{target}_rejects").count() == 1


def test_batch_increment_keeps_rows_without_an_id(spark, tmp_dir):
    target = f"{tmp_dir}/t"
    for d in (1, 2):
        rows = staged(spark, (str(d), d, 1.0)).unionAll(staged(spark, (None, d, 2.0)))
        I.load_increment(spark, rows, target)
    assert [r[0] for r in stored_rows(spark, target)] == ["1", "2"]
    kept = spark.read.parquet(f"{target}_rejects").collect()
    assert sorted((r.event_date.day, r.reject_reason) for r in kept) == [(1, "null_event_id"), (2, "null_event_id")]


# --- key filters ------------------------------------------------------------------

def test_filters_miss_no_key_and_name_few_other_dates(spark, tmp_dir):
    n = 4000
    rows = spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("event_id"),
                                 F.date_add(F.lit(dt.date(2026, 1, 1)), (F.col("id") % 20).cast("int")).alias("event_date"))
    rows.write.partitionBy("event_date").parquet(f"{tmp_dir}/t")
    dates = [dt.date(2026, 1, 1) + dt.timedelta(i) for i in range(20)]
    K.write_filters(spark, rows, f"{tmp_dir}/t_keys", dates)
    for some in ([3], [0, 41, 82], []):
        keys = rows.sparkSession.createDataFrame([(i,) for i in some], "id long").select(F.sha2(F.col("id").cast("string"), 256).alias("event_id"))
        found = K.dates_that_may_hold(spark, keys, f"{tmp_dir}/t", f"{tmp_dir}/t_keys")
        assert found == sorted({str(dates[i % 20]) for i in some})
    strange = spark.range(10 ** 6, 10 ** 6 + 500).select(F.sha2(F.col("id").cast("string"), 256).alias("event_id"))
    assert len(K.dates_that_may_hold(spark, strange, f"{tmp_dir}/t", f"{tmp_dir}/t_keys")) <= 2
    every = K.dates_that_may_hold(spark, rows.select("event_id"), f"{tmp_dir}/t", f"{tmp_dir}/t_keys")
    assert every == [str(d) for d in dates]


def test_only_dates_that_may_hold_a_key_are_read(spark, tmp_dir):
    target, schema = f"{tmp_dir}/t", S.staged_schema(spark)
    I.start_table(spark, target, schema)
    I.merge_staged(spark, staged(spark, *[(f"k{d}", d, 1.0) for d in range(1, 11)]), target, schema, ["event_timestamp"])
    new, held = staged(spark, ("k3", 20, 5.0), ("fresh", 21, 1.0)), spark.read.schema(schema).parquet(target)
    plan = plan_text(I.earlier_dates(spark, new, held, target))
    read = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert any("2026-02-03" in line for line in read) and not any("2026-02-04" in line for line in read)
    assert "ReadSchema: struct<event_id:string>" in plan
    I.merge_staged(spark, new, target, schema, ["event_timestamp"])  # the moved key is found
    assert [r for r in stored_rows(spark, target) if r[0] in ("k3", "fresh")] == [("fresh", 21, 1.0), ("k3", 20, 5.0)]


def test_a_table_without_filters_is_searched_whole(spark, tmp_dir):
    target, schema = f"{tmp_dir}/t", S.staged_schema(spark)
    staged(spark, ("a", 1, 1.0), ("b", 2, 1.0)).write.partitionBy("event_date").parquet(target)
    I.merge_staged(spark, staged(spark, ("a", 5, 2.0)), target, schema, ["event_timestamp"])
    assert stored_rows(spark, target) == [("a", 5, 2.0), ("b", 2, 1.0)]


# --- replaced tables ----------------------------------------------------------------

def test_a_build_that_dies_while_writing_leaves_the_former_table(spark, tmp_dir):
    path = f"{tmp_dir}/layer/t"
    TB.write_table(spark.range(3), path)
    bad = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("dies"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="dies"):
        TB.write_table(bad, path)
    assert TB.read_table(spark, path).count() == 3 and tables_in(f"{tmp_dir}/layer") == ["t"]
    TB.write_table(TB.read_table(spark, path).union(spark.range(2)), path)  # may even read what it replaces
    assert TB.read_table(spark, path).count() == 5


def test_a_run_that_dies_between_the_renames_is_put_right(spark, tmp_dir):
    path = f"{tmp_dir}/layer/t"
    TB.write_table(spark.range(3), path)
    os.makedirs(f"{tmp_dir}/layer/_replacing/t/new")
    os.rename(path, f"{tmp_dir}/layer/_replacing/t/former")
    assert TB.read_table(spark, path).count() == 3
    TB.write_table(spark.range(2), path)
    assert TB.read_table(spark, path).count() == 2 and tables_in(f"{tmp_dir}/layer") == ["t"]


# --- manifests ------------------------------------------------------------------------

def test_manifests_tell_files_sizes_and_events(spark, tmp_dir):
    good = [event(event_id=str(i)) for i in range(25)]
    rows = raw_df(spark, good).withColumn("batch", F.when(F.col("event_id") < "2", "b1").otherwise("b2"))
    assert sorted(land_batches(rows, tmp_dir, max_records_per_file=10)) == ["b1", "b2"]
    path = land_events(raw_df(spark, good[:3]).coalesce(1), tmp_dir, "event_id", "b3")
    got = inventory(spark, tmp_dir).collect()
    disk = {(b, f): os.path.getsize(f"{tmp_dir}/batch={b}/{f}") for b in ("b1", "b2", "b3")
            for f in os.listdir(f"{tmp_dir}/batch={b}") if f.endswith(".json")}
    assert {(r.batch, r.file_name): r.size_bytes for r in got} == disk
    for r in got:
        with open(f"{tmp_dir}/batch={r.batch}/{r.file_name}") as f:
            assert r.event_count == len(f.readlines()) and r.invalid_count == 0
    assert path.endswith("batch=b3") and "text" not in plan_text(inventory(spark, tmp_dir)).lower().replace("context", "")


def test_invalid_or_repeated_batches_do_not_land(spark, tmp_dir):
    bad = raw_df(spark, [event(event_id="1"), event(event_id="2", platform="Web")]).withColumn("batch", F.lit("b1"))
    with pytest.raises(InvalidBatch):
        land_batches(bad, tmp_dir)
    assert inventory(spark, tmp_dir).collect() == []
    assert land_batches(bad, tmp_dir, on_invalid="keep") == ["b1"]
    assert [(r.event_count, r.invalid_count) for r in inventory(spark, tmp_dir).groupBy().sum("event_count", "invalid_count").toDF(
        "event_count", "invalid_count").collect()] == [(2, 1)]
    with pytest.raises(FileExistsError):
        land_batches(bad, tmp_dir, on_invalid="keep")
    assert children(spark, f"{tmp_dir}/_pending") == []
