"""One row per key after any sequence of sendings; nothing is lost on the way."""
import json
import os

import pytest
from helpers import event, raw_df
from pyspark.sql import functions as F

from adlens import session as S
from adlens.operators.incremental import keyless, upsert
from adlens.operators.metrics import grain_metrics
from adlens.plans.increment import load_increment
from adlens.plans.pipeline import build
from adlens.operators.staging import stage_events
from adlens.sources import jsonl as J
from adlens.streaming.ingest import ingest, read_daily, staged_schema


def test_repeated_and_null_keys(spark):
    schema = "event_id string, at int, v string"
    target = spark.createDataFrame([("a", 1, "old"), ("b", 1, "old"), (None, 1, "kept")], schema)
    new = spark.createDataFrame([("a", 2, "x"), ("a", 3, "y"), ("a", 3, "y"), ("c", 1, "n"), ("c", 1, "m"), (None, 9, "z")], schema)
    for _ in range(2):  # re-sending changes nothing
        target = upsert(target, new, "event_id", ["at"])
        assert sorted(target.collect(), key=repr) == sorted(
            [("a", 3, "y"), ("b", 1, "old"), ("c", 1, "n"), (None, 1, "kept")], key=repr)
    assert keyless(new).count() == 1


def land(folder, batch, rows):
    path = f"{folder}/batch={batch}"
    os.makedirs(path)
    for n, chunk in enumerate(rows):
        name = f"{path}/part-{n}.json"
        with open(name, "w") as f:
            f.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in chunk) + "\n")
        at = 1_700_000_000 + 10 * len(os.listdir(folder)) + n
        os.utime(name, (at, at))


FIRST = [[event(event_id="1"), event(event_id="2", cost_usd=1.0)], [event(event_id="3"), "{bad", event(event_id=None)]]
SECOND = [[event(event_id="1", timestamp="2026-02-13T08:00:00Z", cost_usd=9.0), event(event_id="2", cost_usd=2.0)],
          ['{"event_id":"7"} {"event_id":"8"}', event(event_id="4", cost_usd="12.31"), event(event_id="5", cost_usd="n/a")]]
THIRD = [[event(event_id="2", timestamp="2026-01-01T00:00:00Z", cost_usd=3.0)],
         [event(event_id="3", timestamp="2026-01-02T00:00:00Z")]]


@pytest.mark.parametrize("files", [None, 1])
@pytest.mark.parametrize("at_once", [True, False])
def test_any_micro_batches_give_one_table(spark, tmp_dir, files, at_once):
    landing, target, daily = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/daily"
    os.makedirs(landing)
    for n, rows in enumerate((FIRST, SECOND, THIRD)):
        land(landing, f"mmp_events_2026021{n}_000000", rows)
        if not at_once:
            ingest(spark, f"{landing}/batch=*", target, max_files_per_trigger=files, daily_path=daily)
    ingest(spark, f"{landing}/batch=*", target, max_files_per_trigger=files, daily_path=daily)
    ingest(spark, f"{landing}/batch=*", target, max_files_per_trigger=files, daily_path=daily)  # nothing new
    staged = spark.read.schema(staged_schema(spark)).parquet(target)
    got = sorted((r.event_id, str(r.event_date), r.cost_usd) for r in staged.collect())
    assert got == [("1", "2026-02-13", 9.0), ("2", "2026-01-01", 3.0), ("3", "2026-01-02", 5.5), ("4", "2026-02-12", 12.31)]
    want = grain_metrics(staged, "daily", load_stamp=False).collect()
    assert sorted(read_daily(spark, daily).collect()) == sorted(want)
    rejects = spark.read.parquet(f"{target}_rejects")
    found = sorted((r.reject_reason, r._corrupt_record or "") for r in rejects.collect())
    assert [f[0] for f in found] == ["malformed_record"] * 3 + ["null_event_id"]
    assert {f[1] for f in found} == {"{bad", SECOND[1][0], json.dumps(SECOND[1][2]), ""}
    scratch = os.path.join(S.checkpoint_root(spark).replace("file:", ""), "adlens-scratch")
    assert not [d for d in os.listdir(scratch) if d.startswith(("ingest-", "merge-"))]  # copies are deleted


def test_two_objects_on_a_line_fail_or_are_kept_apart(spark, tmp_dir):
    one = json.dumps(event())
    for text in (one + one, one + " " + one, one + "," + one, one + " x", "[1]", "{bad"):
        with open(f"{tmp_dir}/f.json", "w") as f:
            f.write(f"{one}\n\n{text}\n")
        with pytest.raises(Exception, match="Malformed event record"):
            J.read_events(spark, tmp_dir).collect()
        rows = J.read_events(spark, tmp_dir, mode="PERMISSIVE").collect()
        assert sorted(r._corrupt_record or "" for r in rows) == sorted(["", text])
    with open(f"{tmp_dir}/f.json", "w") as f:
        f.write(json.dumps(event(app_id="a } b {", cost_usd="1.5")) + "\n")
    assert J.read_events(spark, tmp_dir).first().app_id == "a } b {"


def test_build_replaces_and_keeps_rejects(spark, tmp_dir):
    rows = [event(event_id=str(i), timestamp=f"2026-02-1{i}T00:00:00Z") for i in range(5)]
    bad = [event(event_id="x", cost_usd=-1.0), event(event_id="y", timestamp="2026-13-01T00:00:00Z")]
    build(spark, raw_df(spark, rows + bad), tmp_dir + "/a", mode="quarantine")
    again = build(spark, raw_df(spark, rows[:3] + bad), tmp_dir + "/a", mode="quarantine")
    fresh = build(spark, raw_df(spark, rows[:3] + bad), tmp_dir + "/b", mode="quarantine", load_stamp=False)
    for name in ("stg_mmp_events", "int_daily_metrics", "mart_installs_reinstalls"):
        a, b = (sorted(map(str, spark.read.parquet(r.tables[name]).drop("dbt_updated_at").collect())) for r in (again, fresh))
        assert a == b
    kept = {r.event_id: r.reject_reason for r in spark.read.parquet(again.tables["stg_rejects"]).collect()}
    assert kept == {"x": "invalid_cost", "y": "invalid_timestamp_format"}


def test_build_enters_tables_with_comments(spark, tmp_dir):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS built LOCATION '{tmp_dir}/db'")
    for _ in range(2):
        build(spark, raw_df(spark, [event()]), tmp_dir + "/w", database="built", run_tests=False)
    for name, word in (("stg_mmp_events", "Cleaned and typed"), ("mart_cost_per_install", "blended CPI (total cost")):
        about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED built.{name}").collect()}
        assert word in about["Comment"] and spark.table(f"built.{name}").count() > 0
    comments = {c.name: c.description for c in spark.catalog.listColumns("built.mart_cost_per_install")}
    assert comments["platform"] == "Mobile platform (iOS or Android)" and comments["cpi_direct"]
    spark.sql("DROP DATABASE built CASCADE")


def test_build_of_nothing(spark, tmp_dir):
    res = build(spark, raw_df(spark, []), tmp_dir, load_stamp=False)
    assert spark.read.parquet(res.tables["mart_cost_per_install"]).count() == 0


def test_batch_increments(spark, tmp_dir):
    def rows(*days):
        return stage_events(raw_df(spark, [event(event_id=f"e{d}", timestamp=f"2026-02-{d:02d}T00:00:00Z") for d in days]))
    target = tmp_dir + "/t"
    load_increment(spark, rows(1, 2), target)
    load_increment(spark, rows(1, 2, 2, 3, 4), target)
    load_increment(spark, rows(2, 5), target)
    back = spark.read.schema(staged_schema(spark)).parquet(target)
    assert sorted(r.event_id for r in back.collect()) == ["e1", "e2", "e3", "e4", "e5"]
    plan = back.filter(F.col("event_date") > "2026-02-03")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_store_faults_are_raised_and_names_have_folders(spark, tmp_dir):
    os.makedirs(tmp_dir + "/a/b")
    with open(tmp_dir + "/a/b/f.json", "w") as f:
        f.write("{}")
    assert S.path_exists(spark, tmp_dir + "/a") and not S.path_exists(spark, tmp_dir + "/no")
    assert J.file_exists(spark, tmp_dir, "a/b/f.json") and not J.file_exists(spark, tmp_dir, "b/f.json")
    assert J.file_exists(spark, tmp_dir, "f.json")
    with pytest.raises(Exception, match="nosuchscheme"):
        S.path_exists(spark, "nosuchscheme://x/y")


def test_no_local_scratch_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return "spark://host:7077" if key == "spark.master" else default

    class Session:
        conf = Conf()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.checkpoint_root(Session())
