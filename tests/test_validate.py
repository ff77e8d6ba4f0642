import json

from pyspark.sql import functions as F

from adlens.operators import validate as V

VALID = {"event_id": "test-123", "timestamp": "2026-02-12T14:30:00Z", "event_type": "install",
         "partner": "Adjust", "cost_usd": 5.50, "app_id": "com.example.puzzle",
         "campaign_id": "spring_launch", "platform": "iOS", "country_code": "US"}


def _validate(spark, lines):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "line_id long, line string")
    return [r.asDict() for r in V.validate_lines(df).orderBy("line_id").collect()]


def _with(**kw):
    d = dict(VALID)
    for k, v in kw.items():
        if v is KeyError:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


def test_validator_unit_fixtures(spark):
    out = _validate(spark, [json.dumps(VALID), _with(event_type=KeyError),
                            _with(event_type="invalid_type"), _with(cost_usd=-5.50)])
    assert out[0]["is_valid"] and out[0]["errors"] == []
    assert not out[1]["is_valid"] and out[1]["errors"] == ["Missing required field: event_type"]
    assert any("event_type" in e for e in out[2]["errors"])
    assert out[2]["errors"][0] == ("Invalid event_type: invalid_type. Must be one of "
                                   "['install', 'reinstall', 'click', 'impression']")
    assert out[3]["errors"] == ["Cost must be non-negative: -5.5"]


def test_edges(spark):
    out = _validate(spark, [
        _with(event_id=None),            # 0 present but null
        _with(event_id=KeyError),        # 1 absent
        _with(event_id=1),               # 2 numeric id
        "{bad",                          # 3 malformed
        "[1]",                           # 4 not an object
        _with(cost_usd="2.5"),           # 5 numeric string
        _with(cost_usd="abc"),           # 6
        _with(platform="ios"),           # 7 case-sensitive
        _with(timestamp="2026-02-12 14:30:00"),   # 8 any separator is ISO
        _with(timestamp="2026-02-30T14:30:00Z"),  # 9 not a date
        _with(timestamp="2026-02-12T14:30:00.5Z"),  # 10 1-digit fraction
        _with(partner=KeyError, platform=KeyError),  # 11 two missing
        _with(timestamp=5),              # 12 not a string
    ])
    assert out[0]["errors"] == ["event_id must be a non-empty string"]
    assert out[1]["errors"] == ["Missing required field: event_id"]
    assert out[2]["errors"] == ["event_id must be a non-empty string"]
    assert out[3]["errors"] == ["Event is not a JSON object"] == out[4]["errors"]
    assert out[5]["is_valid"]
    assert out[6]["errors"] == ["Invalid cost_usd value: abc"]
    assert out[7]["errors"][0].startswith("Invalid platform: ios.")
    assert out[8]["is_valid"]
    assert out[9]["errors"] == ["Invalid timestamp format: 2026-02-30T14:30:00Z"]
    assert out[10]["errors"] == ["Invalid timestamp format: 2026-02-12T14:30:00.5Z"]
    assert out[11]["errors"] == ["Missing required field: partner", "Missing required field: platform"]
    assert out[12]["errors"] == ["Invalid timestamp format: 5"]


def test_distribution_total_and_empty_batch(spark):
    lines = [_with(event_type=t, cost_usd=c) for t, c in
             [("install", 5.50), ("install", 3.25), ("click", 1.00), ("impression", 0.0)]]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "line_id long, line string")
    dist = {r["event_type"]: r["events"] for r in V.event_distribution(df).collect()}
    assert dist == {"install": 2, "click": 1, "impression": 1}
    assert V.total_cost(df).collect()[0]["total_cost"] == 9.75
    empty = df.filter(F.lit(False))
    verdict = V.batch_verdict(V.validate_lines(empty)).collect()[0]
    assert (verdict["valid_count"], verdict["invalid_count"]) == (0, 0)
    summary = V.batch_summary(V.parsed_events(V.validate_lines(empty))).collect()
    assert [(r["dimension"], r["events"], r["percentage"]) for r in summary] == [("total", 0, None)]


def test_summary_shares(spark):
    lines = [_with(event_type=t) for t in ["install", "install", "click", "impression"]]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "line_id long, line string")
    s = {(r["dimension"], r["value"]): r["percentage"]
         for r in V.batch_summary(V.parsed_events(V.validate_lines(df))).collect()}
    assert s[("event_type", "install")] == 50.0 and s[("platform", "iOS")] == 100.0


def test_no_filter_pushed_through_parse(spark):
    df = spark.createDataFrame([(0, json.dumps(VALID))], "line_id long, line string")
    q = V.first_errors(V.validate_lines(df), "line_id")
    assert len(q._jdf.queryExecution().optimizedPlan().toString()) < 60000


def test_error_summaries_with_file_position(spark, tmp_dir):
    from adlens.sources.jsonl import read_lines
    with open(tmp_dir + "/a.jsonl", "w") as f:
        f.write(json.dumps(VALID) + "\n" + _with(platform="ios") + "\n")
    lines = read_lines(spark, tmp_dir + "/a.jsonl").withColumn(
        "line_id", F.get_json_object("line", "$.event_id"))
    out = V.first_errors(V.validate_lines(lines), ["file_path", "line_id"]).collect()
    assert len(out) == 1 and out[0]["summary"].startswith("Event file:")
    assert out[0]["summary"].endswith(":test-123: Invalid platform: ios. Must be one of ['iOS', 'Android']")
