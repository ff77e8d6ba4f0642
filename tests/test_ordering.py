"""Order as data: positions against a plain sort."""

import pytest
from pyspark.sql import functions as F

from adlens.operators import ordering as O
from helpers import plan_text

SCHEMA = "a int, b string, c double"


def plain(rows):
    """a from high to low with nulls last, then all columns from left to right, nulls first."""
    key = lambda r: (r[0] is None, -(r[0] or 0), *[(x is not None, x if x is not None else 0) for x in r])
    return [(*r, i) for i, r in enumerate(sorted(rows, key=key), 1)]


def placed(df):
    return sorted((tuple(r) for r in O.positions(df, F.col("a").desc()).collect()), key=lambda r: r[-1])


def test_positions_with_ties_nulls_and_repeats(spark):
    rows = [(i % 7 if i % 11 else None, f"w{i % 5}" if i % 3 else None, float(i % 4)) for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert placed(df) == plain(rows)


def test_many_equal_rows_take_places_that_follow(spark, monkeypatch):
    monkeypatch.setattr(O, "CHUNK", 16)
    rows = [(1, "x", 0.5)] * 100 + [(2, "x", 0.5)] * 16 + [(0, "y", 0.0)] * 17 + [(None, None, None)] * 33
    assert placed(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_empty_and_clashing_names(spark):
    assert O.positions(spark.createDataFrame([], SCHEMA), "a").collect() == []
    df = spark.createDataFrame([(2, 1), (1, 2)], "_n int, __at int")
    assert sorted(tuple(r) for r in O.positions(df, "_n").collect()) == [(1, 2, 1), (2, 1, 2)]
    with pytest.raises(ValueError):
        O.positions(df.withColumnRenamed("_n", "position"), "__at")


def test_no_window(spark):
    df = spark.createDataFrame([(i, "x", 1.0) for i in range(50)], SCHEMA)
    assert "Window" not in plan_text(O.positions(df, "a"), "extended")
