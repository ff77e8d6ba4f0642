import math
import random

import pytest
from pyspark.sql import functions as F

from adlens.llm.knn import top_k

SCHEMA = "vec_id long, embedding array<double>, label int, row string, cell int, q string, score double"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "r", 1, "q", 0.5) for i, v in rows], SCHEMA)


def cut(score):
    return max(-2 ** 63, min(2 ** 63 - 1, score))


def brute(rows, k, every):
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    scaled = [(i, [math.floor(1024 * x) for x in v]) for i, v in ok]
    out = []
    for i, v in scaled:
        if i % every == 0:
            best = sorted((-cut(sum(a * b for a, b in zip(v, w))), j) for j, w in scaled if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out)


def result(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()))


@pytest.mark.parametrize("n, dim, k, every", [(700, 8, 10, 5), (60, 3, 10, 2), (5, 4, 10, 1), (400, 16, 1, 20)])
def test_equals_all_pairs(spark, n, dim, k, every):
    rng = random.Random(n)
    centres = [[rng.uniform(-1, 1) for _ in range(dim)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.1) for c in rng.choice(centres)]) for i in range(n)]
    rows += [(n + i, [0.25] * dim) for i in range(40)]  # one very common vector: ties
    rows += [(10_000, None), (10_020, [None] * dim), (10_040, [math.nan] * dim), (10_060, [math.inf] + [0.0] * (dim - 1)), (None, [0.1] * dim)]
    assert result(top_k(table(spark, rows), F.col("vec_id") % every == 0, k)) == brute(rows, k, every)


def test_repeats_ragged_and_large_values(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1e9, 1e9) for _ in range(4)]) for i in range(60)] + [(0, [1.0]), (70, []), (71, [2.0, -1.0])]
    rows += rows[:5]
    got = result(top_k(table(spark, rows), F.col("vec_id") % 10 == 0, 3))
    want = brute(rows, 3, 10)
    assert [x for x in got if x[0]] == [x for x in want if x[0]]


def test_parts_of_queries_and_chunks_of_rows(spark, monkeypatch):
    from adlens.llm import knn
    monkeypatch.setattr(knn, "QUERIES", 7)
    monkeypatch.setattr(knn, "ROWS", 50)
    monkeypatch.setattr(knn, "PER_CELL", 10)
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)] if i % 3 else [0.5] * 6) for i in range(300)]
    assert result(top_k(table(spark, rows), F.col("vec_id") % 4 == 0, 10)) == brute(rows, 10, 4)


def test_empty_tables(spark):
    assert top_k(table(spark, []), F.col("vec_id") % 100 == 0).collect() == []
    assert top_k(table(spark, [(1, [0.5])]), F.col("vec_id") % 100 == 0).collect() == []
    assert top_k(table(spark, [(100, [0.5])]), F.col("vec_id") % 100 == 0).collect() == []
