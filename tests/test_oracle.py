"""Every registered query against its DuckDB oracle on the smallest data."""
import math

import duckdb
import pytest
from helpers import SF_SMALL

import __spark_entry__ as E
from adlens.plans.oracle import ORACLE
from adlens.plans.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def test_every_query_has_an_oracle_or_is_listing():
    assert set(QUERIES) - set(ORACLE) <= {"src_file_inventory"}


def test_entry_works_without_the_training_text_operators(monkeypatch):
    import sys
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert set(E.queries()) == set(QUERIES) and set(E.oracle_sql()) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "ctr_percentage" in df.columns
    assert E.entry(spark).schema == df.schema  # stable schema across calls


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert srows == drows
