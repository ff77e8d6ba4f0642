"""The registered queries of the subpackage: oracles, names, brute force."""
import re

import duckdb
import pytest

import __spark_entry__ as E
from adlens.llm.oracle import ORACLE
from adlens.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_one_query_for_each_operator_and_the_pipeline():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    cur = con.execute(ORACLE[name])
    cols = sorted(d[0] for d in cur.description)
    at = [[d[0] for d in cur.description].index(c) for c in cols]
    want = sorted((tuple(r[i] for i in at) for r in cur.fetchall()), key=repr)
    out = QUERIES[name](spark, SMALL)
    assert sorted(out.columns) == cols
    assert sorted((tuple(r[c] for c in cols) for r in out.collect()), key=repr) == want


@pytest.mark.parametrize("name, rows", [("op2_best_fit_packing", None), ("op4_document_fingerprints", 200),
                                        ("op5_pii_pseudonyms", 200), ("op7_source_mixing", 200), ("op8_token_counts", 200),
                                        ("op10_quality_classifier", 200), ("op13_toxicity", 200)])
def test_query_covers_the_whole_table(spark, name, rows):
    out = QUERIES[name](spark, SMALL)
    ids = out.select("doc_id").distinct().count()
    assert ids == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert rows is None or out.count() == rows
