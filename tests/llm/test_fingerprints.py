import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import EDGES, prose, shingle_set

from adlens.llm import fingerprints as fp
from adlens.llm.words import shingles


def one(text, size=fp.SKETCH):
    return fp.sketch(next(iter(shingles(pa.array([text], pa.string())))), size)


def test_shingles_match_words_of_the_text():
    rng = random.Random(4)
    texts = [*EDGES, *(prose(rng, rng.randrange(0, 50)) for _ in range(60)), "w " * 400_000, "y" * 5_000_000]
    for text, h in zip(texts, shingles(pa.array(texts, pa.string())), strict=True):
        assert len(h) == len(shingle_set(text)) and (h[1:] > h[:-1]).all()
    a, b = list(shingles(pa.array(["The  QUICK\tbrown\nfox jumps", "the quick brown fox jumps"])))
    assert (a == b).all()
    assert one("a" * 64 + "b" + "a" * 64).tolist() != one("a" * 128 + "b").tolist()


def test_estimates_and_merging():
    rng = random.Random(5)
    x, y = prose(rng, 3000), prose(rng, 3000)
    both = x + "\n" + y
    a, b, c = one(x), one(y), one(both)
    assert fp.decode(fp.encode(a)).tolist() == a.tolist()
    assert abs(fp.distinct(c) / len(shingle_set(both)) - 1) < 0.3
    parts = fp.merge(a, b)  # all but the shingles that span the two parts
    assert len(np.intersect1d(parts, c)) >= len(c) - 4
    assert abs(fp.resemblance(a, c) - 0.5) < 0.15 and fp.containment(a, c) > 0.8 and abs(fp.containment(c, a) - 0.5) < 0.2
    few = one("only seven words are in this text")
    assert fp.distinct(few) == 3 and fp.resemblance(few, few) == 1 and fp.resemblance(few, one("")) == 0
    assert fp.resemblance(one(""), one(None)) == 1 and fp.containment(one(""), few) == 1


def test_plain_fingerprints(spark, docs):
    rows = dict(enumerate(EDGES))
    for r in fp.fingerprints(docs(list(rows.items()))).collect():
        assert r.fingerprint == fp.encode(one(rows[r.doc_id]))


@pytest.mark.parametrize("partitions", [1, 7])
def test_edits_follow_descending_ids(spark, docs, partitions):
    rng = random.Random(6)
    rows = list(enumerate(EDGES)) + [(100 + i, prose(rng, rng.randrange(0, 60))) for i in range(60)] + [(-5, "minus five")]
    rng.shuffle(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.doc_id: r for r in fp.edited_fingerprints(docs(rows)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    assert len(got) == len(rows)
    for (i, t), (_, u) in zip(order, order[1:] + order[:1], strict=True):
        t, u = t or "", u or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + u[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (fp.encode(one(t)), fp.encode(one(edited)))
        for near, other in ((r.near_edited, edited), (r.near_next, u)):
            a, b = shingle_set(t), shingle_set(other)
            assert abs(near - (len(a & b) / len(a | b) if a | b else 1)) < 0.2


def test_ties_nulls_and_tiny_tables(spark, docs):
    assert fp.edited_fingerprints(docs([])).collect() == []
    own = fp.edited_fingerprints(docs([(1, "a b c d")])).collect()
    assert [(r.doc_id, r.near_next) for r in own] == [(1, 1.0)]
    assert own[0].edited_sha256 == hashlib.sha256(b"a b a b ").hexdigest()[:64] or own[0].n_chars == 7
    rows = [(7, f"text number {i % 5} of a hot id") for i in range(200)] + [(None, "x"), (None, None), (9, "nine")]
    out = fp.edited_fingerprints(docs(rows)).collect()
    assert len(out) == len(rows) and sum(r.doc_id is None for r in out) == 2
