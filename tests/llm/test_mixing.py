import random

import pytest
from llm_helpers import EDGES, prose
from pyspark.sql import functions as F

from adlens.llm.mixing import mix, mixed_words, sized, splitting_tree, targets


def shares(sizes):
    """Targets by resharing the excess until none is above twice its size; sizes in rank order."""
    weight = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    left, open_, out = 1.5 * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        total = sum(weight[i] for i in open_)
        over = [i for i in open_ if left * weight[i] / total >= 2 * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weight[i] / total
            break
        for i in over:
            out[i] = 2.0 * sizes[i]
        left -= sum(out[i] for i in over)
        open_ -= set(over)
    return out


def corpus(rng, n=300):
    names = ["b", "a", "é", "Z", "", None, "zz", "漢"]
    rows = [(i, prose(rng, rng.randrange(1, 40)), rng.choices(names, [30, 9, 4, 3, 2, 5, 1, 2])[0]) for i in range(n)]
    return rows + [(1000 + i, t, "edges") for i, t in enumerate(EDGES)] + [(2000, None, "empty"), (2001, " ", "empty")]


def test_targets_equal_repeated_resharing(spark, docs):
    rng = random.Random(8)
    for _ in range(3):
        rows = corpus(rng, rng.randrange(1, 200))
        got = targets(sized(docs(rows), 0, "doc_id", "text", "source")).collect()
        size = {}
        for _, t, s in rows:
            size[s] = size.get(s, 0) + len((t or "").split())
        order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
        want = dict(zip(order, shares([size[s] for s in order]), strict=True))
        assert {r.source: r.source_size for r in got} == size
        for r in got:
            assert r.target == pytest.approx(want[r.source], abs=1e-6)


def test_words_taken_come_near_the_targets(spark, docs):
    rows = corpus(random.Random(9))
    rows += rows[:3]
    out = mixed_words(docs(rows))
    got = out.collect()
    source = {i: s for i, _, s in rows}
    assert len(got) == len(rows)
    taken, target = {}, {}
    for r in got:
        s = source[r.doc_id]
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
        assert 0 <= r.taken <= 2 * r.size and len(r.shards) <= 2
    for s, t in target.items():
        assert abs(taken[s] - t) <= 6 or s == "edges"  # one text there holds nearly all words
    again = {r.doc_id: (r.taken, r.shards) for r in mixed_words(docs(rows[::-1])).collect()}
    assert again == {r.doc_id: (r.taken, r.shards) for r in got}


def test_mix_holds_the_planned_copies_shuffled_in_shards(spark, docs):
    rows = docs(corpus(random.Random(10)))
    plan = {r.doc_id: sorted(r.shards) for r in mixed_words(rows, shards=5).collect()}
    out = mix(rows, shards=5)
    assert out.columns == [*rows.columns, "shard"]
    held = {}
    for r in out.collect():
        held.setdefault(r.doc_id, []).append(r.shard)
    assert {i: sorted(s) for i, s in held.items()} == {i: s for i, s in plan.items() if s}
    sizes = out.groupBy("shard").count().collect()
    assert {r.shard for r in sizes} <= set(range(5))


def test_tree_splits_quotas_exactly(spark):
    quotas = [40, 0, 7, 1, 300, 13]
    df = spark.createDataFrame(list(enumerate(quotas)), "sid int, quota long")
    for shards in (1, 2, 5, 8):
        out = splitting_tree(df, shards, seed=3).collect()
        per = [sum(r.high - r.low for r in out if r.shard == k) for k in range(shards)]
        assert sum(per) == sum(quotas) and max(per) - min(per) <= shards.bit_length()
        for s, q in enumerate(quotas):
            ends = 0
            for r in sorted((r for r in out if r.sid == s), key=lambda r: r.shard):
                assert r.low == ends
                ends = r.high
            assert ends == q
    spread = [sum(r.high - r.low for r in splitting_tree(df, 2, seed=k).where("sid = 4 and shard = 0").collect()) for k in range(30)]
    assert 140 < sum(spread) / 30 < 160 and len(set(spread)) > 3


def test_empty_tables(spark, docs):
    assert mixed_words(docs([])).collect() == []
    assert mix(docs([])).collect() == []
    only = mixed_words(docs([(1, None, "s"), (2, "", None)])).collect()
    assert [(r.size, r.target, r.taken) for r in only] == [(0, 0.0, 0)] * 2


def test_one_source_with_a_third_of_all_rows(spark, docs):
    rows = [(i, "w " * (1 + i % 50), "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(900)]
    out = mixed_words(docs(rows)).join(docs(rows).select("doc_id", "source"), "doc_id")
    for r in out.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 5  # closers are whole documents


def test_small_documents_fill_the_room_that_a_long_one_leaves(spark, docs):
    rng = random.Random(4)
    rows = docs([(i, "w " * rng.randrange(20, 81), "a") for i in range(600)] + [(600, "w " * 20_000, "a")])
    for seed in range(3):  # the long text stands at the boundary in two orders of three
        out = mixed_words(rows, seed=seed).collect()
        assert abs(sum(r.taken for r in out) - out[0].target) <= 10
