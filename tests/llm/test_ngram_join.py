import itertools
import random

import numpy as np
import pytest
from llm_helpers import EDGES, prose, shingle_set

from adlens.llm import components
from adlens.llm import ngram_join as ngram
from adlens.llm.components import connected_components
from adlens.llm.ngram_join import ngram_join


def brute(rows):
    """(doc_id, text) -> [(n, component)] by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 75 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    out = []
    for i, s in enumerate(sets):
        ids = [rows[j][0] for j in range(len(rows)) if (find(j) == find(i) if s else j == i) and rows[j][0] is not None]
        out.append((rows[i][0], len(s), min(ids, default=None)))
    return sorted(out, key=repr)


def edited(rng, text, share):
    w = text.split(" ")
    for _ in range(max(1, int(len(w) * share))):
        w[rng.randrange(len(w))] = rng.choice("abcdefgh") * 3
    return " ".join(w)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_equals_all_pairs_with_edges_and_chains(spark, docs):
    rng = random.Random(5)
    texts = list(EDGES)
    for _ in range(12):
        base = prose(rng, rng.randrange(20, 200))
        texts += [base, base, base.upper()]
        chain = base
        for _ in range(4):  # neighbours are alike, ends need not be
            chain = edited(rng, chain, 0.015)
            texts.append(chain)
        texts += [edited(rng, base, 0.02), edited(rng, base, 0.05), base + " " + prose(rng, 15)]
    passage = prose(rng, 60)  # shared by many that are otherwise apart
    texts += [passage + " " + prose(rng, 60) for _ in range(30)]
    rows = list(enumerate(texts)) + [(None, texts[20]), (None, "only here and without an id at all"), (3, "one"), (3, "one")]
    rng.shuffle(rows)
    assert result(ngram_join(docs(rows))) == brute(rows)


def test_large_group_of_near_copies(spark, docs):
    rng = random.Random(9)
    base = prose(rng, 120)
    rows = [(i, edited(rng, base, 0.02)) for i in range(120)] + [(1000 + i, prose(rng, 90)) for i in range(20)]
    assert result(ngram_join(docs(rows))) == brute(rows)


def test_keep_marks_one_of_each_group(spark, docs):
    rows = [(4, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (9, ""), (8, None)]
    out = ngram_join(docs(rows)).collect()
    assert {r.doc_id for r in out if r.keep} == {2, 8, 9}
    assert {r.class_size for r in out if r.n_shingles} == {4}


def test_empty_table(spark, docs):
    assert ngram_join(docs([])).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    out = dict(connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(out[i] == 0 for i in range(41)) and all(out[100 + i] == 100 for i in range(30))


def brute_links(rows):
    """(doc_id, text) -> [(doc_id, n, number of other rows it links to)]"""
    sets = [shingle_set(t) for _, t in rows]
    return sorted(((i, len(s), sum(100 * len(s & t) >= 75 * len(s | t) for y, t in enumerate(sets) if y != x and s and t))
                   for x, ((i, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


@pytest.mark.parametrize("block", [1024, 7])
def test_every_link_is_counted(spark, docs, monkeypatch, block):
    monkeypatch.setattr(ngram, "BLOCK_CLASSES", block)
    rng = random.Random(17)
    base = prose(rng, 120)
    texts = list(EDGES) + [edited(rng, base, 0.01) for _ in range(60)] + [base] * 3
    for n in (30, 60, 64, 70, 128):
        chain = prose(rng, n)
        for _ in range(5):
            chain = edited(rng, chain, 0.01) + " " + prose(rng, 3)
            texts += [chain, chain]
    rows = [*enumerate(texts), (None, base), (2, base)]
    out = ngram_join(docs(rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.n_links) for r in out), key=repr) == brute_links(rows)
    assert sum(r.n_links for r in out) > 1000
    plain = ngram_join(docs(rows), count_links=False)
    assert "n_links" not in plain.columns and result(plain) == brute(rows)


@pytest.mark.parametrize("before", [1, 16])
def test_the_last_round_alone_finds_all(spark, docs, monkeypatch, before):
    monkeypatch.setattr(ngram, "STAR_ROUNDS", 0)
    monkeypatch.setattr(ngram, "BEFORE", before)
    rng = random.Random(23)
    base = prose(rng, 100)
    texts = list(EDGES) + [edited(rng, base, 0.03) for _ in range(40)]
    for _ in range(10):
        text = prose(rng, rng.randrange(8, 120))
        texts += [text, edited(rng, text, 0.02), text + " " + prose(rng, 9)]
    rows = list(enumerate(texts))
    assert result(ngram_join(docs(rows), count_links=False)) == brute(rows)


def test_pairs_meet_at_their_first_shingle(spark):
    members = [(t, c, t) for c in range(6) for t in range(c, 40)]  # class c has the shingles from c on
    m = ngram._with_before(spark.createDataFrame(members, "token long, cls long, pos int"))
    other = m.selectExpr("token", "cls as lcls", "before as lbefore")
    met = m.join(other, "token").where("cls < lcls and not arrays_overlap(before, lbefore)")
    assert sorted((r.cls, r.lcls, r.token) for r in met.collect()) == [(a, b, b) for a, b in itertools.combinations(range(6), 2)]
    assert m.where(f"size(before) > {ngram.BEFORE}").isEmpty()


def counted(monkeypatch, module, name):
    calls, real = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda *a, **k: calls.append(a) or real(*a, **k))
    return calls


@pytest.mark.parametrize("pairs,rounds", [(1 << 26, 1), (-1, ngram.STAR_ROUNDS)])
def test_star_rounds_end_once_few_pairs_are_left(spark, docs, monkeypatch, pairs, rounds):
    """Each star round makes components; the last round makes them once more."""
    monkeypatch.setattr(ngram, "LAST_PAIRS", pairs)
    calls = counted(monkeypatch, ngram, "connected_components")
    rng = random.Random(31)
    base, passage = prose(rng, 120), prose(rng, 40)
    texts = [edited(rng, base, 0.03) for _ in range(60)] + [passage + " " + prose(rng, 40) for _ in range(20)]
    rows = list(enumerate(texts))
    assert result(ngram_join(docs(rows), count_links=False)) == brute(rows)
    assert len(calls) == rounds + 1


def test_components_end_with_the_round_that_leaves_stars(spark, monkeypatch):
    made = counted(monkeypatch, components, "materialize")
    star = [(5, k) for k in range(6, 40)] + [(5, 6), (6, 5), (8, 8), (None, 5)]
    out = connected_components(spark.createDataFrame(star, "a long, b long")).collect()
    assert sorted(out) == [(k, 5) for k in range(5, 40)] and len(made) == 1


def test_components_of_random_links_equal_a_union_find(spark):
    rng = random.Random(37)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] * 2 + [(1000 + (i * 37) % 101, 1000 + ((i + 1) * 37) % 101) for i in range(100)]
    root = {x: x for link in links for x in link}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert sorted(connected_components(spark.createDataFrame(links, "a long, b long")).collect()) == sorted((x, find(x)) for x in linked)


def test_signs_keep_every_link_and_drop_most_others(spark):
    """The last round hands on no unlinked pairs of a group by the thousands."""
    rng = np.random.default_rng(41)
    base = rng.integers(1, 1 << 62, 120)
    sets = [np.sort(np.concatenate([base[: 120 - 2 * k], rng.integers(1, 1 << 62, 2 * k)])) for k in range(40)]
    rows = [(i, len(x), x.astype(np.uint64).tobytes()) for i, x in enumerate(sets)]
    df = spark.createDataFrame(rows, "cls long, n int, set binary")
    m = df.join(ngram._signs(df.select("cls", "set")), "cls")
    other = m.selectExpr("cls as lcls", "n as ln", "sign as lsign")
    got = {(r.cls, r.lcls) for r in m.crossJoin(other).where("cls < lcls").where(ngram._signs_may_link(75)).collect()}
    linked = {(i, j) for i, j in itertools.combinations(range(40), 2)
              if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))}
    assert linked <= got and len(got) < 1.6 * len(linked) < 40 * 39 / 4
