import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import EDGES, prose
from pyspark.sql import functions as F

from adlens.llm import variants as V


def counted(rows, cut=97, shortest=5, least=3):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % cut == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= shortest and k >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(words):
    near = {w: [v for v in words if v != w and abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in words}
    form = {}
    for w, k in words.items():
        best = min(near[w], key=lambda v: (-words[v], v.encode()), default=None)
        form[w] = best if best is not None and words[best] >= 2 * k else None
    out = []
    for w, k in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, k, len(near[w]), words.get(form[w])))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect())


def texts(seed, n=60):
    rng = random.Random(seed)
    bases = ["".join(rng.choices("abcdeéÀ×", k=rng.randrange(4, 9))) for _ in range(25)]

    def word():
        w = rng.choice(bases)
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2, 3])):
            k = rng.randrange(len(w))
            w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("abcé") + w[k:], w[:k] + rng.choice("abcÀ") + w[k + 1:]])
        return rng.choice([w, w.upper() if w.isascii() else w])

    return [(i, " ".join(word() for _ in range(rng.randrange(0, 80)))) for i in range(n)]


@pytest.mark.parametrize("seed,cut", [(1, 97), (2, 3), (3, 7)])
def test_equals_brute_force(spark, docs, seed, cut):
    rows = texts(seed) + [(500 + i, t) for i, t in enumerate(EDGES)] + [(None, "abcde " * 4), (3, "again abcde"), (3, "again abcde")]
    got = V.spelling_variants(docs(rows).repartition(3), cut=cut)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert rows_of(got) == expected(counted(rows, cut))


def test_passes_and_parts_change_nothing(spark, docs):
    """A budget so small that lengths are spread over passes and cut into parts."""
    rows = texts(4)
    want = expected(counted(rows, 5))
    for budget in (16, 64, 120):
        passes = V.shards(Counter(len(w[0]) for w in want), budget)
        assert len(passes) > 1 and all(8 * sum(s[3] for s in p) <= max(8, budget) for p in passes)
        assert rows_of(V.spelling_variants(docs(rows), cut=5, budget=budget)) == want


def test_full_filters_only_cost_work(spark, docs, monkeypatch):
    """False positives go in the exact join."""
    rows = texts(5, 30)
    monkeypatch.setattr(V, "PER_BLOCK", 10_000)
    assert rows_of(V.spelling_variants(docs(rows), cut=5)) == expected(counted(rows, 5))


def test_keys_of_edits_are_the_keys_of_the_edited_words():
    import pyarrow as pa
    rng = random.Random(6)
    letters = np.array(sorted(set(b"abc\xe9")), np.uint8)
    key = {}
    for _ in range(40):
        w = "".join(rng.choices("abcé", k=rng.randrange(1, 8)))
        key[w] = int(V._key(V._parts(np.frombuffer(w.encode("latin-1"), np.uint8)[None], 0).sum(1, dtype=np.uint64), len(w))[0])
    for w in key:
        (rows, m), = V._matrices(pa.array([w]))
        got = Counter((length, int(k)) for length, _, ks in V._edits(m, letters) for k in ks)
        cuts = {w[:i] + w[i + 1:] for i in range(len(w))} if len(w) > 1 else set()
        swaps = [w[:i] + c + w[i + 1:] for i in range(len(w)) for c in "abcé" if c > w[i]]
        want = Counter()
        for e in [*cuts, *swaps]:
            want[len(e), int(V._key(V._parts(np.frombuffer(e.encode("latin-1"), np.uint8)[None], 0).sum(1, dtype=np.uint64), len(e))[0])] += 1
        assert got == want, w


def test_filters_hold_every_word(spark):
    words = spark.createDataFrame([("w" + "".join(random.Random(i).choices("abcdef", k=4 + i % 5)) + "xyz"[i % 3], 3) for i in range(500)],
                                  "word string, n long").distinct()
    table = V.keyed(words).persist()
    for budget in (8, 256, 1 << 20):
        lengths = {r.len: r["count"] for r in table.groupBy("len").count().collect()}
        seen = 0
        for group in V.shards(lengths, budget):
            bits, places = V.bloom(table, group), V.Places(group)
            for r in table.collect():
                block, mask = places(np.array([r.key], np.int64).view(np.uint64), r.len)
                if block[0] >= 0:
                    seen += 1
                    assert bits[block[0]] & mask[0] == mask[0]
        assert seen == table.count()
    table.unpersist()


def test_very_long_words(spark, docs):
    a = "x" * 30_000
    rows = [(i, f"{a} {a[1:]} {a[:100]}y{a[101:]} short") for i in range(4)] + [(9, f"{a} {a} {a} {a} {a}")]
    assert rows_of(V.spelling_variants(docs(rows), cut=10 ** 9)) == expected(counted(rows, 10 ** 9))


def test_chains_are_followed_to_their_end(spark):
    steps = [(f"w{i:03d}", f"w{i + 1:03d}") for i in range(37)] + [("a", "w036"), ("b", "a")]
    got = {r.word: r.root for r in V.roots(spark.createDataFrame(steps, "word string, form string")).collect()}
    assert got == {w: "w037" for w, _ in steps}
    assert V.roots(spark.createDataFrame([], "word string, form string")).collect() == []


def test_empty_table_and_ties(spark, docs):
    assert V.spelling_variants(docs([])).collect() == []
    assert V.spelling_variants(docs([(1, None), (2, "")])).collect() == []
    rows = [(1, "aaaab " * 8 + "aaaac " * 8 + "aaaaa " * 4)]  # two forms of one count: the smaller
    got = {w: f for w, f, *_ in rows_of(V.spelling_variants(docs(rows), cut=10 ** 9))}
    assert got == {"aaaab": None, "aaaac": None, "aaaaa": "aaaab"}


def test_only_positives_are_shuffled(spark, docs):
    """Probes leave a task only where the filter takes them for a word."""
    rng = random.Random(8)
    rows = [(i, prose(rng, 60)) for i in range(80)]
    table = V.keyed(V.words_of(docs(rows))).persist()
    lengths = {r.len: r["count"] for r in table.groupBy("len").count().collect()}
    group, = V.shards(lengths)
    symbols = sorted({ord(c) for r in table.collect() for c in r.word})
    probes = sum(r.len * len(symbols) // 2 for r in table.collect())
    assert V.probe(table, group, symbols).count() < 0.1 * probes
    assert table.select(F.sum("n")).first()[0] == sum(counted(rows).values())
    table.unpersist()
