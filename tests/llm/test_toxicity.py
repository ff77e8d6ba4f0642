import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import EDGES, WORDS, prose
from pyspark.sql import functions as F

from adlens.llm import deobfuscate as D
from adlens.llm import toxicity as T

BAD = ["grumpo", "snarvel", "blortish", "frebnik", "quonder"]


def corpus(seed=21, n=700, obfuscate=0.0):
    rng, other = random.Random(seed), random.Random(seed + 1000)
    rows, labels = [], []
    for i in range(n):
        words, toxic = prose(rng, rng.randrange(3, 120)).split(), rng.random() < 0.2
        for _ in range(rng.randrange(2, 6) if toxic else 0):
            w = rng.choice(BAD)
            words.insert(rng.randrange(len(words) + 1), hide(other, w) if other.random() < obfuscate else w)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def hide(rng, w):
    kind = rng.randrange(4)
    if kind == 0:
        return "".join({"o": "0", "e": "3", "a": "4", "s": "$", "i": "1"}.get(c, c) for c in w)
    if kind == 1:
        k = rng.randrange(1, len(w) - 1)
        return w[:k] + w[k] * 5 + w[k + 1:]
    return rng.choice(".-_").join(w) if kind == 2 else " ".join(w)


def frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def accuracy(out, labels):
    want = {i: t for i, _, t in labels}
    unseen = [r for r in out if r.held_out and r.doc_id in want]
    caught = [r.predicted for r in unseen if want[r.doc_id]]
    clean = [r.predicted for r in unseen if not want[r.doc_id]]
    return sum(caught) / len(caught), 1 - sum(clean) / len(clean)


def test_held_out_accuracy_and_rows(spark, docs):
    rows, labels = corpus()
    rows += [(10_000 + i, t) for i, t in enumerate(EDGES)] + [(None, "no id"), (1, rows[1][1])]
    out = T.toxicity_scores(docs(rows), frame(spark, labels)).collect()
    assert len(out) == len(rows)
    caught, left_alone = accuracy(out, labels)
    assert caught > 0.95 and left_alone > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert len({r.score for r in out if r.doc_id in (10_000, 10_001)}) == 1  # null as empty
    assert len({r.score for r in out if r.doc_id == 1}) == 1


def test_obfuscated_words_are_caught_by_their_restored_text(spark, docs):
    """Only plain texts teach; the held-out ones are obfuscated."""
    plain, labels = corpus(22)
    hidden, _ = corpus(22, obfuscate=1.0)
    rows = [h if zlib.crc32(str(h[0]).encode()) % 4 == 2 else p for h, p in zip(hidden, plain, strict=True)]
    caught, left_alone = accuracy(T.toxicity_scores(docs(rows), frame(spark, labels)).collect(), labels)
    assert caught > 0.9 and left_alone > 0.97


def test_held_out_labels_change_nothing_and_reruns_agree(spark, docs):
    rows, labels = corpus(23, 240)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    a = T.toxicity_scores(docs(rows), frame(spark, labels))
    b = T.toxicity_scores(docs(rows[::-1]).repartition(5), frame(spark, turned[::-1]))
    a, b = (sorted((r.doc_id, r.score) for r in x.collect()) for x in (a, b))
    assert [i for i, _ in a] == [i for i, _ in b] and [s for _, s in a] == pytest.approx([s for _, s in b])


@pytest.mark.parametrize("labels,score", [([], 0.0), ([(1, 1, 0), (3, 1, 0)], 0.0), ([(1, 1, 1)], 0.5),
                                          ([(1, 1, None), (3, 0, 1), (3, 1, 0), (None, 0, 1), (777, 0, 1)], 0.0)])
def test_without_two_classes(spark, docs, labels, score):
    assert not any(zlib.crc32(str(i).encode()) % 4 == 2 for i in (1, 3))
    out = T.toxicity_scores(docs([(1, "a"), (3, None)]), frame(spark, labels)).collect()
    assert [r.score for r in out] == [score, score]


def test_empty_table_and_clashing_names(spark, docs):
    assert T.toxicity_scores(docs([]), frame(spark, [])).collect() == []
    rows, labels = corpus(24, 120)
    df = docs(rows).withColumn("_point", F.lit(1))
    model = T.fit(df, frame(spark, labels), D.char_model(df))
    out = T.with_toxicity(df, model)
    assert out.columns == [*df.columns, "score"] and out.count() == 120


def test_evidence_equals_counting_by_hand(spark, docs):
    """Document counts and leave-one-out odds against a plain count over the learning rows."""
    rows, labels = corpus(25, 200)
    df = docs(rows)
    chars = D.char_model(df)
    model = T.fit(df, frame(spark, labels), chars)
    decoder = D.Decoder(chars)
    learn = {}
    for (i, t), (_, _, y) in zip(rows, labels, strict=True):
        if zlib.crc32(str(i).encode()) % 4 != 2:
            learn[t, y] = decoder.words(t)
    assert (model.toxic, model.clean) == tuple(sum(y == k for _, y in learn) for k in (1, 0))
    counts = {f: (p, n) for f, p, n in zip(*(model.counts[c].to_pylist() for c in ("feature", "p", "n")), strict=True)}
    found = {f for words in learn.values() for w in words for f in T.features(w)}
    for f in found:
        p, n = (sum(any(f in T.features(w) for w in words) for (_, y), words in learn.items() if y == k) for k in (1, 0))
        odds = T.log_odds(p, n, model.toxic, model.clean)
        assert counts.get(f) == ((p, n) if p > 1 and odds >= T.LEAST else None), f
    e = T.Evidence(pa.table({"feature": ["abc", "abcd$"], "p": [3, 1], "n": [1, 0]}), 10, 90)
    assert e.of_learned("abcd", 1) == pytest.approx(max(T.log_odds(2, 1, 10, 90), T.log_odds(0, 0, 10, 90)))


# --- restoring -------------------------------------------------------------------

@pytest.fixture(scope="module")
def decoder(spark):
    rng = random.Random(26)
    text = " ".join(rng.choice(BAD + WORDS[:120]) for _ in range(6000))
    df = spark.createDataFrame([(text,), (None,), ("",)], "text string")
    return D.Decoder(D.char_model(df))


def test_counts_equal_counting_by_hand(spark):
    rng = random.Random(27)
    texts = [*EDGES, *(prose(rng, 50) for _ in range(20)), "Été ÀÉ 漢字x 1a2b", "a" * 9, "x" * (D.SLICE + 70) + " tail words"]
    got = {r.code: r.n for r in D.char_counts(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)).collect()}
    table, want = D._classes(), {}
    for t in texts:
        a = b = 0
        for ch in (t or "").lower() + " ":
            z = int(table[ord(ch)])
            if z or b:
                code = (a * D.CLASSES + b) * D.CLASSES + z
                want[code] = want.get(code, 0) + 1
            a, b = (b, z) if z else (0, 0)
    assert got == want


def test_viterbi_equals_trying_every_reading(decoder):
    rng, table = random.Random(28), D._classes()

    def cost(text):
        total, a, b = 0.0, 0, 0
        for ch in text + ("\0" if text and table[ord(text[-1])] else ""):
            z = int(table[ord(ch)])
            if z or b:
                total += decoder.cost[(a * D.CLASSES + b) * D.CLASSES + z]
            a, b = (b, z) if z else (0, 0)
        return total

    for _ in range(200):
        word = "".join(rng.choices("grumposnavel013$.*-", k=rng.randrange(1, 8)))
        lattice = decoder._lattice(word)
        best = min(cost("".join(s for s, _ in path)) + sum(c for _, c in path) for path in itertools.product(*lattice))
        got = decoder.decode(word)
        mine = min((cost(got) + sum(c for _, c in path) for path in itertools.product(*lattice)
                    if "".join(s for s, _ in path) == got), default=math.inf)
        assert mine == pytest.approx(best), word


@pytest.mark.parametrize("hidden,word", [("gr0mp0", None), ("sn4rv3l", "snarvel"), ("bl0rt1sh!", "blortish!"), ("f.r.e.b.n.i.k", "frebnik"),
                                         ("q u o n d e r", "quonder"), ("quoooonder", "quonder"), ("GRUMPO", "grumpo"),
                                         ("grumpo###", "grumpo###"), ("$narvel", "snarvel"), ("bl*rtish", "blortish"), ("", "")])
def test_restored_words(decoder, hidden, word):
    assert decoder.restored(hidden) == word or word is None
    assert decoder.restored(f"so {hidden}\n(end)") == f"so {word}\n(end)" or word is None


def test_words_are_those_of_the_restored_text(decoder):
    rng = random.Random(29)
    texts = [*EDGES, "1" * 100_000, "a." * 50_000, "a " * 50_000, "$" * 9, "é É ÀÀÀ 漢漢漢漢",
             *(" ".join(hide(rng, w) for w in prose(rng, 30).split() if len(w) > 2) for _ in range(30))]
    for t in texts:
        assert decoder.words(t) == set(D._WORD.findall(decoder.restored(t)))


def test_restored_column_keeps_rows_and_nulls(spark, docs):
    df = docs([(1, "quonder QUOOOONDER"), (2, None), (2, "")])
    out = T.restored_text(df, D.char_model(docs([(i, "quonder " * 30) for i in range(3)]))).collect()
    assert sorted((r.doc_id, r.restored) for r in out if r.restored is not None) == [(1, "quonder quonder"), (2, "")]
    assert len(out) == 3


def test_texts_are_counted_together(spark, monkeypatch):
    """One count over all texts of a task, up to SLICE characters, not one for each."""
    calls, real = [], D._trigrams
    monkeypatch.setattr(D, "_trigrams", lambda t: calls.append(t) or real(t))
    taken = {}
    df = spark.createDataFrame([("a",)], "text string")
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, schema: taken.setdefault("f", f) and df.selectExpr("0 code", "0L n"))
    D.char_counts(df)
    texts = [*EDGES, "ab cd", "ab", "Σ ΟΔΟΣ", "ΟΔΟΣ", "x" * (D.SLICE + 9), *(prose(random.Random(43), 20) for _ in range(50))]
    batches = [pa.record_batch([pa.array(texts[k::3], pa.string())], names=["text"]) for k in range(3)]
    out, = taken["f"](iter(batches))
    want = Counter(c for t in texts for c in real((t or "").lower()).tolist())
    assert dict(zip(*(out[c].to_pylist() for c in ("code", "n")), strict=True)) == want and len(calls) < 4


def test_known_words_are_looked_up_once(decoder, monkeypatch):
    """Neither the restoring nor the evidence looks at a known plain word again."""
    d, tried = D.Decoder(np.array(decoder.cost, np.float32).tobytes()), []
    monkeypatch.setattr(T, "features", lambda w, real=T.features: tried.append(w) or real(w))
    e = T.Evidence(pa.table({"feature": ["grumpo$"], "p": [9], "n": [1]}), 10, 90)
    text = "some gr.umpo and grumpo or quoooonder"
    first, again = ([sorted(d.words(text)), e.point(d.words(text))] for _ in range(2))
    assert first == again and first[1][0] > 0 and len(tried) == len(set(tried))
    assert {"some", "and", "or", "grumpo"} <= d.plain and "quoooonder" not in d.plain
    assert {"some", "and", "or"} <= e.silent and "grumpo" not in e.silent
