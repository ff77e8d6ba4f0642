"""Toxicity scores of restored text.

1. A character trigram model is counted over the whole corpus and obfuscated
   words (symbols for letters, spacing, repetition) are restored by Viterbi
   decoding of their lattices (``deobfuscate``).
2. ``fit`` learns from labelled rows which words and which beginnings of words
   (``SHORTEST`` to ``LONGEST`` letters) occur in toxic texts more than their
   share: smoothed log-odds by document. A word's evidence is the strongest of
   its own.
3. A text's three strongest words and the logarithm of its number of distinct
   words enter a logistic curve, fitted to the same rows with each row's own
   part in the counts taken out.

Learning takes a bounded sample: at most ``SAMPLE`` labelled documents per
class in the order of a hash of doc_id, each with its whole text, and at most
``FEATURES`` words and beginnings, those in most toxic texts. The driver sees
these, the points of the curve and the character model (of fixed size), never
the corpus. Scores cover every whole text.

Defined results: a null text scores as an empty one; contradictory labels of
one doc_id, null labels and labels without a document teach nothing; equal
texts of one label teach once; repeated rows score alike; without a toxic
learning row every score is 0, without a clean one 0.5; a null doc_id is
scored and is not held out; extra columns are kept.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import fresh, materialize, text_hash
from adlens.llm.deobfuscate import Decoder, char_model

SAMPLE = 20_000      # labelled documents per class
FEATURES = 200_000   # words and beginnings of words
SHORTEST, LONGEST = 3, 8
SMOOTH = 3.0         # documents' worth of the overall share added to each count
LEAST = 0.0          # log-odds from which a word is evidence
FLUSH = 300_000      # counters a task holds before it ships them
TOP = 3


@dataclass(frozen=True)
class Model:
    chars: bytes                     # costs of the character model
    toxic: int                       # learning documents of each class
    clean: int
    counts: pa.Table                 # feature, p, n: documents it occurs in
    weights: tuple[float, ...]       # of the three strongest words, size, 1


def held_out(doc_id: str | Column) -> Column:
    """Rows never learned from: crc32 of the id's text leaves 2 modulo 4."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def features(word: str) -> list[str]:
    """The word itself (marked by an end) and its beginnings."""
    return [word + "$", *(word[:k] for k in range(SHORTEST, min(len(word), LONGEST) + 1))]


def log_odds(p: float, n: float, toxic: int, clean: int) -> float:
    share = toxic / (toxic + clean)
    return math.log((p + SMOOTH * share) / (n + SMOOTH * (1 - share))) - math.log(share / (1 - share))


_HELD: dict[str, tuple[str, object]] = {}  # per worker process: the latest of each kind


def _held(kind: str, key: str, make):
    if _HELD.get(kind, ("", None))[0] != key:
        _HELD[kind] = key, make()
    return _HELD[kind][1]


def _count_documents(rows: DataFrame, wanted=None) -> DataFrame:
    """(feature, n): documents of ``rows`` (words) in which each feature occurs;
    only those in the broadcast set ``wanted``, where given."""

    key = uuid.uuid4().hex

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        some = None if wanted is None else _held("wanted", key, lambda: set(wanted.value.to_pylist()))
        out = lambda: pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["feature", "n"])
        for batch in batches:
            for words in batch.column(0):
                found = {f for w in words.as_py() for f in features(w)}
                held.update(found if some is None else found & some)
                if len(held) >= FLUSH:
                    yield out()
                    held.clear()
        yield out()

    return (rows.select("words").mapInArrow(count, "feature string, n long")
            .groupBy("feature").agg(F.sum("n").alias("n")))


class Evidence:
    """What the words of a text say, from the counts of a model."""

    def __init__(self, counts: pa.Table, toxic: int, clean: int) -> None:
        self.toxic, self.clean = toxic, clean
        self.counts = {f: (p, n) for f, p, n in zip(*(counts[c].to_pylist() for c in ("feature", "p", "n")), strict=True)}
        self.odds = {f: x for f, (p, n) in self.counts.items() if (x := log_odds(p, n, toxic, clean)) >= LEAST}
        self.seen: dict[str, float] = {}
        self.silent: set[str] = set()  # words seen that are no evidence

    def of_word(self, word: str) -> float:
        x = self.seen.get(word)
        if x is None:
            x = max((self.odds[f] for f in features(word) if f in self.odds), default=0.0)
            if len(word) <= 64:
                if len(self.seen) + len(self.silent) >= FLUSH:
                    self.seen.clear()
                    self.silent.clear()
                if x:
                    self.seen[word] = x
                else:
                    self.silent.add(word)
        return x

    def of_learned(self, word: str, label: int) -> float:
        """As ``of_word``, without the text's own part in the counts."""
        best = 0.0
        for f in features(word):
            if f in self.counts:
                p, n = self.counts[f]
                x = log_odds(p - label, n - 1 + label, self.toxic, self.clean)
                best = max(best, x if x >= LEAST else 0.0)
        return best

    def point(self, words: set[str] | list[str], label: int | None = None) -> list[float]:
        found = map(self.of_word, words - self.silent) if label is None else (self.of_learned(w, label) for w in words)
        top = sorted(found, reverse=True)[:TOP]
        return [*top, *[0.0] * (TOP - len(top)), math.log1p(len(words))]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, ...]:
    """Maximum-likelihood weights with a weak ridge (Newton steps)."""
    mean, scale = x.mean(0), x.std(0) + 1e-12
    a = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w, pull = np.zeros(a.shape[1]), np.append(np.full(x.shape[1], ridge), 1e-6)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + np.diag(pull + 1e-9), a.T @ (y - p) - pull * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-10:
            break
    plain = w[:-1] / scale
    return (*map(float, plain), float(w[-1] - plain @ mean))


def fit(docs: DataFrame, labels: DataFrame, chars: bytes, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", sample: int = SAMPLE, size: int = FEATURES) -> Model | None:
    """Learn from labelled rows that are not held out; None without a toxic one."""
    context = docs.sparkSession.sparkContext
    known = (labels.where(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("id"))
             .agg(F.min(label).alias("y"), F.max(label).alias("top")).where("y = top and id is not null")
             .where(~held_out("id")).select("id", F.col("y").cast("int").alias("y")))
    h = F.xxhash64(F.col("id"), F.lit(13))
    part = lambda y: known.where(F.col("y") == y).orderBy(h, "id").limit(sample)
    picked = F.broadcast(part(0).union(part(1)))  # at most 2 * sample ids

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _held("decoder", chars_key, lambda: Decoder(shared.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                words = pa.array([sorted(decoder.words(t.as_py())) for t in some.column("t")], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([some.column("y"), words], names=["y", "words"])

    shared, chars_key = context.broadcast(chars), uuid.uuid4().hex
    rows = (docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).join(picked, "id")
            .select("y", "t", text_hash("t").alias("h")).dropDuplicates(["h", "y"])
            .select("y", "t").mapInArrow(restore, "y int, words array<string>"))
    rows = materialize(rows, "toxic_words")
    totals = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic:
        return None
    if not clean:
        return Model(chars, toxic, 0, pa.table({"feature": [], "p": [], "n": []}), ())
    # candidates: what occurs in two toxic texts or more, at most ``size`` of them
    positive = (_count_documents(rows.where("y = 1")).where("n > 1").orderBy(F.desc("n"), "feature").limit(size)
                .select("feature", F.col("n").alias("p")).toArrow().combine_chunks())
    wanted = context.broadcast(positive["feature"].combine_chunks())
    negative = _count_documents(rows.where("y = 0"), wanted).toArrow()  # of those candidates only
    n_of = dict(zip(negative["feature"].to_pylist(), negative["n"].to_pylist(), strict=True))
    counts = positive.append_column("n", pa.array([n_of.get(f, 0) for f in positive["feature"].to_pylist()], pa.int64()))
    held, key = context.broadcast(counts), uuid.uuid4().hex

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = _held("evidence", key, lambda: Evidence(held.value, toxic, clean))
        for batch in batches:
            at = [evidence.point(w.as_py(), y) for y, w in zip(batch["y"].to_pylist(), batch["words"], strict=True)]
            yield pa.RecordBatch.from_arrays([batch["y"], pa.array(at, pa.list_(pa.float64()))], names=["y", "x"])

    points = rows.mapInArrow(place, "y int, x array<double>").toArrow()  # at most 2 * sample rows
    x = np.array(points["x"].to_pylist())
    y = points["y"].to_numpy().astype(float)
    order = np.lexsort((y, *x.T))  # the same sums whatever the partitions
    weights = logistic(x[order], y[order])
    odds = np.array([log_odds(p, n, toxic, clean) for p, n in zip(counts["p"].to_pylist(), counts["n"].to_pylist(), strict=True)])
    return Model(chars, toxic, clean, counts.filter(pa.array(odds >= LEAST)), weights)


def with_toxicity(docs: DataFrame, model: Model | None, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` and the score (0 to 1) of each whole text; ``docs`` must not have that column."""
    if model is None or not model.clean:
        return docs.withColumn(score, F.lit(0.0 if model is None else 0.5))
    context, key = docs.sparkSession.sparkContext, uuid.uuid4().hex
    held = context.broadcast(model)

    @F.arrow_udf("array<double>")
    def points(texts: pa.Array) -> pa.Array:
        m = held.value
        decoder, evidence = _held("scorer", key, lambda: (Decoder(m.chars), Evidence(m.counts, m.toxic, m.clean)))
        return pa.array([evidence.point(decoder.words(t.as_py())) for t in texts], pa.list_(pa.float64()))

    at, = fresh(docs, "_point")
    z = F.lit(model.weights[-1])
    for i, w in enumerate(model.weights[:-1]):
        z = z + F.col(at)[i] * w
    return (docs.withColumn(at, points(text))
            .withColumn(score, 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), z))))).drop(at))


def restored_text(docs: DataFrame, chars: bytes, text: str = "text", restored: str = "restored") -> DataFrame:
    """``docs`` and each whole text with its obfuscated words restored (null stays null)."""
    shared, key = docs.sparkSession.sparkContext.broadcast(chars), uuid.uuid4().hex

    @F.arrow_udf("string")
    def restore(texts: pa.Array) -> pa.Array:
        decoder = _held("decoder", key, lambda: Decoder(shared.value))
        return pa.array([decoder.restored(t.as_py()) if t.is_valid else None for t in texts], pa.string())

    return docs.withColumn(restored, restore(text))


def toxicity_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    threshold: float = 0.3) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 where score >= ``threshold``)."""
    model = fit(docs, labels, char_model(docs, text), doc_id, text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return (with_toxicity(rows, model)
            .select("doc_id", held_out("doc_id").alias("held_out"), "score",
                    F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")))
