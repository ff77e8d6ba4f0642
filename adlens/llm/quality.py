"""Quality classifier from compressed sizes under two zstandard dictionaries.

One dictionary is built from texts labelled good, one from texts labelled bad.
A text is cut into blocks of ``BLOCK`` bytes (short ones keep a long text from
teaching the compressor its own words), and the whole text is compressed block
by block under each. The normalised difference of the two sizes,
(bad - good) / (bad + good), and the size per byte under the good dictionary -
a text that repeats itself is small under either, whatever the difference -
become a probability by a logistic curve fitted on labelled rows that built no
dictionary, weighted to the classes' true shares.

Learning takes a bounded sample: per class at most ``SAMPLE`` rows for the
dictionary and as many for the curve, in the order of a hash of doc_id, of at
most ``SAMPLE_BYTES`` bytes each. Scores cover every whole text. Both
dictionaries are built inside tasks; the driver sees them (``DICT_BYTES``
each) and the curve's points, never the corpus.

Defined results: a null text scores as an empty one, of difference and size 0;
contradictory labels of one doc_id, null labels and labels without a
document teach nothing; repeated rows score alike and count once in learning;
while one class has no learning rows every score is 0.5; a null doc_id is
scored and is not held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import fresh, text_hash

BLOCK = 512
DICT_BYTES = 256 << 10
LEVEL = 3
SAMPLE = 3000
SAMPLE_BYTES = 32 << 10


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]  # of difference, rate, rate squared, 1


def held_out(doc_id: str | Column) -> Column:
    """Rows never learned from: crc32 of the id's text leaves 1 modulo 3."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _dictionary(texts: list[bytes], size: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, texts).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: take it as it is
        return b"".join(texts)[:size].ljust(8, b"\n")


def _compressor(raw: bytes) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(raw)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False,
                                    write_checksum=False, write_dict_id=False)


def _sizes(good: bytes, bad: bytes):
    """Column -> (gap, rate): normalised size difference of each whole text, and
    its size per byte under the good dictionary, frames apart."""

    @F.arrow_udf("struct<gap:double,rate:double>")
    def sizes(texts: pa.Array) -> pa.Array:
        both = _compressor(good), _compressor(bad)
        frame = len(both[0].compress(b""))
        gap, rate = np.zeros(len(texts)), np.zeros(len(texts))
        for i, t in enumerate(texts):
            if not t.is_valid or not (t := memoryview(t.as_buffer())):
                continue
            starts = range(0, len(t), BLOCK)
            a, b = (sum(len(c.compress(t[k:k + BLOCK])) for k in starts) for c in both)
            gap[i], rate[i] = (b - a) / (b + a), (a - frame * len(starts)) / len(t)
        return pa.StructArray.from_arrays([pa.array(gap), pa.array(rate)], names=["gap", "rate"])

    return sizes


def _logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray) -> tuple[float, ...]:
    """Weighted maximum-likelihood weights with a weak ridge (Newton steps)."""
    mean, scale = x.mean(0), x.std(0) + 1e-12
    a = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w, ridge = np.zeros(a.shape[1]), np.append(np.full(x.shape[1], 0.05), 1e-6)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hessian = a.T @ (a * (share * p * (1 - p))[:, None]) + np.diag(ridge + 1e-9)
        step = np.linalg.solve(hessian, a.T @ (share * (y - p)) - ridge * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-10:
            break
    plain = w[:-1] / scale
    return (*map(float, plain), float(w[-1] - plain @ mean))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        sample: int = SAMPLE) -> Model | None:
    """Learn from labelled rows that are not held out; None if a class is missing."""
    known = (labels.where(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("id"))
             .agg(F.min(label).alias("y"), F.max(label).alias("top")).where("y = top and id is not null")
             .where(~held_out("id")).select("id", F.col("y").cast("int").alias("y"),
                                            (F.pmod(F.xxhash64("id"), F.lit(4)) == 0).alias("curve")))
    h = F.xxhash64(F.col("id"), F.lit(11))
    texts = (docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"))
             .where(F.octet_length("t").between(1, SAMPLE_BYTES)))
    picked = None
    for y in (0, 1):
        for curve in (False, True):
            part = known.where((F.col("y") == y) & (F.col("curve") == curve)).orderBy(h, "id").limit(sample)
            picked = part if picked is None else picked.union(part)
    # at most 4 * sample ids: bounded whatever the corpus holds
    rows = texts.join(F.broadcast(picked), "id").dropDuplicates(["id", "t"])

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(b=[t.encode() for t in group.t]).sort_values(["h", "k"])
        return pd.DataFrame({"y": [group.y.iloc[0]], "d": [_dictionary(group.b.tolist(), DICT_BYTES)]})

    # repeated ids may bring more rows than the sample's ids: bound those too
    rows = rows.withColumn("h", h).withColumn("k", text_hash("t"))
    part = lambda y: rows.where(~F.col("curve") & (F.col("y") == y)).orderBy("h", "k").limit(sample)
    taught = dict(part(0).union(part(1)).groupBy("y").applyInPandas(learn, "y int, d binary").collect())
    if len(taught) < 2:
        return None
    good, bad = bytes(taught[1]), bytes(taught[0])
    points = (rows.where("curve").orderBy("h", "k").limit(2 * sample)
              .select(_sizes(good, bad)("t").alias("s"), "y").select("s.*", "y").collect())
    if len({p.y for p in points}) < 2:  # too few rows for a curve: a fixed gentle one
        return Model(good, bad, (100.0, 0.0, 0.0, 0.0))
    total = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    points.sort()
    x = np.array([(p.gap, p.rate, p.rate ** 2) for p in points])
    y = np.array([p.y for p in points], float)
    per = {k: total[k] / np.sum(y == k) for k in (0, 1)}
    share = np.where(y == 1, per[1], per[0]) * len(y) / sum(total.values())
    return Model(good, bad, _logistic(x, y, share))


def with_quality(docs: DataFrame, model: Model | None, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` and the score (0 to 1) of each whole text; ``docs`` must not have that column."""
    if model is None:
        return docs.withColumn(score, F.lit(0.5))
    size, = fresh(docs, "_size")
    w = model.weights
    gap, rate = F.col(size)["gap"], F.col(size)["rate"]
    z = gap * w[0] + rate * w[1] + rate * rate * w[2] + w[3]
    return (docs.withColumn(size, _sizes(model.good, model.bad)(text))
            .withColumn(score, 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), z)))))
            .drop(size))


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 where score >= 0.5)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return (with_quality(rows, fit(docs, labels, doc_id, text))
            .select("doc_id", held_out("doc_id").alias("held_out"), "score",
                    F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")))
