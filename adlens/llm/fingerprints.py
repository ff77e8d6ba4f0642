"""Document fingerprints: bottom-k sketches of shingle hashes.

A fingerprint keeps the ``SKETCH`` least of a text's distinct five-word
shingle hashes (48 bits each) as text: the number kept in full, then eight
base64 characters per hash, ascending. Fingerprints of parts of a text merge
to that of the whole (``merge``; shingles that span two parts are in neither),
and two of them estimate resemblance, containment and distinct counts without
the texts.

``edited_fingerprints`` also fingerprints every text after an edit: its last
half (rounded down, in code points) replaced by the first as many of the next
document in descending doc_id, the first one following the last. Documents are
dealt by ranges of (doc_id, text hash) whose bounds come from quantiles, so
that neighbours meet in one partition; the head of each range is sent to the
range before it as well. Texts are shuffled once, ranges are sorted by Spark
and read as a stream: no task holds more than a batch, and no window or single
partition orders the whole table.

Defined results: a null text counts as empty; empty sketches resemble only
each other (1, otherwise 0); equal doc_ids follow the text hash, equal rows
follow each other; null ids come last; a table of one row is its own next;
repeated rows give a row each; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import tasks, text_hash
from adlens.llm.words import pieces_of, shingles

SKETCH = 128
BITS = 48


def sketch(hashes: np.ndarray, size: int = SKETCH) -> np.ndarray:
    """The least ``size`` of the distinct hashes, cut to 48 bits, ascending."""
    return np.unique(hashes >> np.uint64(64 - BITS))[:size]


def encode(s: np.ndarray) -> str:
    raw = s.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()
    return base64.b64encode(raw).decode()


def decode(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 6)
    return np.concatenate([np.zeros((len(raw), 2), np.uint8), raw], 1).view(">u8").reshape(-1).astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, size: int = SKETCH) -> np.ndarray:
    """Sketch of the union of two shingle sets."""
    return np.union1d(a, b)[:size]


def distinct(a: np.ndarray, size: int = SKETCH) -> float:
    """Estimated number of distinct shingles (exact below the sketch's size)."""
    return float(len(a)) if len(a) < size else (size - 1) * float(2 ** BITS) / (float(a[-1]) + 1)


def _common(a: np.ndarray, b: np.ndarray, size: int) -> tuple[int, int]:
    """Of the union's sketch: how many values both have, and its length."""
    union = merge(a, b, size)
    both = np.intersect1d(a, b, assume_unique=True)
    return int(np.searchsorted(both, union[-1], "right")) if len(union) else 0, len(union)


def resemblance(a: np.ndarray, b: np.ndarray, size: int = SKETCH) -> float:
    """Estimated intersection over union."""
    both, union = _common(a, b, size)
    return both / union if union else 1.0


def containment(a: np.ndarray, b: np.ndarray, size: int = SKETCH) -> float:
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    both, union = _common(a, b, size)
    return min(1.0, both / union * distinct(merge(a, b, size), size) / distinct(a, size))


def _sketches(texts: pa.Array, size: int) -> list[np.ndarray]:
    return [sketch(h, size) for _, run in pieces_of(texts) for h in shingles(run)]


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SKETCH) -> DataFrame:
    """Per row: doc_id, fingerprint, shingles (estimated distinct count)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _sketches(batch.column("text"), size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([encode(x) for x in s], pa.string()),
                 pa.array([distinct(x, size) for x in s], pa.float64())], names=["doc_id", "fingerprint", "shingles"])

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(rows, "doc_id long, fingerprint string, shingles double"))


def _ranged(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(part, head, none, doc_id, h, text): the rows of each range, and as its
    last row (head = true) the first row of the following non-empty range."""
    none, key = F.col("none"), F.col("doc_id")
    rows = docs.select(F.col(doc_id).isNull().alias("none"), F.coalesce(F.col(doc_id), F.lit(0)).cast("long").alias("doc_id"),
                       text_hash(text).alias("h"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = tasks(docs.sparkSession)
    cuts = rows.where(~none).agg(F.percentile_approx(
        "doc_id", [i / n for i in range(1, n)], min(100 * n, 200_000))).first()[0] if n > 1 else None
    bounds = sorted(set(cuts or []), reverse=True)
    # a range ends with its bound's rows; a bound that takes several quantiles has so many rows that
    # these get ranges of their own, by text hash
    shares = [cuts.count(b) - 1 for b in bounds] + [0]
    starts = [0, *accumulate(1 + k for k in shares)]
    at, sub = F.lit(0), F.lit(0)
    if bounds:
        low = F.array(*[F.lit(b).cast("long") for b in bounds])
        at = F.aggregate(F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))]), F.lit(0),
                         lambda pos, step: F.when((pos + step <= len(bounds)) & F.coalesce(
                             F.get(low, pos + step - 1) > key, F.lit(False)), pos + step).otherwise(pos))
        share = F.get(F.array(*map(F.lit, shares)), at)
        nth = F.floor((F.col("h").cast("double") / 2.0 ** 64 + 0.5) * share)
        sub = F.when((share > 0) & (F.get(low, at) == key), 1 + F.least(share - 1, nth)).otherwise(0)
        at = F.get(F.array(*map(F.lit, starts)), at)
    part = F.when(none, starts[-1]).otherwise(at + sub).cast("int")
    rows = rows.withColumn("part", part)
    first = F.struct("none", (-key).alias("k"), "h")
    heads = {r.part: (r.k.none, -r.k.k, r.k.h) for r in rows.groupBy("part").agg(F.min(first).alias("k")).collect()}
    order = sorted(heads)  # one entry per range
    before = {heads[p]: order[i - 1] for i, p in enumerate(order)}  # the first range follows the last one
    known = docs.sparkSession.createDataFrame(
        [(*k, p) for k, p in before.items()] or [(True, 0, 0, -1)], "none boolean, doc_id long, h long, to int")
    # one copy of each head: equal rows of a head are one text
    copies = (rows.join(F.broadcast(known), ["none", "doc_id", "h"]).dropDuplicates(["none", "doc_id", "h"])
              .select("none", "doc_id", "h", "text", F.col("to").alias("part"), F.lit(True).alias("head")))
    both = rows.select("none", "doc_id", "h", "text", "part", F.lit(False).alias("head")).unionByName(copies)
    return both.repartitionById(starts[-1] + 1, F.col("part")).sortWithinPartitions("head", "none", F.desc("doc_id"), "h")


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SKETCH) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next."""
    rows = _ranged(docs, doc_id, text)

    def edit(own: str, following: str) -> str:
        half = len(own) // 2
        return own[:len(own) - half] + following[:half]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row that still lacks its next one: (none, doc_id, text, sketch)
        for batch in batches:
            for at, run in pieces_of(batch.column("text")):
                texts, sketches = run.to_pylist(), _sketches(run, size)
                ids = batch.column("doc_id").slice(at, len(run)).to_pylist()
                none = batch.column("none").slice(at, len(run)).to_pylist()
                heads = batch.column("head").slice(at, len(run)).to_pylist()
                done = []
                for row in zip(none, ids, texts, sketches, heads, strict=True):
                    if last is not None and not last[4]:
                        done.append((last, row, edit(last[2], row[2])))
                    last = row
                if not done:
                    continue
                edited = _sketches(pa.array([e for _, _, e in done], pa.large_string()), size)
                out = [(None if a[0] else a[1], len(a[2]), hashlib.sha256(e.encode()).hexdigest(), encode(a[3]), encode(s),
                        resemblance(a[3], s, size), resemblance(a[3], b[3], size))
                       for (a, b, e), s in zip(done, edited, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()),
                    strict=True)], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return rows.mapInArrow(compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                    "edited_fingerprint string, near_edited double, near_next double")
