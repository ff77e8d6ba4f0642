"""Spelling variants: near words found by probing edits against Bloom filters.

The vocabulary is counted over all texts (``words_of``) and every word gets a
64-bit key, a sum over its symbols by position, so that the key of each edit
follows from the word's own in constant time.

Filters are blocked (``BITS`` bits of one 64-bit block a word) and sharded by
word length. A pass broadcasts the filters of as many lengths as fit
``FILTER_BYTES``, and a length that alone does not fit is cut by key into parts
of its own, so that the broadcast is bounded however large the vocabulary is.
Each word generates its deletions and its replacements by a later symbol -
each near pair is met once, from its longer or its earlier word - and probes
them. Only positives are shuffled, as pairs of keys: joined with the vocabulary
they give both words, and ``levenshtein`` leaves the truly near ones.

Forms are followed to their roots by pointer doubling; a form has at least
twice the count, so chains are short. Each round is written below
``spark.checkpoint.dir``.

Defined results: null texts have no words; a null doc_id edits nothing; rows
that repeat count each; a word without near words has n_near 0, form and
form_n null and itself as root; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import materialize
from adlens.llm.words import mix

LETTERS = r"[A-Za-zÀ-ÿ]+"
SHORTEST, LEAST, CUT = 5, 3, 97
FILTER_BYTES = 32 << 20
PER_BLOCK = 4       # words aimed at per 64-bit block
BITS = 4
PROBES = 1 << 21    # probes a task holds at a time
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", cut: int = CUT, shortest: int = SHORTEST,
             least: int = LEAST) -> DataFrame:
    """(word, n): words of ``shortest`` letters and ``least`` occurrences or more.

    Where ``cut`` divides the checksum of ``<doc_id>:<run>``, a letter of the run is missing.
    """
    run = F.col("run")
    h = F.crc32(F.concat(F.col("id").cast("string"), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    word = F.when(h % cut == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)
    runs = docs.select(F.col(doc_id).alias("id"), F.explode(F.regexp_extract_all(
        F.translate(text, UPPER, UPPER.lower()), F.lit(LETTERS), F.lit(0))).alias("run"))
    return (runs.where(F.char_length("run") >= shortest).select(word.alias("word"))
            .where(F.char_length("word") >= shortest)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least))


# --- keys --------------------------------------------------------------------

def _parts(symbols: np.ndarray, first: int) -> np.ndarray:
    """What each symbol adds to a key at positions ``first``, ``first`` + 1, ... of the last axis."""
    at = np.arange(first, first + symbols.shape[-1], dtype=np.uint64)
    return mix(symbols.astype(np.uint64) * _STEP + mix(at + np.uint64(1)))


def _matrices(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, symbols): the words of one length as a matrix of Latin-1 bytes."""
    raw = [w.encode("latin-1") for w in words.to_pylist()]
    size = np.array([len(w) for w in raw])
    for length in np.unique(size):
        rows = np.flatnonzero(size == length)
        yield rows, np.frombuffer(b"".join(raw[i] for i in rows), np.uint8).reshape(len(rows), length)


def _key(sums: np.ndarray, length: int) -> np.ndarray:
    return mix(sums + np.uint64(length * int(_STEP) % 2 ** 64))


def keyed(words: DataFrame) -> DataFrame:
    """``words`` (word, n) with len and key."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 8192):
                some = batch.slice(lo, 8192)
                key, size = np.zeros(some.num_rows, np.uint64), np.zeros(some.num_rows, np.int32)
                for rows, m in _matrices(some.column("word")):
                    size[rows] = m.shape[1]
                    key[rows] = _key(_parts(m, 0).sum(1, dtype=np.uint64), m.shape[1])
                yield some.append_column("len", pa.array(size)).append_column("key", pa.array(key.view(np.int64)))

    return words.mapInArrow(add, "word string, n long, len int, key long")


# --- filters -----------------------------------------------------------------

def shards(lengths: dict[int, int], budget: int = FILTER_BYTES) -> list[list[tuple[int, int, int, int]]]:
    """Passes of (length, part, parts, blocks); the blocks of a pass take ``budget`` bytes at most."""
    most = max(1, budget // 8)
    passes: list[list[tuple[int, int, int, int]]] = []
    room = 0
    for length, n in sorted(lengths.items()):
        blocks = -(-n // PER_BLOCK)
        parts = -(-blocks // most)
        for part in range(parts):
            size = -(-blocks // parts)
            if size > room:
                passes.append([])
                room = most
            passes[-1].append((length, part, parts, size))
            room -= size
    return passes


class Places:
    """Block and bits of a key in the filters of one pass."""

    def __init__(self, shards: list[tuple[int, int, int, int]]) -> None:
        self.of, self.blocks = {}, 0
        for length, part, parts, size in shards:
            self.of.setdefault(length, (parts, {}))[1][part] = (self.blocks, size)
            self.blocks += size

    def __call__(self, key: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Block (-1 where this pass has no filter for the key) and mask."""
        mask = np.zeros(len(key), np.uint64)
        for k in range(BITS):
            mask |= np.uint64(1) << ((key >> np.uint64(6 * k)) & np.uint64(63))
        high = key >> np.uint64(32)
        parts, held = self.of.get(length, (1, {}))
        if parts == 1:
            start, size = held.get(0, (0, 0))
            return ((high * np.uint64(size)) >> np.uint64(32)).astype(np.int64) + start if size else np.full(len(key), -1), mask
        block, part = np.full(len(key), -1), (mix(key) % np.uint64(parts)).astype(np.int64)
        for p, (start, size) in held.items():
            here = part == p
            block[here] = ((high[here] * np.uint64(size)) >> np.uint64(32)).astype(np.int64) + start
        return block, mask


def bloom(vocabulary: DataFrame, shards: list[tuple[int, int, int, int]]) -> np.ndarray:
    """The filters of one pass as one array of blocks, or-ed together by Spark."""
    places = Places(shards)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, key = batch.column("len").to_numpy(), batch.column("key").to_numpy().view(np.uint64)
            for length in np.unique(size):
                block, mask = places(key[size == length], int(length))
                here = block >= 0
                yield pa.RecordBatch.from_arrays([pa.array(block[here]), pa.array(mask[here].view(np.int64))], names=["block", "mask"])

    lengths = sorted({s[0] for s in shards})
    got = (vocabulary.where(F.col("len").isin(lengths)).select("len", "key").mapInArrow(mark, "block long, mask long")
           .groupBy("block").agg(F.bit_or("mask").alias("mask")).toArrow())  # FILTER_BYTES / 8 rows at most
    out = np.zeros(places.blocks, np.uint64)
    out[got["block"].to_numpy()] = got["mask"].to_numpy().view(np.uint64)
    return out


# --- probes ------------------------------------------------------------------

def _edits(m: np.ndarray, symbols: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row, key) of all deletions and of replacements by later symbols, in bounded pieces."""
    rows, length = m.shape
    here = _parts(m, 0)
    total = here.sum(1, dtype=np.uint64)
    if length > 1:
        before = np.cumsum(here, 1, dtype=np.uint64) - here           # symbols in front of each position
        moved = _parts(m[:, 1:], 0)                                   # symbols one place to the left
        after = np.zeros_like(here)
        after[:, :-1] = np.cumsum(moved[:, ::-1], 1, dtype=np.uint64)[:, ::-1]
        new = np.ones(m.shape, bool)
        new[:, 1:] = m[:, 1:] != m[:, :-1]                            # in a run of one symbol all deletions are equal
        row, at = np.nonzero(new)
        yield length - 1, row, _key(before[row, at] + after[row, at], length - 1)
    step = max(1, PROBES // max(1, rows * len(symbols)))
    for lo in range(0, length, step):
        span = m[:, lo:lo + step]
        other = _parts(np.repeat(symbols[:, None], span.shape[1], 1), lo)           # symbol x position
        row, at, symbol = np.nonzero(symbols[None, None, :] > span[:, :, None])
        yield length, row, _key(total[row] - here[row, lo + at] + other[symbol, at], length)


def probe(vocabulary: DataFrame, shards: list[tuple[int, int, int, int]], symbols: list[int]) -> DataFrame:
    """(key, len, near_key, near_len) of edits that the filters of this pass take for words."""
    places, letters = Places(shards), np.array(symbols, np.uint8)
    held = vocabulary.sparkSession.sparkContext.broadcast(bloom(vocabulary, shards))
    lengths = sorted({s[0] for s in shards} | {s[0] + 1 for s in shards})

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = held.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                some = batch.slice(lo, 1024)
                own = some.column("key").to_numpy()
                for rows, m in _matrices(some.column("word")):
                    per = max(1, PROBES // (m.shape[1] * len(letters)))
                    for at in range(0, len(rows), per):
                        for length, row, key in _edits(m[at:at + per], letters):
                            if length not in places.of:
                                continue
                            block, mask = places(key, length)
                            found = np.flatnonzero((block >= 0) & ((blocks[block] & mask) == mask))
                            k = len(found)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(own[rows[at + row[found]]]), pa.array(np.full(k, m.shape[1], np.int32)),
                                 pa.array(key[found].view(np.int64)), pa.array(np.full(k, length, np.int32))],
                                names=["key", "len", "near_key", "near_len"])

    return (vocabulary.where(F.col("len").isin(lengths)).select("word", "key")
            .mapInArrow(look, "key long, len int, near_key long, near_len int"))


def near_pairs(vocabulary: DataFrame, budget: int = FILTER_BYTES) -> DataFrame | None:
    """(word, n, near, near_n): every pair of words one edit apart, once; None without words.

    ``vocabulary``: stored rows of ``keyed``.
    """
    lengths = {r.len: r["count"] for r in vocabulary.groupBy("len").count().collect()}  # one row per word length
    if not lengths:
        return None
    symbols = sorted(ord(r[0]) for r in vocabulary.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct().collect())
    found = None
    for group in shards(lengths, budget):
        part = probe(vocabulary, group, symbols)
        found = part if found is None else found.unionAll(part)
    a = vocabulary.select("key", "len", "word", "n")
    b = vocabulary.select(F.col("key").alias("near_key"), F.col("len").alias("near_len"),
                          F.col("word").alias("near"), F.col("n").alias("near_n"))
    return (found.join(a, ["key", "len"]).join(b, ["near_key", "near_len"])
            .where(F.levenshtein("word", "near", 1) == 1)
            .select("word", "n", "near", "near_n").distinct())


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form), where following forms never leads back."""
    has = forms.select(F.col("word").alias("form"), F.lit(True).alias("active"))
    held = materialize(forms.join(has, "form", "left").select(
        "word", F.col("form").alias("root"), F.coalesce("active", F.lit(False)).alias("active")), "roots")
    while held.where("active").limit(1).count():
        # rows that have reached their root stay as they are: only the others are joined
        ahead = held.select(F.col("word").alias("root"), F.col("root").alias("next"), F.col("active").alias("more"))
        moved = held.where("active").join(ahead, "root").select("word", F.col("next").alias("root"), F.col("more").alias("active"))
        held = materialize(held.where("not active").unionAll(moved.select("word", "root", "active")), "roots")
    return held.select("word", "root")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", cut: int = CUT,
                      shortest: int = SHORTEST, least: int = LEAST, budget: int = FILTER_BYTES) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    vocabulary = materialize(keyed(words_of(docs, doc_id, text, cut, shortest, least)), "words")
    pairs = near_pairs(vocabulary, budget)
    if pairs is None:
        return docs.sparkSession.createDataFrame([], "word string, form string, root string, n long, n_near long, form_n long")
    both = pairs.select(F.explode(F.array(
        F.struct("word", "n", F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")).alias("best")),
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"),
                 F.struct((-F.col("n")).alias("less"), F.col("word").alias("near")).alias("best")))).alias("p")).select("p.*")
    best = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), F.min("best").alias("best"))
    is_form = -F.col("best.less") >= 2 * F.col("n")
    near = materialize(best.select("word", "n_near", F.when(is_form, F.col("best.near")).alias("form"),
                                   F.when(is_form, -F.col("best.less")).alias("form_n")), "forms")
    out = (vocabulary.select("word", "n").join(near, "word", "left")
           .join(roots(near.where("form is not null").select("word", "form")), "word", "left"))
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                      F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
