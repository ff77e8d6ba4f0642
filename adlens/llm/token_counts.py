"""Token counts of whole texts without materialising token ids.

A byte-level BPE tokenizer first cuts a text into pre-tokens and then encodes
each for itself, so a text's count is the sum of its pre-tokens' counts:

1. ``vocabulary``: the distinct pre-tokens of the whole corpus with how often
   they occur (tasks count before the shuffle) and, encoded once each, how
   many tokens they give.
2. Every document's pre-token frequencies meet these counts. The most frequent
   pre-tokens - at most ``HEAD`` of them, whatever the corpus - are broadcast
   and summed on the spot; the rest are joined on the pre-token, and as each
   of these is rare, no key is hot (``head_of``).

The library's own rules hold: special strings inside a text are one token each
(its default), nothing is added, nothing truncated. Texts in Latin-1 are cut
by an equivalent faster pattern; a text with a character that the two Unicode
tables class differently is cut by the library itself.

Defined results: a null text counts as empty (0 bytes, 0 tokens); every input
row gives one row, repeated ones too; null ids are kept; extra columns are
ignored.
"""

from __future__ import annotations

import json
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adlens.llm.common import materialize, numbered

HEAD = 400_000
COUNTED = 4096  # occurrences up to which the head's bound is found exactly
FLUSH = 200_000  # distinct pre-tokens a task holds before it ships their counts

#: The published split pattern of this family of tokenizers (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(256) if regex.match(kind, chr(c)))


class Splitter:
    """Cuts texts into special strings (counted) and pre-tokens."""

    def __init__(self, spec: str) -> None:
        config = json.loads(spec)
        pre = config["pre_tokenizer"] or {}
        extra = config["added_tokens"]
        if (pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space")
                or config["normalizer"] or config["model"]["type"] != "BPE"
                or any(t[k] for t in extra for k in ("single_word", "lstrip", "rstrip"))):
            raise ValueError("a plain byte-level BPE tokenizer is needed")
        self.library = Tokenizer.from_str(spec)
        self.special = re.compile("|".join(re.escape(t["content"]) for t in sorted(
            extra, key=lambda t: -len(t["content"])))) if extra else None
        letter, digit, space = _class(r"\p{L}"), _class(r"\p{N}"), _class(r"\s")
        # as PATTERN, in its order: a contraction only where a piece starts, never after a space
        self.latin = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+"
                                f"|[{space}]+(?![^{space}])|[{space}]+").findall
        self.general = regex.compile(PATTERN).findall
        self.agreed: dict[str, bool] = {}

    def _agrees(self, c: str) -> bool:
        if c not in self.agreed:
            s = f"a{c}1{c} {c}{c}b"
            own = [s[i:j] for _, (i, j) in self.library.pre_tokenizer.pre_tokenize_str(s)]
            self.agreed[c] = own == self.general(s)
        return self.agreed[c]

    def _cut(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
            return self.latin(text)
        except UnicodeEncodeError:
            if all(map(self._agrees, set(text))):
                return self.general(text)
            return [text[i:j] for _, (i, j) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def __call__(self, text: str) -> tuple[int, list[str]]:
        if self.special is None or not self.special.search(text):
            return 0, self._cut(text)
        parts = self.special.split(text)
        return len(parts) - 1, [p for part in parts for p in self._cut(part)]


_CACHE: dict[str, tuple[str, object]] = {}  # per worker process: the latest of each kind


def _cached(kind: str, key: str, make):
    if _CACHE.get(kind, ("", None))[0] != key:
        _CACHE[kind] = key, make()
    return _CACHE[kind][1]


def _splitter(spec) -> Splitter:
    return _cached("splitter", spec.value, lambda: Splitter(spec.value))


def vocabulary(docs: DataFrame, spec, text: str = "text") -> DataFrame:
    """piece, n (occurrences), k (tokens): a row per distinct pre-token."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held = _splitter(spec), Counter()
        out = lambda: pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["piece", "n"])
        for batch in batches:
            for t in batch.column(0):
                if t.is_valid:
                    held.update(split(t.as_py())[1])
                    if len(held) >= FLUSH:
                        yield out()
                        held.clear()
        yield out()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _splitter(spec).library
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                some = batch.slice(at, 4096)
                k = [len(e) for e in library.encode_batch(some.column("piece").to_pylist(), add_special_tokens=False)]
                yield some.append_column("k", pa.array(k, pa.int64()))

    return (docs.select(text).mapInArrow(count, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
            .mapInArrow(encode, "piece string, n long, k long"))


def head_of(known: DataFrame, head: int) -> Column:
    """Which pieces are broadcast: the most frequent ones, at most ``head``.

    The bound on n is the least, up to ``COUNTED``, that so many pieces reach;
    failing that, pieces of at least one in ``head`` of all occurrences, of
    which there can't be more than ``head``. What stays rare so occurs less
    than ``COUNTED`` times or makes up less than one in ``head``.
    """
    n = F.least("n", F.lit(COUNTED))
    held = known.groupBy(n.alias("n")).agg(F.count(F.lit(1)).alias("pieces"), F.sum(F.col("n")).alias("times")).collect()
    pieces, bound = 0, None
    for row in sorted(held, reverse=True):
        pieces += row.pieces
        if pieces > head:
            break
        bound = row.n
    if bound is not None:
        return F.col("n") >= bound
    return F.col("n") * head >= sum(row.times for row in held)


def token_counts(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", limit: int = 1024,
                 head: int = HEAD) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (more than ``limit``).

    ``tokenizer`` is the path of the tokenizer's .json on the driver.
    """
    context = docs.sparkSession.sparkContext
    with open(tokenizer, encoding="utf-8") as f:
        spec = context.broadcast(f.read())
    known = materialize(vocabulary(docs, spec, text), "vocabulary")
    common = head_of(known, head)
    table = known.where(common).select("piece", F.col("k").cast("int")).toArrow()
    top, key = context.broadcast(table.combine_chunks()), uuid.uuid4().hex

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = _splitter(spec)
        tokens = _cached("head", key, lambda: dict(zip(
            top.value["piece"].to_pylist(), top.value["k"].to_pylist(), strict=True)))
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                sure, rare = [], []
                for t in some.column("text"):
                    n, rest = 0, []
                    if t.is_valid:
                        n, pieces = split(t.as_py())
                        for piece, times in Counter(pieces).items():
                            k = tokens.get(piece)
                            if k is None:
                                rest.append((piece, times))
                            else:
                                n += k * times
                    sure.append(n)
                    rare.append(rest)
                sizes = pa.array([0, *map(len, rare)], pa.int32())
                offsets = pc.cumulative_sum(sizes).cast(pa.int32())
                flat = pa.StructArray.from_arrays([pa.array([p for r in rare for p, _ in r], pa.string()),
                                                   pa.array([n for r in rare for _, n in r], pa.int64())], names=["piece", "times"])
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), some.column("n_bytes"), pa.array(sure, pa.int64()),
                     pa.ListArray.from_arrays(offsets, flat)], names=["doc_id", "n_bytes", "sure", "rare"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.col(text).alias("text"))
    rows = numbered(rows.mapInArrow(sums, "doc_id long, n_bytes long, sure long, rare array<struct<piece:string,times:long>>"),
                    "token_rows", "row")
    rest = (rows.select("row", F.explode("rare").alias("r")).select("row", "r.piece", "r.times")
            .join(known.where(~common).select("piece", "k"), "piece")
            .groupBy("row").agg(F.sum(F.col("times") * F.col("k")).alias("rest")))
    n = F.col("sure") + F.coalesce("rest", F.lit(0))
    return (rows.select("row", "doc_id", "n_bytes", "sure").join(rest, "row", "left")
            .select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit")))
