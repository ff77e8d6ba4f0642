"""Variable-capacity best-fit packing of documents into training sequences.

A document of n words that exceeds the largest permitted sequence is cut into
full pieces and a rest; each piece is an item. What best-fit does depends on
the items' lengths alone, so it runs on their histogram: at most one number
per length up to the largest sequence, whatever the corpus holds. Lengths are
placed in descending order; each item goes to the open bin that it leaves
least room in, else a bin of the size with the least cost per word is opened;
at the end each bin shrinks to the smallest size that holds its contents. The
plan is made for each permitted size as the largest to open, and the one of
least total cost is taken, so the sizes are chosen jointly.

Bins with equal contents are one pattern with a count. Items find their bin by
their rank among the items of their length, which is computed in parallel
(counts per length and hash chunk, running sums over those counts, ranks
within a chunk), and one join with the patterns' segments.

Defined results: rows without words (or null text) get one row with null bin;
repeated rows are packed each; null ids are packed like others; ties go to an
arbitrary but fixed order of hashes; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlens.llm.common import materialize, text_hash, word_count

SIZES = (512, 1024, 2048, 4096)
CHUNKS = 256  # hash chunks of one length, ranked apart


def bin_cost(size: int) -> int:
    """Cost of a sequence: its positions and a fixed share for the sequence itself."""
    return size + 64


def best_fit(counts: dict[int, int], sizes: Sequence[int], cost: Callable[[int], float] = bin_cost) -> list[tuple]:
    """[(size, ((length, times), ...), bins)] for a histogram of lengths up to max(sizes)."""
    sizes = sorted(sizes)
    plans = []
    for top in range(len(sizes)):
        plan = [(min(s for s in sizes if s >= sum(n * k for n, k in held)), held, bins)
                for held, bins in _fill(counts, sizes, sizes[top], cost)]
        plans.append((sum(cost(s) * bins for s, _, bins in plan), len(plans), plan))
    return min(plans)[2]


def _fill(counts: dict[int, int], sizes: Sequence[int], top: int, cost: Callable) -> list[tuple]:
    room: dict[int, list[list]] = {}  # free words -> [[contents, bins], ...]
    free: list[int] = []

    def put(space: int, held: tuple, bins: int) -> None:
        if space not in room:
            room[space] = []
            insort(free, space)
        room[space].append([held, bins])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(free, length)
            if at == len(free):
                size = min((s for s in sizes if s >= length and (s <= top or s == min(z for z in sizes if z >= length))),
                           key=lambda s: (cost(s) / s, s))
                put(size, (), -(-left // (size // length)))
                continue
            space = free[at]
            held, bins = room[space].pop()
            if not room[space]:
                del room[space], free[at]
            each = space // length
            whole = min(bins, left // each)
            if whole:
                put(space - each * length, (*held, (length, each)), whole)
                left -= whole * each
                bins -= whole
            if bins and left:  # fewer than ``each`` are left: they share one bin
                put(space - left * length, (*held, (length, left)), 1)
                left, bins = 0, bins - 1
            if bins:
                put(space, held, bins)
    return [(held, bins) for groups in room.values() for held, bins in groups if held]


def segments(plan: list[tuple]) -> list[tuple]:
    """(length, first rank, end rank, first bin, items per bin, offset, size) of each pattern's items."""
    out, ranks, first = [], {}, 0
    for size, held, bins in plan:
        offset = 0
        for length, each in held:
            at = ranks.get(length, 0)
            ranks[length] = at + each * bins
            out.append((length, at, at + each * bins, first, each, offset, size))
            offset += length * each
        first += bins
    return out


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sizes: Sequence[int] = SIZES,
         cost: Callable[[int], float] = bin_cost) -> DataFrame:
    """One row per piece: doc_id, text_hash, part (from 0), start (word), length,
    bin_id (from 0), bin_size, bin_offset."""
    spark, most = docs.sparkSession, max(sizes)
    words = materialize(docs.select(F.col(doc_id).alias("doc_id"), text_hash(text).alias("text_hash"),
                                    word_count(text).alias("n")), "words")
    items = (words.select("doc_id", "text_hash", "n", F.explode(
        F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.ceil(F.col("n") / most) - 1).cast("long"))).alias("part"))
        .select("doc_id", "text_hash", "part", (F.col("part") * most).alias("start"),
                F.least(F.lit(most), F.col("n") - F.col("part") * most).alias("length"))
        .withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text_hash", "part"), F.lit(CHUNKS))))
    sized = items.where("length > 0")
    counted = sized.groupBy("length", "chunk").agg(F.count(F.lit(1)).alias("k"))
    counts = {r.length: r.k for r in counted.groupBy("length").agg(F.sum("k").alias("k")).collect()}  # at most max(sizes) rows
    plan = segments(best_fit(counts, sizes, cost))
    where = spark.createDataFrame(plan or [(0,) * 7], "s_length long, low long, high long, first long, each long, "
                                                      "offset long, bin_size long")
    by_chunk = Window.partitionBy("length").orderBy("chunk")
    before = counted.select("length", "chunk", (F.sum("k").over(by_chunk) - F.col("k")).alias("before"))
    here = F.row_number().over(Window.partitionBy("length", "chunk").orderBy("text_hash", "doc_id", "part"))
    ranked = sized.withColumn("here", here).join(before, ["length", "chunk"]).withColumn(
        "rank", F.col("before") + F.col("here") - 1)
    nth = F.col("rank") - F.col("low")
    placed = (ranked.join(where, (F.col("length") == F.col("s_length")) & (F.col("rank") >= F.col("low"))
                          & (F.col("rank") < F.col("high")))
              .select("doc_id", "text_hash", "part", "start", "length",
                      (F.col("first") + F.floor(nth / F.col("each"))).cast("long").alias("bin_id"), "bin_size",
                      (F.col("offset") + (nth % F.col("each")) * F.col("length")).alias("bin_offset")))
    none = F.lit(None).cast("long")
    return placed.unionByName(items.where("length = 0").select(
        "doc_id", "text_hash", "part", "start", "length", none.alias("bin_id"), none.alias("bin_size"),
        none.alias("bin_offset")))
