"""Set-similarity join of documents on word n-grams (rare-first prefix filter).

A document's set holds its distinct five-word shingles (``words.py``). Two
documents link when 100 * |intersection| >= 75 * |union|.

1. ``rarity``: every shingle of every document is counted. Tasks ship sorted
   32-bit remainders in binary blocks, dealt by the leading hash bits, so one
   shingle costs about four bytes of shuffle and a frequent one costs one
   entry per block. The result is a byte table of log2 counts by leading hash
   bits, of a fixed greatest size (2^SKETCH_BITS cells): 0 says that at most
   one document has the shingle. It is the only thing broadcast. Any function
   of a shingle gives a valid global order, so a full table costs work, never
   a link.
2. ``prefixes``: each set is ordered rare-first (level, hash). Of n shingles
   only the first n - ceil(0.75 n) + 1 can decide a link; those that no other
   document has are dropped. Documents with equal sets form one class.
3. ``links``: classes meet on prefix shingles, pass the length and positional
   filters, are made distinct and verified once per pair, where a suffix
   filter comes before the exact intersection. Star rounds (one, and more
   while the groups that still span components hold more than ``LAST_PAIRS``
   pairs) first compare each member with a few leaders of each shingle's
   group; afterwards only pairs of classes in different components are still
   looked at, all of them, so a group of thousands of near copies never emits
   all its pairs. There a pair leaves the join at the first shingle it meets
   on, not at each one, and only if 512 parities of the two sets differ in
   no more places than those of linked sets can.
4. Components of the links give each document its ``component_id``.
5. ``link_counts``: a link never leaves its component, so within each one every
   pair of classes that the length filter allows is compared exactly, block
   against block over an inverted index. Rows are made per class and block, not
   per pair. Every document gets its number of links (``n_links``).

Defined results: null text counts as empty; a text without words has an empty
set and links with nothing; a null doc_id takes part as a text but never names
a component (its component_id is null if nothing in its component has an id);
repeated rows are rows of one class; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlens.llm.common import materialize, numbered, text_hash
from adlens.llm.components import connected_components
from adlens.llm.words import mix, pieces_of, shingles

THRESHOLD = 75            # per cent of the union
SKETCH_BITS = 26          # at most 2^26 cells of half a byte: 32 MB broadcast
BUCKET_SHINGLES = 1 << 20  # aimed at in one counting group (4 MB)
BLOCK_SHINGLES = 1 << 20   # gathered by a task before it ships its blocks
STAR_ROUNDS = 3           # at most
LAST_PAIRS = 1 << 26      # of members of one group: as many are joined sooner than a star round is run
LEADERS = 16              # of one shingle's group in one star round
BEFORE = 16               # earlier shingles that tell whether a pair has met already
SIGN_LONGS = 8            # 64 bits each of a set's sign
BLOCK_CLASSES = 1024      # aimed at in one block whose links are counted
BLOCK_SET = 1 << 20       # shingles of its sets (8 MB)


def need(n: int, m: int, per_cent: int = THRESHOLD) -> int:
    """Least intersection of linked sets of n and m shingles."""
    return -(-per_cent * (n + m) // (100 + per_cent))


def rarity(docs: DataFrame, text: str = "text") -> tuple[bytes, int]:
    """Packed half-byte levels (0: in one document at most; else 1 + log2 of
    the count, at most 15) by the leading bits of a shingle's hash, and the
    number of those bits. Exact copies of a text count as documents."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    guess = max(1, total // 6)  # words of about six bytes
    bucket_bits = min(20, max(3, math.ceil(math.log2(guess / BUCKET_SHINGLES + 1))))
    cell_bits = max(bucket_bits + 1, min(SKETCH_BITS, math.ceil(math.log2(guess)) + 1))
    rest = 32

    def ship(held: list[np.ndarray]) -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(held) >> np.uint64(64 - bucket_bits - rest), return_counts=True)
        bucket = (h >> np.uint64(rest)).astype(np.int64)
        cut = np.flatnonzero(np.diff(bucket)) + 1
        first = np.concatenate([[0], cut])
        low = h.astype(np.uint32)
        once = [np.split(x, cut) for x in (low, n)]
        return pa.RecordBatch.from_arrays([
            pa.array(bucket[first].astype(np.int32)),
            pa.array([x.tobytes() for x in once[0]], pa.binary()),
            pa.array([np.flatnonzero(c > 1).astype(np.uint32).tobytes() for c in once[1]], pa.binary()),
            pa.array([c[c > 1].astype(np.uint32).tobytes() for c in once[1]], pa.binary()),
        ], names=["bucket", "low", "at", "times"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, run in pieces_of(batch.column(0)):
                for h in shingles(run):
                    if len(h):
                        held.append(h)
                        size += len(h)
                if size >= BLOCK_SHINGLES:
                    yield ship(held)
                    held, size = [], 0
        if held:
            yield ship(held)

    def count(group: pa.Table) -> pa.Table:
        low, n = [], []
        for a, i, k in zip(group["low"], group["at"], group["times"], strict=True):
            a = np.frombuffer(a.as_py(), np.uint32)
            c = np.ones(len(a), np.int64)
            c[np.frombuffer(i.as_py(), np.uint32)] = np.frombuffer(k.as_py(), np.uint32)
            low.append(a)
            n.append(c)
        low, n = np.concatenate(low), np.concatenate(n)
        order = np.argsort(low, kind="stable")
        low, n = low[order], n[order]
        first = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
        low, n = low[first], np.add.reduceat(n, first)
        low, n = low[n > 1], n[n > 1]
        levels = np.zeros(1 << (cell_bits - bucket_bits), np.uint8)
        np.maximum.at(levels, low >> np.uint32(rest - cell_bits + bucket_bits),
                      np.minimum(15, 1 + np.log2(n)).astype(np.uint8))
        packed = zlib.compress((levels[::2] | (levels[1::2] << 4)).tobytes(), 1)
        return pa.table({"bucket": group["bucket"].slice(0, 1), "levels": pa.array([packed], pa.binary())})

    out = bytearray(1 << (cell_bits - 1))
    width = 1 << (cell_bits - bucket_bits - 1)
    found = (docs.select(text).mapInArrow(blocks, "bucket int, low binary, at binary, times binary")
             .groupBy("bucket").applyInArrow(count, "bucket int, levels binary"))
    for row in found.collect():  # at most 2^SKETCH_BITS half bytes in all
        out[row.bucket * width:(row.bucket + 1) * width] = zlib.decompress(row.levels)
    return bytes(out), cell_bits


def prefixes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", per_cent: int = THRESHOLD) -> DataFrame:
    """Per row: doc_id, text_hash, n (set size), hi, lo (128 bits that stand
    for the set), first (rank of the first kept prefix shingle), tokens (the
    prefix shingles that another document may have, rare-first) and, where
    there are any, the whole set as sorted binary."""
    levels, bits = rarity(docs, text)
    table = docs.sparkSession.sparkContext.broadcast(levels)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.frombuffer(table.value, np.uint8)
        for batch in batches:
            for at, run in pieces_of(batch.column("text")):
                cols = [[] for _ in range(6)]
                for h in shingles(run):
                    n = len(h)
                    size = n - -(-per_cent * n // 100) + 1 if n else 0
                    cell = h >> np.uint64(64 - bits)
                    level = (cells[cell >> np.uint64(1)] >> ((cell & np.uint64(1)) << np.uint64(2))) & np.uint8(15)
                    alone = int((level == 0).sum())
                    tokens = h[:0]
                    if alone < size:
                        shared = h[level > 0]
                        tokens = shared[np.lexsort((shared, level[level > 0]))][:size - alone]
                    key = [int(mix(h * np.uint64(c)).sum(dtype=np.uint64)) if n else 0
                           for c in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)]
                    for col, v in zip(cols, (n, *np.array(key, np.uint64).view(np.int64).tolist(), alone,
                                             tokens.view(np.int64), h.tobytes() if len(tokens) else None), strict=True):
                        col.append(v)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(at, len(run)) for c in ("doc_id", "text_hash")]
                    + [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                       pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.list_(pa.int64())), pa.array(cols[5], pa.binary())],
                    names=["doc_id", "text_hash", "n", "hi", "lo", "first", "tokens", "set"])

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_hash(text).alias("text_hash"),
                        F.col(text).alias("text"))
            .mapInArrow(rows, "doc_id long, text_hash long, n int, hi long, lo long, first int, "
                              "tokens array<long>, set binary"))


def _verify(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Pairs (a, b) whose sets reach the threshold, each compared once."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                least, spare = need(len(x), len(y), per_cent), 0
                # suffix filter: halves around a middle value bound the overlap
                cut = x[len(x) // 2]
                i0, j0 = len(x) // 2, int(np.searchsorted(y, cut))
                spare = min(i0, j0) + min(len(x) - i0, len(y) - j0)
                if spare >= least:
                    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                    keep[i] = int((y[at] == x).sum()) >= least
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    side = lambda k, v: sets.select(F.col("cls").alias(k), F.col("set").alias(v))
    return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").mapInArrow(check, "a long, b long")


def _may_link(per_cent: int):
    """Length and positional filter between members l and r of one shingle's group.

    Nothing in common stands before the first shingle that two sets share, so
    there the rest of either set bounds the overlap; a pair that links passes
    at that shingle, whatever its others say.
    """
    n, m = F.col("n"), F.col("ln")
    least = F.ceil(F.lit(per_cent) * (n + m) / F.lit(100 + per_cent))
    return ((F.least(n, m) * 100 >= F.greatest(n, m) * per_cent)
            & (F.least(n - F.col("pos"), m - F.col("lpos")) >= least))


def _with_before(members: DataFrame) -> DataFrame:
    """``members`` (token, cls, pos, ...) with ``before``: up to BEFORE shingles
    of the class that stand before this one and are members too.

    Two classes that have one of these in common meet on that shingle as well,
    so their pair is left to it. At the first shingle they share nothing before
    is common: there every pair stays, and there a pair that links passes the
    positional filter. More than BEFORE others in between let a pair through
    again, to be made distinct.
    """
    return members.withColumn("before", F.collect_list("token").over(
        Window.partitionBy("cls").orderBy("pos").rowsBetween(-BEFORE, -1)))


def _signs(sets: DataFrame) -> DataFrame:
    """(cls, sign): for each of 64 * SIGN_LONGS remainders of a hash, whether
    an odd number of the set's shingles leave it."""
    bits = 64 * SIGN_LONGS

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.packbits(np.bincount((np.frombuffer(v.as_buffer(), np.uint64) % np.uint64(bits)).astype(np.int64),
                                           minlength=bits).astype(np.uint8) & 1).view(np.int64) for v in batch["set"]]
            yield pa.RecordBatch.from_arrays([batch["cls"], pa.array(out, pa.list_(pa.int64()))], names=["cls", "sign"])

    return sets.mapInArrow(sign, "cls long, sign array<long>")


def _signs_may_link(per_cent: int):
    """Whether signs allow a link: each bit in which two signs differ takes a
    shingle that only one of the sets has, and linked sets have at most n + m
    less twice the least intersection of those."""
    both = F.col("n") + F.col("ln")
    least = F.ceil(F.lit(per_cent) * both / F.lit(100 + per_cent))
    apart = F.lit(0)
    for i in range(SIGN_LONGS):
        apart = apart + F.bit_count(F.col("sign")[i].bitwiseXOR(F.col("lsign")[i]))
    return apart <= both - 2 * least


def links(classes: DataFrame, per_cent: int = THRESHOLD) -> DataFrame:
    """(a, b) between classes (cls, n, first, tokens, set) with the components
    of the whole link graph: the exactly verified links of the last round, and
    for the rounds before it each class with the root they give it."""
    tokens = materialize(classes.select("cls", "n", F.posexplode("tokens").alias("i", "token"), "first")
                         .select("token", "cls", "n", (F.col("first") + F.col("i")).alias("pos")), "tokens")
    sets = classes.select("cls", "set")
    # shingles that two classes have
    shared = materialize(tokens.join(tokens.groupBy("token").count().where("count > 1").select("token"), "token"), "shared")
    stars, tried, root = None, None, None
    for turn in range(STAR_ROUNDS + 1):
        last = turn == STAR_ROUNDS
        here = shared.withColumn("root", F.col("cls")) if root is None else (
            shared.join(root, shared.cls == root.node, "left")
            .select("token", "cls", "n", "pos", F.coalesce("root", "cls").alias("root")))
        if turn:  # only groups that still hold more than one component
            here = materialize(here, "here")
            groups = (here.groupBy("token").agg(F.min("root").alias("p"), F.max("root").alias("q"), F.count(F.lit(1)).alias("c"))
                      .where("p < q"))
            last = last or (groups.agg(F.sum(F.col("c") * (F.col("c") - 1.0) / 2)).first()[0] or 0) <= LAST_PAIRS
            here = here.join(groups.select("token"), "token")
        if not last:
            h = F.xxhash64("cls", F.lit(turn))
            other = here.groupBy("token", F.pmod(h, F.lit(LEADERS))).agg(F.min(F.struct(
                h.alias("h"), F.col("cls").alias("lcls"), F.col("n").alias("ln"), F.col("pos").alias("lpos"),
                F.col("root").alias("lroot"))).alias("l")).select("token", "l.*").drop("h")
            apart = F.col("root") != F.col("lroot")
        else:
            here = materialize(_with_before(here).join(_signs(sets), "cls"), "last")
            other = here.select("token", F.col("cls").alias("lcls"), F.col("n").alias("ln"), F.col("pos").alias("lpos"),
                                F.col("root").alias("lroot"), F.col("before").alias("lbefore"), F.col("sign").alias("lsign"))
            apart = (F.col("root") < F.col("lroot")) & ~F.arrays_overlap("before", "lbefore") & _signs_may_link(per_cent)
        pairs = (here.join(other, "token").where(_may_link(per_cent) & apart)
                 .select(F.least("cls", "lcls").alias("a"), F.greatest("cls", "lcls").alias("b")).distinct())
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        new = materialize(_verify(pairs, sets, per_cent), "links")
        edges = new if stars is None else stars.union(new)
        if last:
            return edges
        tried = pairs if tried is None else tried.union(pairs)
        root = connected_components(edges)
        stars = root.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))


def _degrees(per_cent: int):
    """Counts the linked documents of a group's classes: of each with each
    other (side 2), or of those of side 0 with those of side 1."""

    def count(group: pa.Table) -> pa.Table:
        side = group["side"].to_numpy()
        size = group["size"].to_numpy()
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in group["set"]]
        n = np.array([len(x) for x in sets], np.int64)
        links = np.zeros(len(sets), np.int64)
        same = bool((side == 2).all())
        left, right = (np.flatnonzero(side == (2 if same else k)) for k in (0, 1))
        if same:
            right = left
        if len(left) and len(right):
            values = np.concatenate([sets[i] for i in right])
            order = np.argsort(values, kind="stable")
            owner = np.repeat(np.arange(len(right)), n[right])[order]
            values = values[order]
            start = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
            long, values = np.diff(np.append(start, len(values))), values[start]
            for i in left:
                at = np.minimum(np.searchsorted(values, sets[i]), len(values) - 1)
                at = at[values[at] == sets[i]]
                if not len(at):
                    continue
                ends = np.cumsum(long[at])
                spots = np.arange(ends[-1]) + np.repeat(start[at] - ends + long[at], long[at])
                both = np.bincount(owner[spots], minlength=len(right))
                found = right[(both > 0) & (100 * both >= per_cent * (n[i] + n[right] - both))]
                if same:
                    found = found[found != i]
                else:
                    links[found] += size[i]
                links[i] += size[found].sum()
        return pa.table({"cls": group["cls"], "links": pa.array(links)})

    return count


def link_counts(classes: DataFrame, root: DataFrame, per_cent: int = THRESHOLD) -> DataFrame:
    """(cls, links): the documents of other classes that each class links to,
    from classes (cls, n, size, set) and the components (node, root) of their links.

    Components of one block at most share hashed groups. Larger ones are cut
    by set size (powers of two) and hash into blocks, and all blocks of sizes
    that can link meet in pairs.
    """
    bands = math.ceil(math.log2(100 / per_cent))  # apart at most
    parts = lambda n, w: F.greatest(F.ceil(n / F.lit(BLOCK_CLASSES)), F.ceil(w / F.lit(BLOCK_SET))).cast("int")
    member = materialize(classes.select("cls", "n", "size").join(root, F.col("cls") == F.col("node"))
                         .select("cls", "size", "n", "root", F.length(F.bin("n")).alias("band")), "members")
    whole = (member.groupBy("root", "band").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"))
             .groupBy("root").agg(F.sum("c").alias("c"), F.sum("w").alias("w"), F.collect_list(F.struct(
                 "band", parts(F.col("c"), F.col("w")).alias("parts"))).alias("cut")))
    whole = materialize(whole.withColumn("few", parts(F.col("c"), F.col("w")) == 1), "whole")
    total = whole.where("few").agg(parts(F.sum("c"), F.sum("w"))).first()[0] or 1
    few = (member.join(whole.where("few").select("root"), "root", "left_semi")
           .select("cls", "size", (-1 - F.pmod(F.xxhash64("root"), F.lit(total))).alias("root"),
                   F.lit(0).alias("b1"), F.lit(0).alias("s1"), F.lit(0).alias("b2"), F.lit(0).alias("s2"), F.lit(2).alias("side")))
    salt = F.pmod(F.xxhash64("cls"), F.filter("cut", lambda x: x["band"] == F.col("band"))[0]["parts"]).cast("int")
    others = F.flatten(F.transform(F.filter("cut", lambda x: F.abs(x["band"] - F.col("band")) <= bands), lambda x: F.transform(
        F.sequence(F.lit(0), x["parts"] - 1), lambda j: F.struct(x["band"].alias("b"), j.alias("s")))))
    own, to = F.col("own"), F.col("to")
    many = (member.join(whole.where("not few").select("root", "cut"), "root")
            .select("cls", "size", "root", F.struct(F.col("band").alias("b"), salt.alias("s")).alias("own"), others.alias("others"))
            .select("cls", "size", "root", "own", F.explode("others").alias("to"))
            .select("cls", "size", "root", F.least(own, to).alias("lo"), F.greatest(own, to).alias("hi"),
                    F.when(own == to, 2).when(own < to, 0).otherwise(1).alias("side"))
            .select("cls", "size", "root", F.col("lo.b").alias("b1"), F.col("lo.s").alias("s1"),
                    F.col("hi.b").alias("b2"), F.col("hi.s").alias("s2"), "side"))
    met = few.unionByName(many).join(classes.select("cls", "set"), "cls")
    return (met.groupBy("root", "b1", "s1", "b2", "s2").applyInArrow(_degrees(per_cent), "cls long, links long")
            .groupBy("cls").agg(F.sum("links").alias("links")))


def ngram_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", per_cent: int = THRESHOLD,
               count_links: bool = True) -> DataFrame:
    """One row per input row: doc_id, text_hash (of the whole text), n_shingles,
    component_id, class_size (rows with an equal set), n_links (other rows it
    links to, those with an equal set included), keep.

    The sum of ``n_links`` is twice the number of links between rows. Without
    ``count_links`` there is no such column, and pairs inside a component that
    the components don't need are not compared.

    ``keep`` marks one (doc_id, text_hash) of each component, the least with
    null ids last; rows without words are all kept.
    """
    rows = materialize(prefixes(docs, doc_id, text, per_cent), "prefixes")
    pick = lambda c: F.first(c).alias(c)  # noqa: E731  equal for equal sets
    classes = numbered(rows.where(F.size("tokens") > 0).groupBy("hi", "lo")
                       .agg(*(pick(c) for c in ("n", "first", "tokens", "set")), F.count(F.lit(1)).alias("size")), "classes", "cls")
    root = connected_components(links(classes, per_cent))
    named = classes.select("hi", "lo", "cls").join(root, F.col("cls") == F.col("node"))
    named = named.join(link_counts(classes, root, per_cent), "cls") if count_links else named.withColumn("links", F.lit(0))
    root = named.select("hi", "lo", "root", "links")
    head = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    own = (rows.where("n > 0").groupBy("hi", "lo").agg(head.alias("head"), F.count(F.lit(1)).alias("class_size"))
           .join(root, ["hi", "lo"], "left"))
    own = materialize(own, "own")
    joined = own.where("root is not null").groupBy("root").agg(F.min("head").alias("top"))
    own = (own.join(joined, "root", "left")
           .select("hi", "lo", "class_size", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("top", "head").alias("top")))
    slim = rows.select("doc_id", "text_hash", "n", "hi", "lo")
    top = F.col("top")
    out = (slim.join(own, ["hi", "lo"], "left")
           .select("doc_id", "text_hash", F.col("n").cast("long").alias("n_shingles"),
                   F.when(F.col("n") > 0, top["doc_id"]).otherwise(F.col("doc_id")).alias("component_id"),
                   F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
                   F.when(F.col("n") > 0, F.col("class_size") - 1 + F.col("links")).otherwise(0).cast("long").alias("n_links"),
                   ((F.col("n") == 0) | (top["doc_id"].eqNullSafe(F.col("doc_id"))
                                         & (top["text_hash"] == F.col("text_hash")))).alias("keep")))
    return out if count_links else out.drop("n_links")
