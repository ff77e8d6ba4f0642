"""Mixing sources to target weights with a hypergeometric splitting tree.

Sources, ranked by code point with null last, weigh 5, 2, 1, repeating, and
share 150 % of all words; a target stops at twice its source's size and the
excess is shared again by weight (solved exactly by sorting the sources by the
level at which each stops). A source is read as often as its target holds it
whole, and the rest comes from a further part pass.

Each document has a ticket, a hash of seed, id and text: a keyed permutation
of its source. The tickets' leading bits cut a source into at most ``CELLS``
blocks. The part pass takes permuted blocks from the start while they fit, the
block at the boundary up to the last ticket that fits. The walk then goes on
over the tickets behind that still fit the room left (``_fill``): a round takes
them in order up to the next that does not fit, or the largest alone if that
fills more than half the room, so each round halves the room, until no unused
document fits; at the end the one that comes nearest is added, if it helps.

The block quotas of all sources are dealt to the output shards by a splitting
tree: a node gives its left half an exact share of its blocks, drawn without
replacement from all its sources at once (a multivariate hypergeometric draw),
until every shard has its count of blocks from every source; a source's
permuted block copies are then handed out by rank, so shards are disjoint.
``mix`` shuffles each shard locally by a second hash. Draws are hashes, so
reruns agree. Only DataFrame functions are used.

No window sees more than the blocks of one source, or the tickets of one
block; a source with a third of all rows is summed block by block with
map-side partial aggregation. Tables over sources have one row per source.

Defined results: null text has size 0 and is taken as often as its whole
source; a null source is a source of its own; a null id is a value like
others; rows equal in id, text and source have one ticket and are drawn
together; a source without words has target 0; extra columns are kept by
``mix`` and do not matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlens.llm.common import fresh, materialize, text_hash, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
CELLS = 1024
SHARDS = 16


def sized(docs: DataFrame, seed: int, doc_id: str, text: str, source: str) -> DataFrame:
    """doc_id, source, size, ticket, cell of every row."""
    ticket = F.xxhash64(F.lit(seed), F.col(doc_id), text_hash(text), F.col(source))
    return (docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"),
                        ticket.alias("ticket"))
            .withColumn("cell", F.shiftrightunsigned("ticket", 64 - (CELLS - 1).bit_length()).cast("int")))


def targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, sid (rank), source_size, target, whole (full passes), rest (words of the part pass)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = (rows.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("sid", F.row_number().over(by_name) - 1)
           .withColumn("w", F.get(F.array(*map(F.lit, weights)), F.pmod("sid", F.lit(len(weights)))).cast("double")))
    stop = F.col("source_size") * float(most)
    rising = Window.orderBy(stop / F.col("w"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(every) * share - F.coalesce(F.sum(stop).over(rising), F.lit(0.0)))
             / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(rising), F.lit(0.0))))
    per = per.withColumn("level", level)
    fits = F.when(F.col("level") * F.col("w") <= stop, F.struct(F.row_number().over(
        Window.orderBy(stop / F.col("w"), "sid")).alias("k"), F.col("level").alias("level")))
    per = per.withColumn("fits", fits).withColumn("level", F.min("fits").over(every)["level"]).drop("fits")
    target = F.when(F.col("source_size") == 0, 0.0).otherwise(F.coalesce(F.least(stop, F.col("level") * F.col("w")), stop))
    per = per.withColumn("target", target)
    whole = F.when(F.col("source_size") == 0, 0).otherwise(F.floor(F.col("target") / F.col("source_size"))).cast("long")
    return (per.withColumn("whole", whole)
            .withColumn("rest", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
            .select("source", "sid", "source_size", "target", "whole", "rest"))


def _split(nodes: DataFrame, seed: int) -> DataFrame:
    """Halve every node of more than one shard by a draw without replacement."""
    total = "aggregate(quota, 0L, (a, q) -> a + q)"
    give = f"cast(floor({total} * ((hi - lo) div 2) / (hi - lo)) as bigint)"
    u = f"(shiftrightunsigned(xxhash64({seed}L, lo, hi, s.i, j), 11) / 9007199254740992D)"
    left = f"""aggregate(transform(quota, (q, i) -> named_struct('q', q, 'i', i)),
        named_struct('r', {total}, 'd', {give}, 'xs', cast(array() as array<bigint>)),
        (acc, s) -> aggregate(if(s.q = 0, cast(array() as array<bigint>), sequence(1L, s.q)),
            named_struct('r', acc.r, 'd', acc.d, 'x', 0L),
            (a, j) -> if({u} * a.r < a.d, named_struct('r', a.r - 1, 'd', a.d - 1, 'x', a.x + 1),
                                          named_struct('r', a.r - 1, 'd', a.d, 'x', a.x)),
            a -> named_struct('r', a.r, 'd', a.d, 'xs', concat(acc.xs, array(a.x)))),
        acc -> acc.xs)"""
    halves = (nodes.withColumn("lq", F.expr(f"if(hi - lo = 1, quota, {left})"))
              .withColumn("both", F.expr("""if(hi - lo = 1, array(named_struct('lo', lo, 'hi', hi, 'quota', quota)), array(
                  named_struct('lo', lo, 'hi', lo + (hi - lo) div 2, 'quota', lq),
                  named_struct('lo', lo + (hi - lo) div 2, 'hi', hi, 'quota', zip_with(quota, lq, (q, x) -> q - x))))""")))
    return halves.select(F.explode("both").alias("n")).select("n.*")


def splitting_tree(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """quotas (sid int, quota long) -> shard, sid, low, high: the ranks of each
    source's blocks that a shard gets. Every shard gets its exact share."""
    nodes = (quotas.agg(F.array_sort(F.collect_list(F.struct("sid", "quota"))).alias("a"))
             .select(F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"),
                     F.transform("a", lambda x: x["quota"]).alias("quota")))
    for _ in range((shards - 1).bit_length()):
        nodes = _split(nodes, seed)
    # position in the quota array -> sid: sids are ranks from 0 without gaps
    leaves = nodes.select(F.col("lo").cast("int").alias("shard"), F.posexplode("quota").alias("sid", "got"))
    high = F.sum("got").over(Window.partitionBy("sid").orderBy("shard"))
    return leaves.withColumn("high", high).select("shard", "sid", (F.col("high") - F.col("got")).alias("low"), "high")


def _fill(unused: DataFrame, room: DataFrame) -> DataFrame:
    """(sid, ticket) of the unused documents (sid, cell, ticket, size) that
    fill each source's room (sid, miss)."""
    unused, room, rounds = materialize(unused, "unused"), materialize(room, "room"), []
    spent = lambda chosen: chosen.groupBy("sid").agg(F.sum("size").alias("spent"))
    less = F.col("miss") - F.coalesce("spent", F.lit(0))
    by_cell = Window.partitionBy("sid").orderBy("cell")
    every = Window.partitionBy("sid")
    free = materialize(unused.join(room, "sid").where("size <= miss"), "free")
    while not free.isEmpty():  # each source's room falls below half in every round
        cells = (free.groupBy("sid", "cell", "miss").agg(F.sum("size").alias("words"), F.max(F.struct("size", "ticket")).alias("big"))
                 .withColumn("before", F.sum("words").over(by_cell) - F.col("words"))
                 .withColumn("big", F.max("big").over(every)).withColumn("one", 2 * F.col("big.size") > F.col("miss"))
                 .where("one or before < miss"))
        here = free.drop("miss").join(cells, ["sid", "cell"])
        whole = F.col("before") + F.col("words") <= F.col("miss")
        run = F.col("before") + F.sum("size").over(Window.partitionBy("sid", "cell").orderBy("ticket"))
        edge = here.where(~F.col("one") & ~whole).withColumn("run", run).where("run <= miss")
        chosen = materialize(here.where(F.when(F.col("one"), F.col("ticket") == F.col("big.ticket")).otherwise(whole))
                             .select("sid", "ticket", "size").union(edge.select("sid", "ticket", "size")), "taken")
        rounds.append(chosen)
        free = materialize(free.join(spent(chosen), "sid", "left").select("sid", "cell", "ticket", "size", less.alias("miss"))
                           .where("size <= miss").join(chosen.select("sid", "ticket"), ["sid", "ticket"], "left_anti"), "free")
    extra = materialize(reduce(DataFrame.union, rounds), "taken") if rounds else unused.select("sid", "ticket", "size").where("false")
    near = (unused.join(room.join(spent(extra), "sid", "left").select("sid", less.alias("miss")), "sid")
            .where(F.col("size") < 2 * F.col("miss"))
            .join(extra.select("sid", "ticket"), ["sid", "ticket"], "left_anti"))
    last = near.groupBy("sid").agg(F.min(F.struct(F.abs(F.col("miss") - F.col("size")).alias("gap"), "ticket")).alias("b"))
    return materialize(extra.select("sid", "ticket").union(last.select("sid", "b.ticket")), "extra")


def mix_plan(rows: DataFrame, shards: int = SHARDS, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """A row per block: source, sid, cell, source_size, target, each (shards of
    the full passes), part (shard of the part pass or null), cut (last ticket
    of it; null: none), closer (shard of what is taken besides); and (sid,
    ticket) of what is taken besides."""
    per = materialize(targets(rows), "targets")
    cells = materialize(rows.groupBy("source", "cell").agg(F.sum("size").alias("words")), "cells")
    in_order = Window.partitionBy("source").orderBy("cell")
    cells = (cells.join(per, cells.source.eqNullSafe(per.source)).drop(per.source)
             .withColumn("end", F.sum("words").over(in_order)))
    part = F.col("rest") > 0
    cells = cells.withColumn("full", part & (F.col("end") <= F.col("rest"))).withColumn(
        "edge", part & ~F.col("full") & (F.col("end") - F.col("words") < F.col("rest")))
    edge = cells.where("edge").select(F.col("source").alias("e_source"), F.col("sid").alias("e_sid"), F.col("cell").alias("e_cell"),
                                      (F.col("rest") - F.col("end") + F.col("words")).alias("room"))
    same = lambda df, k: F.col("source").eqNullSafe(df[k])
    inner = (rows.join(edge, same(edge, "e_source") & (F.col("cell") == F.col("e_cell")))
             .groupBy("source", "cell", "room", "ticket").agg(F.sum("size").alias("size")))
    run = F.sum("size").over(Window.partitionBy("source").orderBy("ticket"))
    fit = F.col("run") <= F.col("room")
    inside = inner.withColumn("run", run).groupBy("source", "room").agg(
        F.max(F.when(fit, F.col("ticket"))).alias("cut"), F.max(F.when(fit, F.col("run"))).alias("run"))
    state = materialize(edge.join(inside.drop("room"), F.col("e_source").eqNullSafe(inside.source))
                        .select("e_source", "e_sid", "e_cell", "cut", (F.col("room") - F.coalesce("run", F.lit(0))).alias("miss")), "edges")
    units = rows.where("size > 0").groupBy("source", "cell", "ticket").agg(F.sum("size").alias("size"))
    unused = (units.join(state.where("miss > 0"), same(state, "e_source"))
              .where((F.col("cell") > F.col("e_cell")) | (F.col("cell") == F.col("e_cell"))
                     & F.coalesce(F.col("ticket") > F.col("cut"), F.lit(True)))
              .where(F.col("size") < 2 * F.col("miss")).select(F.col("e_sid").alias("sid"), "cell", "ticket", "size"))
    extra = _fill(unused, state.where("miss > 0").select(F.col("e_sid").alias("sid"), "miss"))
    taken = (cells.join(state, same(state, "e_source"), "left")
             .select("source", "sid", "cell", "source_size", "target", "whole", "full", "edge",
                     F.when(F.col("edge"), F.col("cut")).alias("cut")))
    copies = F.concat(F.when(F.col("whole") > 0, F.sequence(F.lit(1), F.col("whole").cast("int"))).otherwise(F.array().cast("array<int>")),
                      F.when(F.col("full") | F.col("edge"), F.array(F.lit(0))).otherwise(F.array().cast("array<int>")))
    taken = materialize(taken.withColumn("copies", copies), "taken")
    quotas = (per.select("sid").join(taken.groupBy("sid").agg(F.sum(F.size("copies")).cast("long").alias("quota")), "sid", "left")
              .select("sid", F.coalesce("quota", F.lit(0).cast("long")).alias("quota")))
    tree = splitting_tree(quotas, shards, seed)
    dealt = tree.where("high > low").select("shard", "sid", F.explode(F.sequence("low", F.col("high") - 1)).alias("nth"))
    permuted = Window.partitionBy("sid").orderBy(F.xxhash64(F.lit(seed), F.lit("block"), "sid", "cell", "copy"), "cell", "copy")
    blocks = (taken.select("sid", "cell", F.explode("copies").alias("copy"))
              .withColumn("nth", (F.row_number().over(permuted) - 1).cast("long")).join(dealt, ["sid", "nth"])
              .groupBy("sid", "cell").agg(F.sort_array(F.collect_list(F.when(F.col("copy") > 0, F.col("shard")))).alias("each"),
                                          F.max(F.when(F.col("copy") == 0, F.col("shard"))).alias("part")))
    none = F.array().cast("array<int>")
    plan = (taken.join(blocks, ["sid", "cell"], "left")
            .withColumn("closer", F.max(F.when(F.col("edge"), F.col("part"))).over(Window.partitionBy("sid"))))
    plan = materialize(plan.select("source", "sid", "cell", "source_size", "target", F.coalesce("each", none).alias("each"),
                                   "part", "full", "edge", "cut", "closer"), "mix")
    return plan, extra


def planned(rows: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """``rows`` of ``sized`` and source_size, target, shards: one shard for
    every copy of the row that the mix takes."""
    stored = materialize(rows, "sized")
    return _assign(stored, *mix_plan(stored, shards, seed))


def _assign(rows: DataFrame, plan: DataFrame, extra: DataFrame) -> DataFrame:
    p = plan.select(F.col("source").alias("p_source"), F.col("sid").alias("p_sid"), F.col("cell").alias("p_cell"), "source_size",
                    "target", "each", "part", "full", "edge", "cut", "closer")
    besides = extra.select(F.col("sid").alias("x_sid"), F.col("ticket").alias("x_ticket"))
    ticket = F.col("ticket")
    one = F.when(F.col("full") | F.col("edge") & F.coalesce(ticket <= F.col("cut"), F.lit(False)), F.col("part")).when(
        F.col("x_ticket").isNotNull(), F.col("closer"))
    return (rows.join(p, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("cell") == F.col("p_cell")))
            .join(besides, (F.col("p_sid") == F.col("x_sid")) & (ticket == F.col("x_ticket")), "left")
            .withColumn("shards", F.when(one.isNull(), F.col("each")).otherwise(F.array_append("each", one)))
            .drop("p_source", "p_sid", "p_cell", "each", "part", "full", "edge", "cut", "closer", "x_sid", "x_ticket"))


def mix(docs: DataFrame, shards: int = SHARDS, seed: int = 0, doc_id: str = "doc_id", text: str = "text",
        source: str = "source", shard: str = "shard") -> DataFrame:
    """The mix itself: the columns of ``docs`` and the output shard, a row for
    every copy taken, shuffled within its shard; each shard is one partition,
    so their number should grow with the corpus."""
    plan = mix_plan(materialize(sized(docs, seed, doc_id, text, source), "sized"), shards, seed)
    inner = [f"_m{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*inner)  # own names: the plan's can't clash
    at = {c: inner[docs.columns.index(c)] for c in (doc_id, text, source)}
    ticket = F.xxhash64(F.lit(seed), F.col(at[doc_id]), text_hash(at[text]), F.col(at[source]))
    rows = rows.withColumn("source", F.col(at[source])).withColumn("ticket", ticket).withColumn(
        "cell", F.shiftrightunsigned("ticket", 64 - (CELLS - 1).bit_length()).cast("int"))
    out = _assign(rows, *plan).select(*inner, "ticket", F.posexplode("shards").alias("copy", "to"))
    name, = fresh(docs, shard)
    order = F.xxhash64(F.lit(seed), F.lit("order"), "ticket", "copy")
    return (out.withColumn("o", order).repartitionById(shards, F.col("to")).sortWithinPartitions("o")
            .select(*[F.col(i).alias(c) for i, c in zip(inner, docs.columns, strict=True)], F.col("to").alias(name)))


def mixed_words(docs: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words, repeats
    counted), shards."""
    return planned(sized(docs, seed, "doc_id", "text", "source"), shards, seed).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"), "shards")
