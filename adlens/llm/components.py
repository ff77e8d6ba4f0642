"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import materialize


def _star(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (a > b).

    The least neighbour of a node is the least b of its rows as a; without any
    the node itself is less than all its neighbours. The result is never larger
    than ``edges``: of each a's rows one becomes its link to its least, the
    others link their b to it.
    """
    least = edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    large = edges.join(least, edges.b == least.n, "left").select("a", F.coalesce("m", "b").alias("b"))
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    return (large.join(low, "a")
            .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
            .distinct())


def _settled(edges: DataFrame) -> bool:
    """Whether all edges are stars: each a has one b, which is no a."""
    ends = (edges.select(F.col("a").alias("node"), F.lit(1).alias("up"))
            .union(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"))))
    loose = (F.col("ups") > 1) | ((F.col("ups") == 1) & (F.col("least") == 0))
    return not (ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
                .agg(F.max(loose)).first()[0])


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links`` (a long, b long) -> (node, root): root is the least node it
    reaches. Nodes without a link are absent; null ends are dropped. The first
    round reads ``links`` three times: what is costly to make is best stored.

    Every step keeps at most one row per edge and pre-aggregates its minima on
    the map side, so a node with very many links is no hot spot; each round is
    written to the shared checkpoint folder, and the last is the one that
    leaves only stars. The rounds needed grow with the logarithm of a
    component's diameter.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    for _ in range(max_rounds):
        edges = materialize(_star(edges), "cc")
        if _settled(edges):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
