"""Exact top-k search by inner product as a Voronoi kNN join.

Components are scaled to integers, floor(1024 * x). A bounded number of pivots
(data rows of least id hash) divides queries and data into cells. Summaries
per cell - rows, radius, the distances of the k + 1 rows nearest the pivot for
the data, radius and norm for the queries - give each query cell a score that
its k-th best surely reaches; a data row is sent to a query cell only if
pivot . x + radius * |x| or norm * |x| allows as much. What meets is solved
locally by matrix product, and the local best are merged per query. Bounds are
real-valued with a margin, scores are exact integers.

Cells are split before they meet: the queries of a cell into parts of about
``QUERIES`` rows, the data sent to it into chunks of about ``ROWS`` rows (by
id hash), so neither one very common vector nor a full cell lands in one task.
The driver sees only pivots and summaries (at most ``CELLS`` of them). Where
vectors point everywhere the bounds exclude little, and the work is that of
comparing each query with each row, evenly spread.

Defined results: vectors that are null or hold null or non-finite components,
or whose scaled components pass 2^53, take no part, nor do rows without an id;
rows equal in id and vector count once; a shorter vector is as if padded with
zeros; a query never meets rows of its own id; extra columns are ignored;
scores beyond 64 bits are cut to the largest long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlens.llm.common import materialize, numbered

SCALE = 1024
CELLS = 256
PER_CELL = 64     # queries aimed at per cell, up to CELLS cells
QUERIES = 4096
ROWS = 16384


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Scaled vectors, padded with zeros, as float64 (whole numbers)."""
    out = np.zeros((len(column), dim))
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products as int64."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if most < 2.0 ** 53:
        return np.rint(q @ x.T).astype(np.int64)
    q, x = q.astype(np.int64), x.astype(np.int64)
    if most < 2.0 ** 62:
        return q @ x.T
    s = q.astype(object) @ x.T.astype(object)
    return np.clip(s, -2 ** 63, 2 ** 63 - 1).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id",
          embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of each query."""
    x = F.col(embedding)
    usable = (F.col(vec_id).isNotNull() & x.isNotNull() & F.forall(x, lambda v: F.coalesce(
        ~F.isnan(v) & (F.abs(v.cast("double")) * SCALE < 2.0 ** 53), F.lit(False))))
    rows = (vectors.withColumn("_q", F.coalesce(is_query, F.lit(False))).where(usable)
            .select(F.col(vec_id).cast("long").alias("vec_id"), x.cast("array<double>").alias("x"), F.col("_q").alias("q"))
            .dropDuplicates(["vec_id", "x", "q"]))
    rows = numbered(rows, "vectors", "row")
    total = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("q"), 1)), F.max(F.size("x"))).first()
    n, n_queries, dim = total[0], total[1], max(1, total[2] or 0)
    empty = "query_id long, rank int, vec_id long, score long"
    if not n_queries:
        return vectors.sparkSession.createDataFrame([], empty)
    few = min(CELLS, max(1, n_queries // PER_CELL))
    picked = rows.orderBy(F.xxhash64("vec_id"), "row").limit(few).select("x").toArrow()["x"].combine_chunks()
    pivots = np.unique(_matrix(picked, dim), axis=0)
    p_norm = np.linalg.norm(pivots, axis=1)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("x"), dim)
            near = (v ** 2).sum(1)[:, None] - 2 * v @ pivots.T + p_norm ** 2
            cell = near.argmin(1)
            gap = np.linalg.norm(v - pivots[cell], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("vec_id"), batch.column("q"), pa.array(cell, pa.int32()), pa.array(gap),
                 pa.array(np.linalg.norm(v, axis=1)), pa.array([r.tobytes() for r in v], pa.binary())],
                names=["row", "vec_id", "q", "cell", "gap", "norm", "v"])

    cells = materialize(rows.mapInArrow(assign, "row long, vec_id long, q boolean, cell int, gap double, norm double, v binary"),
                        "cells")
    summary = cells.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("q"), 1)).alias("queries"),
        F.max(F.when(F.col("q"), F.col("gap"))).alias("radius"), F.max(F.when(F.col("q"), F.col("norm"))).alias("norm")).collect()
    ranked = cells.withColumn("nth", F.row_number().over(Window.partitionBy("cell").orderBy("gap", "row")))
    nearest = ranked.where(F.col("nth") <= k + 1).groupBy("cell").agg(F.collect_list("gap").alias("gaps")).collect()
    parts = {s.cell: -(-s.queries // QUERIES) for s in summary if s.queries}
    radius = {s.cell: s.radius for s in summary if s.queries}
    norm = {s.cell: s.norm for s in summary if s.queries}
    floor = {}
    for i in parts:  # what the k-th best of any query in cell i reaches; k + 1 rows, as one may be its own
        low = [float(pivots[i] @ pivots[s.cell]) - p_norm[i] * g - radius[i] * (p_norm[s.cell] + g)
               for s in nearest for g in s.gaps]
        low.sort(reverse=True)
        floor[i] = low[k] if len(low) > k else -np.inf
    groups = np.array(sorted(parts))
    centre = pivots[groups]
    spread, longest, least = (np.array([d[i] for i in groups]) for d in (radius, norm, floor))
    margin = 1e-6 * (1 + float(p_norm.max() + max(spread)) * max(longest.max(), 1.0))
    chunks = -(-n // ROWS)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.stack([np.frombuffer(b.as_buffer()) for b in batch.column("v")]) if batch.num_rows else np.zeros((0, dim))
            size = np.linalg.norm(v, axis=1)[:, None]
            most = np.minimum(v @ centre.T + spread * size, longest * size)
            at, to = np.nonzero(most + margin + 1e-9 * np.abs(most) >= least)
            for lo in range(0, len(at), 8192):
                some, group = batch.take(pa.array(at[lo:lo + 8192])), groups[to[lo:lo + 8192]]
                yield pa.RecordBatch.from_arrays([pa.array(group, pa.int32()), some.column("vec_id"), some.column("v")],
                                                 names=["cell", "vec_id", "v"])

    parts_of = F.create_map(*[F.lit(y) for i, t in parts.items() for y in (i, t)])
    data = (cells.select("vec_id", "v").mapInArrow(send, "cell int, vec_id long, v binary")
            .withColumn("part", F.explode(F.sequence(F.lit(0), parts_of[F.col("cell")] - 1)))
            .withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int")))
    queries = (cells.where("q").select("cell", "row", "vec_id", "v",
                                       F.pmod(F.xxhash64("row"), parts_of[F.col("cell")]).cast("int").alias("part"))
               .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))))

    def solve(q: pa.Table, d: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if q.num_rows and d.num_rows:
            qv, dv = (np.stack([np.frombuffer(b.as_buffer()) for b in t["v"]]) for t in (q, d))
            ids, own = d["vec_id"].to_numpy(), q["vec_id"].to_numpy()
            step = max(1, (1 << 22) // d.num_rows)
            for lo in range(0, len(qv), step):
                for i, s in enumerate(_scores(qv[lo:lo + step], dv), lo):
                    other = np.flatnonzero(ids != own[i])
                    best = other[_best(s[other], ids[other], k)]
                    out[0] += [q["row"][i].as_py()] * len(best)
                    out[1] += [own[i]] * len(best)
                    out[2] += ids[best].tolist()
                    out[3] += s[best].tolist()
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["row", "query_id", "vec_id", "score"])

    keys = ["cell", "part", "chunk"]
    local = queries.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInArrow(solve, "row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
