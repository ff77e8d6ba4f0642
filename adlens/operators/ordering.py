"""The order of a result as data: every row with its global position.

A sort shows in a report and is lost in a table. ``positions`` numbers the
rows from 1 without gathering them: rows are cut into ranges of the order,
numbered inside their range, and moved on by the rows of the ranges before.
No task sees more than one range; what is added up in one place is one number
per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.session import materialize

CHUNK = 1 << 16  # equal rows that one step writes out


def positions(df: DataFrame, *order: Column | str, name: str = "position") -> DataFrame:
    """``df`` with a ``name`` column: the row's place (from 1) in ``order``.

    Ties go by the other columns from left to right, nulls first; equal rows
    are numbered first and sorted by that too, so that many of them are cut
    into ranges as others are, and get places that follow each other. ``df`` is sorted and
    written once, below the shared checkpoint folder.
    """
    cols = df.columns
    if name in cols:
        raise ValueError(f"column {name!r} exists")
    pre = "_"
    while any(c.startswith(pre) for c in cols):
        pre += "_"
    n, at, part, start = (pre + x for x in ("n", "at", "part", "start"))
    zero, step = F.lit(0).cast("long"), F.lit(CHUNK).cast("long")
    copies = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias(n))
              .select(*cols, n, F.explode(F.sequence(zero, F.col(n) - 1, step)).alias(at))
              .select(*cols, F.explode(F.sequence(F.col(at) + 1, F.least(F.col(n), F.col(at) + step))).alias(n)))
    keys = [*order, *cols, n]
    # the id of a row is its range times 2^33 plus its place in the range
    ranked = materialize(copies.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .select(*cols, F.monotonically_increasing_id().alias(at))
                         .withColumn(part, F.shiftright(at, 33)), "ranked")
    sizes = ranked.groupBy(part).agg(F.count(F.lit(1)).alias(n))  # one row per range
    sizes = sizes.agg(F.array_sort(F.collect_list(F.struct(part, n))).alias(at))
    before = F.transform(at, lambda x, i: F.struct(x[part].alias(part), F.aggregate(
        F.slice(at, F.lit(1), i), zero, lambda a, y: a + y[n]).alias(start)))
    return (ranked.join(F.broadcast(sizes.select(F.inline(before))), part)
            .select(*cols, (F.col(start) + F.col(at).bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias(name)))
