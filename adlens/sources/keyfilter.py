"""Key filters beside a date-partitioned table: which dates may hold a key.

For every date the folder ``<table>_keys`` holds the number of keys and their
range (``ranges``) and a blocked Bloom filter (``blocks``: rows of 512 bits,
about ``PER_BLOCK`` keys each, one bit in each of eight words a key: some five
false hits in a million). A merge looks its new keys up there and reads the
key column of the table only for the dates that are hit, or have no filter.

The filters take about four bytes a key. A lookup joins the new keys, once per
filter size in use, with the blocks of the dates whose range they meet; only
dates reach the driver. Everything is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.session import children, delete_path, path_exists

PER_BLOCK = 16
WORDS = 8


def _marks(key: Column) -> list[Column]:
    """The bit of a key in each word of its block."""
    g = F.xxhash64(key, F.lit(1))
    bit = lambda i: F.shiftrightunsigned(g, 6 * i).bitwiseAND(F.lit(63)).cast("int")
    return [F.call_function("shiftleft", F.lit(1).cast("long"), bit(i)).alias(f"m{i}") for i in range(WORDS)]


def _block(key: Column, size: Column) -> Column:
    return F.xxhash64(key).bitwiseAND(size - 1)


def key_ranges(rows: DataFrame, key: str, date: str) -> DataFrame:
    """(date, keys, low, high, size): size is the number of blocks, a power of two."""
    n = F.count(F.col(key))
    size = F.pow(F.lit(2.0), F.greatest(F.lit(0.0), F.ceil(F.log2(n / F.lit(float(PER_BLOCK)))).cast("double"))).cast("long")
    return (rows.where(F.col(key).isNotNull()).groupBy(date)
            .agg(n.alias("keys"), F.min(key).alias("low"), F.max(key).alias("high"), size.alias("size")))


def write_filters(spark: SparkSession, rows: DataFrame, folder: str, dates: list, key: str = "event_id",
                  date: str = "event_date") -> None:
    """Replace the filters of ``dates`` by those of ``rows``, which hold all of their rows."""
    ranges = key_ranges(rows, key, date)
    blocks = (rows.where(F.col(key).isNotNull()).join(ranges.select(date, "size"), date)
              .select(date, "size", _block(F.col(key), F.col("size")).alias("block"), *_marks(F.col(key)))
              .groupBy(date, "size", "block").agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(WORDS)]))
    for name, table in (("blocks", blocks), ("ranges", ranges)):  # a date with a range has its blocks
        (table.hint("rebalance", date).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(date).parquet(f"{folder}/{name}"))
    held = {r[0] for r in ranges.select(date).distinct().collect()}
    for d in dates:
        if d not in held:
            for name in ("ranges", "blocks"):
                delete_path(spark, f"{folder}/{name}/{date}={d}")


def dates_of(spark: SparkSession, table: str, date: str = "event_date") -> list[str]:
    """The date partitions of a stored table, from its folders."""
    return sorted(n.split("=", 1)[1] for n in children(spark, table) if n.startswith(f"{date}="))


def dates_that_may_hold(spark: SparkSession, keys: DataFrame, table: str, folder: str, key: str = "event_id",
                        date: str = "event_date") -> list[str]:
    """Dates of ``table`` that may hold one of ``keys``: those whose filter is hit or that have none."""
    all_dates = dates_of(spark, table, date)
    if not path_exists(spark, f"{folder}/ranges"):
        return all_dates
    spread = keys.agg(F.min(key), F.max(key)).first()
    if spread[0] is None:
        return []
    ranges = spark.read.parquet(f"{folder}/ranges").select(F.col(date).cast("string").alias("d"), "low", "high", "size")
    known = {r.d: r for r in ranges.collect()}  # one row per date
    near = [d for d in all_dates if d in known and known[d]["low"] <= spread[1] and known[d]["high"] >= spread[0]]
    found = [d for d in all_dates if d not in known]
    if near:
        sizes = sorted({known[d]["size"] for d in near})
        looked = (keys.select(key).where(F.col(key).isNotNull()).distinct()
                  .select(key, F.explode(F.array(*[F.lit(s).cast("long") for s in sizes])).alias("size"))
                  .select("size", _block(F.col(key), F.col("size")).alias("block"), *_marks(F.col(key))))
        blocks = spark.read.parquet(f"{folder}/blocks").where(F.col(date).cast("string").isin(near))
        hit = F.lit(True)
        for i in range(WORDS):
            hit = hit & (F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) != 0)
        met = looked.join(blocks, ["size", "block"]).where(hit).select(F.col(date).cast("string").alias("d")).distinct()
        found += [r.d for r in met.collect()]
    return sorted(found)
