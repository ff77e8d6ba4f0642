"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.session import materialize, scratch_path

__all__ = ["fresh", "materialize", "numbered", "read", "release", "scratch_path", "tasks", "text_hash", "word_count"]


def read(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, one for each of ``names``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def tasks(spark: SparkSession) -> int:
    """The number of shuffle partitions the session is sized for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_hash(text: str | Column) -> Column:
    """64-bit hash of a whole text; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def word_count(text: str | Column) -> Column:
    """Words (runs other than space and 0x09-0x0D) of a text; null has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def numbered(df: DataFrame, name: str, column: str) -> DataFrame:
    """``df`` written once with a unique long per row: the stored numbers hold
    for every later read, also after executors are lost."""
    return materialize(df.withColumn(column, F.monotonically_increasing_id()), name)


def release(spark: SparkSession) -> None:
    """Let the driver go of finished work. Spark frees broadcasts, shuffle files
    and plans once their handles are collected, which a driver with a small
    heap full of short plans does late: first Python's references, then the JVM's."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
