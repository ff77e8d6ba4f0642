"""Repeatable pseudo-random draws from a hash of (seed, field, id).

``rand(seed)`` depends on partitioning; a hash of the row key does not, so a
synthetic table is the same on 1 or 1000 executors and after task retries.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digest(seed: int, field: str, key: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(field), key.cast("string")))


def uniform_draw(seed: int, field: str, key: Column) -> Column:
    """Uniform double in [0, 1) from the first 32 bits of an MD5."""
    bits = F.conv(F.substring(_digest(seed, field, key), 1, 8), 16, 10).cast("bigint")
    return bits / F.lit(4294967296.0)


def uuid_from_hash(seed: int, key: Column) -> Column:
    """An MD5 laid out as a UUID string (8-4-4-4-12)."""
    h = _digest(seed, "event_id", key)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4),
                       F.substring(h, 13, 4), F.substring(h, 17, 4),
                       F.substring(h, 21, 12))
