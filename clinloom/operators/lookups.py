"""Joins of a large table to a lookup side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup side is sent to every executor only below this size.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024

_WIDTH = {T.StringType: 48, T.ArrayType: 256, T.MapType: 256, T.StructType: 128}


def estimated_bytes(df: DataFrame, rows: int) -> int:
    return rows * sum(16 + _WIDTH.get(type(field.dataType), 8) for field in df.schema.fields)


def fits(df: DataFrame, rows: int) -> bool:
    return estimated_bytes(df, rows) <= BROADCAST_LIMIT_BYTES


def spread(key: Column, *others: Column | str) -> Column:
    """A join key whose NULLs, which match nothing, go to many partitions instead of one."""
    return F.coalesce(key, F.concat(F.lit("\0"), F.pmod(F.xxhash64(*others), F.lit(1024)).cast("string")))


def lookup_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if its counted rows fit the limit.

    Beyond the limit it stays a plain join side: both sides are then shuffled
    on the key and adaptive execution splits a hot key over several tasks.
    """
    return F.broadcast(df) if fits(df, rows) else df
