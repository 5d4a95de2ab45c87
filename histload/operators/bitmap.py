"""Bits of hashed keys: which rows cannot have a key of another table, told where they are read.

The bits are kept as 64 a row (``word``, ``bits``). Their number grows with the keys up to MOST_BITS, so what is
broadcast is at most MOST_BITS / 64 rows, however large the other table is. A set bit may be another key's:
rows that pass have to be joined; rows that do not pass have no partner for certain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from histload.names import quoted

BITS_PER_KEY = 16
LEAST_BITS, MOST_BITS = 1 << 12, 1 << 26  # a million rows of two numbers at most


def common_type(left: DataFrame, right: DataFrame, key: str) -> DataType:
    """The type both tables' keys are compared in; equal keys of other types hash differently."""
    return left.select(quoted(key)).union(right.select(quoted(key))).schema[0].dataType


def bits_for(keys: int) -> int:
    """The number of bits for so many keys, a power of two."""
    wanted = max(LEAST_BITS, min(MOST_BITS, BITS_PER_KEY * max(1, keys)))
    return 1 << (wanted - 1).bit_length()


def _place(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def key_bits(df: DataFrame, key: str, kind: DataType, bits: int) -> DataFrame:
    """(``__word``, ``__bits``): the bits of all keys of ``df``; combined before the shuffle."""
    keys = df.where(F.col(quoted(key)).isNotNull())
    places = keys.select(_place(F.col(quoted(key)).cast(kind), bits).alias("place"))
    marked = places.select(
        F.shiftright("place", 6).alias("__word"), F.expr("shiftleft(1L, int(place & 63))").alias("bit")
    )
    return marked.groupBy("__word").agg(F.bit_or("bit").alias("__bits"))


def with_may_match(df: DataFrame, bits: DataFrame, key: str, kind: DataType, size: int, name: str) -> DataFrame:
    """``df`` with a flag ``name``: false where no key of the table of ``bits`` is the row's. No shuffle."""
    marked = df.withColumn("__place", _place(F.col(quoted(key)).cast(kind), size))
    marked = marked.join(F.broadcast(bits), F.shiftright("__place", 6) == F.col("__word"), "left")
    is_set = F.expr("shiftrightunsigned(__bits, int(__place & 63)) & 1 = 1")
    flag = F.col(quoted(key)).isNotNull() & F.coalesce(is_set, F.lit(False))
    return marked.withColumn(name, flag).drop("__place", "__word", "__bits")
