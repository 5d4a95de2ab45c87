"""Keys that hold a large share of the rows: found by counting, then treated apart."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histload.names import quoted

ROWS = "__rows"  # row counts; a name no data column has
ROWS_PER_SLICE = 2_000_000
MAX_SLICES = 10_000
# A batch's keys, with one hash and one date each, are broadcast up to this many rows and bytes.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 256 * 1024 * 1024
BYTES_BESIDE_KEY = 200


@dataclass(frozen=True)
class HotKeys:
    """Keys with more than ``limit`` rows; at most ``max_slices`` of them, by choice of the limit."""

    rows: list[Row]
    limit: int
    total: int | None = None  # rows of all keys, if they were counted
    widest: int = 0  # bytes of the longest key as text
    broadcast_rows: int | None = None  # BROADCAST_ROWS and BROADCAST_BYTES if not given
    broadcast_bytes: int | None = None

    @property
    def slices(self) -> int:
        return sum(ceil(row[ROWS] / self.limit) for row in self.rows)

    @property
    def small(self) -> bool:
        """Whether one narrow row per batch row is known to fit a broadcast."""
        rows = BROADCAST_ROWS if self.broadcast_rows is None else self.broadcast_rows
        size = BROADCAST_BYTES if self.broadcast_bytes is None else self.broadcast_bytes
        if self.total is None or self.total > rows:
            return False
        return self.total * (self.widest + BYTES_BESIDE_KEY) <= size


UNIQUE_KEYS = HotKeys([], ROWS_PER_SLICE)  # for rows known to be unique by key: nothing to count


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias(ROWS))


def find_hot_keys(
    sizes: DataFrame,
    rows_per_slice: int = ROWS_PER_SLICE,
    max_slices: int = MAX_SLICES,
    broadcast_rows: int | None = None,
    broadcast_bytes: int | None = None,
) -> HotKeys:
    """Hot keys from a table of (key columns, ``__rows``). One small job, a second one if there are any.

    The list of hot keys passes through the driver. It is kept to ``max_slices`` keys: if the rows
    are so many that ``rows_per_slice`` could give more, slices are larger, and a warning says so.
    """
    keys = [F.col(quoted(name)).cast("string") for name in sizes.columns if name != ROWS]
    width = F.octet_length(F.concat_ws("", *keys))
    total, largest, widest = sizes.agg(F.sum(ROWS), F.max(ROWS), F.max(width)).first()
    if largest is None or largest <= rows_per_slice:
        return HotKeys([], rows_per_slice, total or 0, widest or 0, broadcast_rows, broadcast_bytes)
    # Fewer than max_slices keys can each hold more than total / max_slices rows.
    limit = max(rows_per_slice, total // max_slices)
    if limit > rows_per_slice:
        warnings.warn(
            f"{total} rows: slices of {limit} rows instead of {rows_per_slice}; raise max_slices"
            f" (now {max_slices}) for smaller ones",
            stacklevel=2,
        )
    hot = sizes.where(F.col(ROWS) > limit).collect()
    return HotKeys(hot, limit, total, widest, broadcast_rows, broadcast_bytes)


def split_hot(df: DataFrame, keys: Sequence[str], hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """(rows of the other keys, rows of the hot keys)."""
    schema = T.StructType([T.StructField(key, df.schema[key].dataType) for key in keys])
    values = [tuple(row[key] for key in keys) for row in hot.rows]
    hot_keys = df.sparkSession.createDataFrame(values, schema).withColumnsRenamed(
        {key: f"__hot_{key}" for key in keys}
    )
    same_key = F.lit(True)
    for key in keys:
        same_key &= F.col(quoted(key)).eqNullSafe(F.col(quoted(f"__hot_{key}")))
    hot_keys = F.broadcast(hot_keys)  # at most MAX_SLICES rows
    return df.join(hot_keys, same_key, "left_anti"), df.join(hot_keys, same_key, "left_semi")


def join_on_key(
    left: DataFrame, right: DataFrame, key: str, right_key: str, how: str, hot: HotKeys
) -> DataFrame:
    """``left`` joined ``how`` (inner or left) with ``right``, which has few rows per key.

    Rows of hot keys are joined on their own, with what little of ``right`` has these keys: a
    side that small is broadcast, so the hot rows stay where they are.
    """
    on_key = F.col(quoted(key)) == F.col(quoted(right_key))
    if not hot.rows:
        return left.join(right, on_key, how)
    others, hot_rows = split_hot(left, [key], hot)
    renamed = HotKeys(
        [Row(**{right_key: row[key], ROWS: row[ROWS]}) for row in hot.rows], hot.limit
    )
    _, of_hot_keys = split_hot(right, [right_key], renamed)
    if of_hot_keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        of_hot_keys = F.broadcast(of_hot_keys)
    return others.join(right, on_key, how).unionByName(hot_rows.join(of_hot_keys, on_key, how))
