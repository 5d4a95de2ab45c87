"""Row-to-row lookups along each key's order, safe for keys that hold a large share of the rows.

A plain window puts all rows of one key in one task. Keys above a row limit are therefore cut
into slices: their rows are range-partitioned by (key, order) into RANGES ranges at most, whose borders
the driver draws from a sample; every range is cut into slices where it lies, and the
window runs per (key, slice). What a slice's first or last row needs from the neighbouring slice
comes from a small table with one row per (key, slice). Other keys take the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histload.names import quoted
from histload.operators.skew import HotKeys, split_hot
from histload.session import shared_folder

SLICE, COPY, ROW = "__slice", "__copy", "__row"
NOT_SLICED = -1
# Of all hot keys together. The driver samples some rows of each and hears of each task that reads one.
RANGES = 500


@dataclass(frozen=True)
class OrderedRows:
    """Rows with a total order inside each key (up to rows that are equal in every column)."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    sliced: bool = False

    def where(self, condition: Column) -> OrderedRows:
        return replace(self, df=self.df.where(condition))

    def with_next(self, out: str, value: str) -> OrderedRows:
        """``out`` = ``value`` of the key's next row, NULL on its last row."""
        return self._looked_up(out, value, F.lead, F.min_by)

    def with_previous(self, out: str, value: str) -> OrderedRows:
        """``out`` = ``value`` of the key's previous row, NULL on its first row."""
        return self._looked_up(out, value, F.lag, F.max_by)

    def with_first(self, out: str, value: str) -> OrderedRows:
        """``out`` = ``value`` of the key's first row."""
        return self._looked_up(out, value, F.first, F.min_by)

    def result(self) -> DataFrame:
        return self.df.drop(SLICE, COPY, ROW)

    def _looked_up(self, out, value, function, edge) -> OrderedRows:
        """``function`` along the order of each key; for cut keys first along each slice, then
        along the slices, over the value at the ``edge`` of every slice."""
        keys = [quoted(key) for key in self.keys]
        parts = [*keys, SLICE] if self.sliced else keys

        def along(column: Column | str, partition: list[str], order: Sequence[str]) -> Column:
            window = Window.partitionBy(*partition).orderBy(*map(quoted, order))
            if function is F.first:
                window = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            return function(column).over(window)

        if not self.sliced:
            df = self.df.withColumn(out, along(quoted(value), parts, self.order))
            return replace(self, df=df)
        # Boxed, so that "no such row" and "that row's value is NULL" stay apart.
        boxed = F.struct(F.col(quoted(value)).alias("value"))
        slices = (
            self.df.where(F.col(SLICE) != NOT_SLICED)
            .groupBy(*parts)
            .agg(edge(boxed, F.struct(*map(quoted, self.order))).alias("__edge"))
        )
        edges = slices.withColumn("__edge", along("__edge", keys, [SLICE]))
        df = self.df.withColumn(out, along(boxed, parts, self.order))
        df = self._from_small(df, edges, (*self.keys, SLICE))
        # The next or previous row is in the slice itself if it can be; the first row never is,
        # unless the slice is the key's first.
        found = ["__edge", out] if function is F.first else [out, "__edge"]
        df = df.withColumn(out, F.coalesce(*found)["value"]).drop("__edge")
        return replace(self, df=df)

    @staticmethod
    def _from_small(df: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Left join with a table of at most one row per hot key and slice (see HotKeys)."""
        renamed = small.withColumnsRenamed({key: f"__edge_{key}" for key in keys})
        condition = F.lit(True)
        for key in keys:
            condition &= F.col(quoted(key)).eqNullSafe(F.col(quoted(f"__edge_{key}")))
        joined = df.join(F.broadcast(renamed), condition, "left")
        return joined.drop(*[f"__edge_{key}" for key in keys])


def ordered_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    hot: HotKeys,
    helpers: Sequence[str] = (),
) -> OrderedRows:
    """Bring ``df`` into order per key, cutting the ``hot`` keys into slices.

    A hash of the whole row (but for ``helpers``, columns that are not part of it) ends the
    order, so that a task that runs again, or a second pass over the rows, gives tied rows the
    same neighbours.
    """
    content = [quoted(name) for name in df.columns if name not in helpers]
    rows = df.withColumn(ROW, F.xxhash64(*content))
    order = (*order, ROW)
    if not hot.rows:
        return OrderedRows(rows, tuple(keys), order)

    # The copy number lets even equal rows fall into different slices. The checkpoint fixes it
    # and the slice borders for everything that reads the rows afterwards.
    shared_folder(df.sparkSession)
    others, hot_rows = split_hot(rows, keys, hot)
    order = (*order, COPY)
    ranges = min(hot.slices, RANGES)
    by = [*map(quoted, (*keys, *order))]
    slices = hot_rows.withColumn(COPY, F.monotonically_increasing_id()).repartitionByRange(ranges, *by)
    if hot.slices > ranges:
        # Rows of a range in order: its number, and the row's place in it above the limit of a slice.
        place = F.monotonically_increasing_id()
        inside = F.floor(place.bitwiseAND(2**33 - 1) / hot.limit)
        slices = slices.sortWithinPartitions(*by).withColumn(
            SLICE, F.spark_partition_id().cast("long") * 2**33 + inside
        )
    else:
        slices = slices.withColumn(SLICE, F.spark_partition_id().cast("long"))
    slices = slices.checkpoint()
    others = others.withColumn(COPY, F.lit(0).cast("long")).withColumn(SLICE, F.lit(NOT_SLICED).cast("long"))
    return OrderedRows(others.unionByName(slices), tuple(keys), order, sliced=True)
