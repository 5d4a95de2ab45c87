"""Joins and intermediate tables the operators share."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from histload.names import quoted
from histload.session import scratch_path, shared_folder

SHARES = 1000  # keys with more than one in so many rows are joined apart; there are fewer of them
BROADCAST_BYTES = 32 << 20
ARROW_SETTING, ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def small_arrow_batches(spark: SparkSession) -> None:
    """Let Python get ARROW_ROWS rows at a time from now on: texts are long, and Spark's usual 10,000
    of them take hundreds of MB in the JVM and in Python. A smaller setting of the session stays."""
    rows = int(spark.conf.get(ARROW_SETTING))
    if rows <= 0 or rows > ARROW_ROWS:
        spark.conf.set(ARROW_SETTING, ARROW_ROWS)


def local_rows(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A few ``rows`` of the driver as a table. They go as Arrow: from plain Python rows, Spark makes a table by
    Python workers of their own kind, which executors keep beside those of the operators."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    columns = [pa.array([row[n] for row in rows], field.type) for n, field in enumerate(schema)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=schema), ddl)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: computed once, safe to lose tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    shared_folder(df.sparkSession)
    return df.checkpoint()


def checkpointed_with(df: DataFrame, **sums: Column) -> tuple[DataFrame, dict[str, int]]:
    """``df`` checkpointed, and aggregates of its rows that are taken as they are written, without a shuffle."""
    seen = Observation()
    rows = checkpointed(df.observe(seen, *(column.alias(name) for name, column in sums.items())))
    return rows, seen.get


def lookup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    rows: Column,
    total: int,
    how: str = "left",
) -> DataFrame:
    """``left`` joined (left or inner) with ``right``, which has one row per key and no large values.

    ``rows`` is an expression over ``right``: rows of ``left`` with that key; ``total`` the sum.
    Keys with over 1 / SHARES of the rows are fewer than SHARES; they are broadcast, so their
    rows stay where they are. The others are joined by shuffle. ``right`` is read three times.
    """
    limit = max(total // SHARES, 1000)
    names = list(keys)
    heavy = right.where(rows > limit)
    light = right.where(~(rows > limit) | rows.isNull())
    if total <= limit or heavy.isEmpty():
        return left.join(right, names, how)
    marked = F.broadcast(heavy.withColumn("__heavy", F.lit(True)))
    first = left.join(marked, names, "left")
    out = [*left.columns, *(c for c in right.columns if c not in names)]
    done = first.where(F.col("__heavy")).select(*out)
    rest = left.join(F.broadcast(heavy.select(*names)), names, "left_anti")
    return done.unionByName(rest.join(light, names, how).select(*out))


def byte_size(df: DataFrame, width: Column) -> int:
    """Sum of ``width`` over the rows: what a broadcast of them would hold, counted first."""
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("n")).first()["n"]


def maybe_broadcast(df: DataFrame, size: int) -> DataFrame:
    """Broadcast ``df`` if its counted size allows it; else left to a join by shuffle."""
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def with_row_id(df: DataFrame, name: str, row_id: str = "row_id") -> DataFrame:
    """``df`` written to the shared folder with a number of each row, which tells the writing task."""
    return stored(df.withColumn(row_id, F.monotonically_increasing_id()), name)


def with_repeat(rows: DataFrame, keys: Sequence[str], name: str, row_id: str = "row_id") -> DataFrame:
    """``rows`` of ``with_row_id`` with ``name``: 0, 1, ... among the rows of equal ``keys`` (NULL equals NULL).

    Rows are numbered inside each task's part of the table, which is bounded, and the counts of earlier
    parts are added; so no task meets all rows of one key, however many it has.
    """
    part = F.shiftright(row_id, 33).alias("__repeat_part")  # the writing task, by Spark's definition of the number
    rows = rows.withColumn("__repeat_part", part)
    keyed = {f"__repeat_{n}": F.col(key) for n, key in enumerate(keys)}
    counts = rows.groupBy("__repeat_part", *(column.alias(n) for n, column in keyed.items())).agg(
        F.count(F.lit(1)).alias("__repeat_rows")
    )
    before = Window.partitionBy(*keyed).orderBy("__repeat_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__repeat_before", F.coalesce(F.sum("__repeat_rows").over(before), F.lit(0)))
    counts = stored(counts.where(F.col("__repeat_before") > 0).drop("__repeat_rows"), "repeats")
    width = F.lit(64)
    for column in keyed:
        width = width + F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0))
    inside = Window.partitionBy("__repeat_part", *keys).orderBy(row_id)
    numbered = rows.withColumn("__repeat_place", F.row_number().over(inside) - 1)
    same = numbered["__repeat_part"] == counts["__repeat_part"]
    for n, key in enumerate(keys):
        same &= numbered[key].eqNullSafe(counts[f"__repeat_{n}"])
    joined = numbered.join(maybe_broadcast(counts, byte_size(counts, width)), same, "left")
    number = F.col("__repeat_place") + F.coalesce("__repeat_before", F.lit(0))
    return joined.select(*(numbered[quoted(c)] for c in rows.columns if c != "__repeat_part"), number.cast("long").alias(name))
