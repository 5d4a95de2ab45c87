"""Loads that write what they change: new rows, and narrow closings of rows that are already there.

A difference load is a load folder like any other (see ``history``), whose name ends in ``-difference``:

* ``history_state=open`` and ``=closed`` hold the rows it brings, open or closed already,
* ``history_state=closing`` names rows it closes: key, data hash and end date, all else NULL,
* ``history_state=contract`` is one row of NULLs whose file has all columns of the table and their types.

A closing ends every open row of its key and data hash that an earlier load brought. Readers join the closings
of the loads since the last full one (the base) with the rows since then; there are at most as many closings a row as
loads, and the first that is later than the row counts. ``rebase_rows`` gives what the next full load has to
carry, so that readers start from it again. A load thus costs its batch, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from histload.names import DEFAULT_PARTITION, END, HASH_DATA, quoted
from histload.operators.scd2 import PRIOR_ROW
from histload.operators.skew import BROADCAST_BYTES, BROADCAST_ROWS, BYTES_BESIDE_KEY
from histload.sources.history import (
    CLOSED,
    CONTRACT,
    LOAD,
    OPEN,
    STATE,
    as_text,
    is_difference,
    load_path,
    read_history,
    read_open,
    write_load,
)

CLOSING = "closing"
_AT = "__at"


def since_base(loads: Sequence[str]) -> list[str]:
    """The last full load and the difference loads after it; ``loads`` are given oldest first."""
    full = [n for n, load_id in enumerate(loads) if not is_difference(load_id)]
    return list(loads[full[-1] :])


def table_schema(
    spark: SparkSession, path: str, load_id: str, partition_col: str = DEFAULT_PARTITION
) -> StructType:
    """All columns of the table after a load, from one folder of this load."""
    state = CONTRACT if is_difference(load_id) else OPEN
    return as_text(spark.read.parquet(f"{load_path(path, load_id)}/{STATE}={state}").schema, partition_col)


def _rows(spark, path, loads, schema) -> DataFrame:
    """The files of some loads, with state and load of each row."""
    places = [StructField(STATE, StringType()), StructField(LOAD, StringType())]
    return (
        spark.read.schema(StructType([*schema.fields, *places]))
        .option("basePath", path)
        .parquet(*[load_path(path, load_id) for load_id in loads])
    )


def _versions(spark, path, chain, key, partition_col) -> DataFrame:
    """Rows that were open at some time since the base, with the end date that a closing gave them."""
    schema = table_schema(spark, path, chain[-1], partition_col)
    rows = _rows(spark, path, chain, schema)
    numbers = F.create_map(*[F.lit(x) for n, load_id in enumerate(chain) for x in (load_id, n)])
    rows = rows.withColumn(_AT, F.element_at(numbers, F.col(LOAD)))
    closings = rows.where(F.col(STATE) == CLOSING).groupBy(
        F.col(quoted(key)).alias("__key"), F.col(HASH_DATA).alias("__hash")
    )
    # One closing a load at most, so the lists are no longer than the chain.
    closings = closings.agg(F.collect_list(F.struct(F.col(_AT), F.col(END).alias("__end"))).alias("__closings"))
    width = F.octet_length(F.col("__key").cast("string")) + F.lit(BYTES_BESIDE_KEY) * F.size("__closings")
    count, size = closings.agg(F.count(F.lit(1)), F.sum(width)).first()
    if count <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES:
        closings = F.broadcast(closings)
    own = (F.col(quoted(key)) == F.col("__key")) & (F.col(HASH_DATA) == F.col("__hash"))
    later = F.array_min(F.filter("__closings", lambda closing: closing[_AT] > F.col(_AT)))
    return (
        rows.where(F.col(STATE) == OPEN)
        .join(closings, own, "left")
        .withColumn(END, F.coalesce(later["__end"], F.col(END)))
        .select(*map(quoted, schema.names))
    )


def read_open_rows(
    spark: SparkSession, path: str, loads: Sequence[str], key: str, partition_col: str = DEFAULT_PARTITION
) -> DataFrame:
    """The open rows after ``loads``, which may be difference loads."""
    chain = since_base(loads)
    if len(chain) == 1:
        return read_open(spark, path, chain[0], partition_col)
    return _versions(spark, path, chain, key, partition_col).where(F.col(END).isNull())


def rebase_rows(
    spark: SparkSession, path: str, loads: Sequence[str], key: str, partition_col: str = DEFAULT_PARTITION
) -> DataFrame | None:
    """Rows that closings since the base ended: a full load writes them among its closed rows. None if
    the last load is full."""
    chain = since_base(loads)
    if len(chain) == 1:
        return None
    return _versions(spark, path, chain, key, partition_col).where(F.col(END).isNotNull())


def read_table(
    spark: SparkSession, path: str, loads: Sequence[str], key: str, partition_col: str = DEFAULT_PARTITION
) -> DataFrame:
    """Open and closed rows after ``loads``, of any kind, given oldest first."""
    chain = since_base(loads)
    if len(chain) == 1:
        return read_history(spark, path, loads, partition_col)
    schema = table_schema(spark, path, chain[-1], partition_col)
    closed = _rows(spark, path, loads, schema).where(F.col(STATE) == CLOSED)
    return closed.select(*map(quoted, schema.names)).unionByName(_versions(spark, path, chain, key, partition_col))


def write_difference(
    changes: DataFrame,
    path: str,
    load_id: str,
    key: str,
    table: StructType,
    partition_col: str = DEFAULT_PARTITION,
) -> None:
    """Write ``changes`` in one job: new rows, and rows with PRIOR_ROW set, of which key, data hash and end
    date are kept. ``table``: the columns of the table so far; ``changes`` may have others."""
    prior = F.col(PRIOR_ROW)
    changes = changes.where(~prior | F.col(END).isNotNull())
    kept = {key, HASH_DATA, END}
    columns = [
        F.col(quoted(f.name)) if f.name in kept else F.when(~prior, F.col(quoted(f.name))).alias(f.name)
        for f in changes.schema
        if f.name != PRIOR_ROW
    ]
    ended = F.when(F.col(END).isNull(), F.lit(OPEN)).otherwise(F.lit(CLOSED))
    state = F.when(prior, F.lit(CLOSING)).otherwise(ended)
    rows = changes.select(*columns, state.alias(STATE)).hint("rebalance", F.col(STATE))
    nothing = changes.sparkSession.createDataFrame([(None,) * len(table)], _nullable(table))
    contract = nothing.withColumn(STATE, F.lit(CONTRACT))
    both = contract.unionByName(rows, allowMissingColumns=True)
    both.write.partitionBy(STATE, partition_col).parquet(load_path(path, load_id))


def _nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType, True) for f in schema])


def rebase(
    spark: SparkSession,
    path: str,
    loads: Sequence[str],
    load_id: str,
    key: str,
    partition_col: str = DEFAULT_PARTITION,
) -> None:
    """A full load of what is open after ``loads``, without new rows: readers start from it."""
    chain = since_base(loads)
    if len(chain) == 1:
        rows = read_open(spark, path, chain[0], partition_col)
    else:
        rows = _versions(spark, path, chain, key, partition_col)
    write_load(rows, path, load_id, partition_col, many_dates=True)
