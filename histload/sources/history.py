"""History tables on plain partitioned Parquet.

Every load writes one folder, ``<table>/history_load=<id>/history_state=<open|closed>/<load date>=<date>``:
all rows open after the load, and the rows closed in it. Nothing written before is touched, so
a failed load leaves only a folder no reader asks for. The table after some loads is the open
rows of the last one and the closed rows of all of them; which loads count is told by the step
log. A load costs the open rows and the batch, however long the history is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from histload.names import (
    DEFAULT_PARTITION,
    END,
    HASH_DATA,
    HASH_KEY,
    LOAD_FOLDER,
    START,
    STATE_FOLDER,
    quoted,
)

LOAD, STATE, OPEN, CLOSED = LOAD_FOLDER, STATE_FOLDER, "open", "closed"
# Loads of this ending hold differences; their columns are told by the state CONTRACT (``differences``).
DIFFERENCE, CONTRACT = "-difference", "contract"


# What a column may change to: older files are then read as the new type.
WIDENINGS = {
    ("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("tinyint", "double"),
    ("smallint", "int"), ("smallint", "bigint"), ("smallint", "double"),
    ("int", "bigint"), ("int", "double"), ("float", "double"),
}


@dataclass
class TableShape:
    """Column types, key and load-date column of a table, as far as they are known.

    Files are checked in order; one that fits adds to what is known.
    """

    types: dict[str, str] = field(default_factory=dict)
    partition_col: str | None = None
    key_col: str | None = None

    def copy(self) -> TableShape:
        return TableShape(dict(self.types), self.partition_col, self.key_col)

    def misfit(self, feed) -> str | None:
        """Why a batch with this feed's columns cannot be merged; None if it can. A column may be
        new, of the same type, or of one that WIDENINGS allows, in either direction."""
        if self.partition_col not in (None, feed.partition_col):
            return f"the table's load-date column is {self.partition_col}, not {feed.partition_col}"
        if self.key_col not in (None, feed.key_col):
            return f"the table's key is {self.key_col}, not {feed.key_col}"
        if self.types and feed.key_col not in self.types:
            return f"the table has no key column {feed.key_col}"
        own = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(feed.schema_ddl)}
        own |= {HASH_KEY: "string", HASH_DATA: "string"}
        if feed.defining_col in own:
            own |= dict.fromkeys((START, END), own[feed.defining_col])
        wider = {}
        for name, kind in own.items():
            known = self.types.get(name, kind)
            if known != kind and not {(known, kind), (kind, known)} & WIDENINGS:
                return f"column {name} is {kind} in the batch, {known} in the table"
            wider[name] = kind if (known, kind) in WIDENINGS else known
        self.types |= wider
        self.partition_col, self.key_col = feed.partition_col, feed.key_col
        return None


def table_shape(spark: SparkSession, path: str, load_id: str) -> TableShape:
    """The shape of a table after a load, from its files' schema; its key is not recorded there."""
    state = CONTRACT if is_difference(load_id) else OPEN
    folder = f"{load_path(path, load_id)}/{STATE}={state}"
    stored = spark.read.parquet(folder)
    partitions = [name for name in stored.columns if name not in _file_columns(spark, folder)]
    types = {f.name: f.dataType.simpleString() for f in stored.schema if f.name not in partitions}
    return TableShape(types, partitions[0] if partitions else None)


def _file_columns(spark: SparkSession, folder: str) -> list[str]:
    """Columns inside the files of a folder, without those in the folders' names."""
    return spark.read.option("recursiveFileLookup", True).parquet(folder).columns


def append_evolving(df: DataFrame, path: str, partition_col: str = DEFAULT_PARTITION) -> None:
    """Append to a partitioned table; the rows may have columns the table lacks so far."""
    df.write.mode("append").partitionBy(partition_col).parquet(path)


def read_evolving(
    spark: SparkSession, path: str, partition_col: str = DEFAULT_PARTITION
) -> DataFrame:
    """A table of ``append_evolving``: all columns ever written, NULL where a row had none."""
    merged = spark.read.option("mergeSchema", True).parquet(path).schema
    return spark.read.schema(as_text(merged, partition_col)).parquet(path)


def as_text(schema: StructType, *names: str) -> StructType:
    """Partition values stay text; Spark would read them back as dates or numbers."""
    return StructType(
        [
            StructField(field.name, StringType()) if field.name in names else field
            for field in schema
        ]
    )


def write_load(
    rows: DataFrame,
    path: str,
    load_id: str,
    partition_col: str = DEFAULT_PARTITION,
    many_dates: bool = False,
) -> None:
    """Write what a load leaves, open and closed rows in one job.

    Former open rows keep the date they arrived on. With ``many_dates`` the rows are gathered per
    date first - AQE splits large dates and joins small ones - so that the number of files does
    not grow with tasks times dates.
    """
    rows = _with_state(rows)
    if many_dates:
        rows = _gathered(rows, partition_col)
    rows.write.partitionBy(STATE, partition_col).parquet(load_path(path, load_id))


def write_parts(
    kept: DataFrame,
    moved: DataFrame,
    path: str,
    load_id: str,
    partition_col: str = DEFAULT_PARTITION,
) -> None:
    """Write the parts of ``merge_parts`` or ``fold_parts`` of a small batch.

    The first part, of the former open rows, comes straight from the files of the last load, where they lie together by date,
    and is written as it comes; only the rows of the second are gathered.
    """
    moved = _gathered(_with_state(moved), partition_col)
    rows = _with_state(kept).unionByName(moved, allowMissingColumns=True)
    rows.write.partitionBy(STATE, partition_col).parquet(load_path(path, load_id))


def _gathered(rows: DataFrame, partition_col: str) -> DataFrame:
    return rows.hint("rebalance", F.col(STATE), F.col(quoted(partition_col)))


def _with_state(rows: DataFrame) -> DataFrame:
    state = F.when(F.col(END).isNull(), F.lit(OPEN)).otherwise(F.lit(CLOSED))
    return rows.withColumn(STATE, state)


def is_difference(load_id: str) -> bool:
    return load_id.endswith(DIFFERENCE)


def load_path(path: str, load_id: str) -> str:
    return f"{path.rstrip('/')}/{LOAD}={load_id}"


def read_open(
    spark: SparkSession, path: str, load_id: str, partition_col: str = DEFAULT_PARTITION
) -> DataFrame:
    """The open rows after one load."""
    folder = f"{load_path(path, load_id)}/{STATE}={OPEN}"
    # Each load carries the former open rows along, so its files have every column so far.
    schema = as_text(spark.read.parquet(folder).schema, partition_col)
    return spark.read.schema(schema).parquet(folder)


def read_history(
    spark: SparkSession,
    path: str,
    loads: Sequence[str],
    partition_col: str = DEFAULT_PARTITION,
) -> DataFrame:
    """Open and closed rows after ``loads``, given oldest first."""
    current = read_open(spark, path, loads[-1], partition_col)
    places = [StructField(STATE, StringType()), StructField(LOAD, StringType())]
    schema = StructType([*current.schema.fields, *places])
    rows = (
        spark.read.schema(schema)
        .option("basePath", path)
        .parquet(*[load_path(path, load_id) for load_id in loads])
    )
    wanted = (F.col(STATE) == CLOSED) | (F.col(LOAD) == loads[-1])
    return rows.where(wanted).select(*map(quoted, current.columns))
