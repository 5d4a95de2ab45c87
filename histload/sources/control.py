"""Control tables: which files wait to be loaded, and the log of load steps.

The step log is append-only: a step is one row when it starts and another when it ends, and the
newest row of a ``step_id`` is its current state.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histload.names import (
    DONE,
    DONE_DETAIL,
    ERROR,
    IN_PROGRESS,
    NEVER,
    RUNNING_DETAIL,
    STEP_LOAD,
    STEP_REGISTRATION,
    SUCCESS,
    quoted,
)

FILE_LOG = "file_process_log"
STEP_LOG = "file_process_step_log"
FEEDS = "file_pattern_detail"
COLUMNS = "delimited_col_detail"
WRITER = "histload"

# The last two columns are additions: they tell which load folder of which table a step wrote.
STEP_LOG_SCHEMA = (
    "step_id string, file_process_id bigint, step_name string, step_status string, "
    "step_status_detail string, step_start_ts timestamp, step_end_ts timestamp, "
    "upsert_by string, upsert_ts timestamp, target_path string, load_id string"
)


class ControlStore(Protocol):
    def table(self, name: str) -> DataFrame: ...

    def append(self, name: str, rows: DataFrame) -> None: ...


@dataclass(frozen=True)
class FolderControl:
    """Control tables as Parquet folders ``<root>/<table>``."""

    spark: SparkSession
    root: str

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name == STEP_LOG:
            reader = reader.schema(STEP_LOG_SCHEMA)
        return reader.parquet(f"{self.root}/{name}")

    def append(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.root}/{name}")


@dataclass(frozen=True)
class JdbcControl:
    """Control tables in a database; its JDBC driver must be on Spark's class path.

    The step log has to be a table with the columns of STEP_LOG_SCHEMA that allows several rows per
    ``step_id``: rows are added, never updated. Tables are read in one task, as a plain JDBC read
    is. No database was at hand to test this.
    """

    spark: SparkSession
    url: str
    properties: dict[str, str] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.jdbc(self.url, name, properties=self.properties)

    def append(self, name: str, rows: DataFrame) -> None:
        rows.write.jdbc(self.url, name, mode="append", properties=self.properties)


def column_contracts(store: ControlStore) -> DataFrame:
    """The column contract under the feed's id, as ``contracts.build_contracts`` takes it."""
    return store.table(COLUMNS).withColumnRenamed("fp_detail_id", "fp_id")


def current_steps(step_log: DataFrame) -> DataFrame:
    """The newest row of every step; of two rows written at once, the one that ends it.

    An aggregate, so each task hands on one row of a step at most, however long the log is.
    """
    names = [quoted(name) for name in step_log.columns]
    newest = F.struct(F.col("upsert_ts"), F.coalesce(F.col("step_status") != IN_PROGRESS, F.lit(True)))
    rows = step_log.groupBy("step_id").agg(F.max_by(F.struct(*names), newest).alias("__row"))
    return rows.select(*(F.col(f"__row.{name}") for name in names))


def _ended(step_name: str) -> Column:
    return (F.col("step_name") == step_name) & (F.col("step_status") == DONE)


def high_watermark(steps: DataFrame, load_step: str = STEP_LOAD) -> DataFrame:
    """One row ``since``: the latest start of a load that succeeded."""
    loads = steps.where(_ended(load_step))
    start_type = steps.schema["step_start_ts"].dataType
    since = F.coalesce(F.max("step_start_ts"), F.lit(NEVER).cast(start_type))
    return loads.agg(since.alias("since"))


def pending_files(
    file_log: DataFrame,
    steps: DataFrame,
    mode: str = "high_watermark",
    load_step: str = STEP_LOAD,
) -> DataFrame:
    """File-log rows still to be loaded.

    ``high_watermark``: files whose registration ended after the latest start of a successful
    load. This passes over a failed file once another file succeeds later, and over a file
    registered during a run. ``per_file``: registered files without a successful load of their own.
    """
    registered = steps.where(_ended(STEP_REGISTRATION))
    if mode == "high_watermark":
        registered = registered.where(F.col("step_end_ts") > high_watermark(steps, load_step).scalar())
        return file_log.join(_file_ids(registered), "file_process_id", "left_semi")
    if mode == "per_file":
        waiting = file_log.join(_file_ids(registered), "file_process_id", "left_semi")
        loaded = _file_ids(steps.where(_ended(load_step)))
        return waiting.join(loaded, "file_process_id", "left_anti")
    raise ValueError(f"unknown mode {mode!r}")


def _file_ids(steps: DataFrame) -> DataFrame:
    """The files of some steps, once each: a file may have very many steps."""
    return steps.select("file_process_id").distinct()


def registered_at(steps: DataFrame) -> DataFrame:
    """(``file_process_id``, ``registered_ts``): the end of each file's last registration."""
    return (
        steps.where(_ended(STEP_REGISTRATION))
        .groupBy("file_process_id")
        .agg(F.max("step_end_ts").alias("registered_ts"))
    )


def log_start(files: DataFrame, run_id: str, load_step: str = STEP_LOAD) -> DataFrame:
    """Step rows that open one load step per file (``file_process_id``, ``target_path``)."""
    now = F.current_timestamp()
    return _step_rows(
        files,
        load_step,
        step_id=F.concat_ws("-", F.lit(run_id), "file_process_id"),
        step_status=F.lit(IN_PROGRESS),
        step_status_detail=F.lit(RUNNING_DETAIL),
        step_start_ts=now,
        step_end_ts=now,
        load_id=F.lit(None).cast("string"),
    )


def log_finish(results: DataFrame, load_step: str = STEP_LOAD) -> DataFrame:
    """Step rows that close the steps of ``results``: ``step_id, file_process_id, target_path,
    load_id, status, message, start, end``."""
    succeeded = F.col("status") == SUCCESS
    return _step_rows(
        results,
        load_step,
        step_id=F.col("step_id"),
        step_status=F.when(succeeded, DONE).otherwise(ERROR),
        step_status_detail=F.when(succeeded, DONE_DETAIL).otherwise(F.col("message")),
        step_start_ts=F.col("start"),
        step_end_ts=F.col("end"),
        load_id=F.when(succeeded, F.col("load_id")),
    )


def _step_rows(df: DataFrame, load_step: str, **values: Column) -> DataFrame:
    return df.select(
        values["step_id"].alias("step_id"),
        F.col("file_process_id").cast("bigint"),
        F.lit(load_step).alias("step_name"),
        values["step_status"].alias("step_status"),
        values["step_status_detail"].alias("step_status_detail"),
        values["step_start_ts"].alias("step_start_ts"),
        values["step_end_ts"].alias("step_end_ts"),
        F.lit(WRITER).alias("upsert_by"),
        F.current_timestamp().alias("upsert_ts"),
        F.col("target_path"),
        values["load_id"].alias("load_id"),
    )


def done_loads(steps: DataFrame, load_step: str = STEP_LOAD) -> DataFrame:
    """(``target_path``, ``load_id``): the tables' successful loads. Ids sort by age."""
    loads = steps.where(_ended(load_step) & F.col("load_id").isNotNull())
    return loads.select("target_path", "load_id").distinct()
