"""Audit columns of a batch: hashes, validity dates, load date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histload.functions.hashing import row_hash
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
from histload.operators.ordered import ordered_rows
from histload.operators.skew import ROWS_PER_SLICE, HotKeys, find_hot_keys, group_sizes


def load_date_column(load_date: str | dt.date | None) -> Column:
    """The load date as ``yyyy-MM-dd`` text; today in the session's time zone if not given."""
    if load_date is None:
        return F.date_format(F.current_date(), "yyyy-MM-dd")
    return F.lit(str(load_date))


def _check_names(df: DataFrame, partition_col: str) -> None:
    added = [HASH_KEY, HASH_DATA, START, END, partition_col, LOAD_FOLDER, STATE_FOLDER]
    taken = {name.lower() for name in df.columns} & {name.lower() for name in added}
    if taken:
        raise ValueError(f"batch columns clash with audit columns: {sorted(taken)}")


def with_hashes(
    df: DataFrame,
    key: str,
    data_cols: Sequence[str],
    defining: str,
    partition_col: str = DEFAULT_PARTITION,
    load_date: str | dt.date | None = None,
    null_token: str | None = None,
    hash_key_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Every audit column but the end of validity, which depends on the key's other rows.

    ``hashKey`` is made of ``hash_key_cols``, of the key if they are not given.
    """
    _check_names(df, partition_col)
    return df.withColumns(
        {
            HASH_KEY: row_hash(hash_key_cols or [key], null_token),
            HASH_DATA: row_hash(data_cols, null_token),
            START: F.col(quoted(defining)),
            partition_col: load_date_column(load_date),
        }
    )


def with_audit_columns(
    df: DataFrame,
    key: str,
    data_cols: Sequence[str],
    defining: str,
    partition_col: str = DEFAULT_PARTITION,
    load_date: str | dt.date | None = None,
    tiebreak: Sequence[str] = (),
    null_token: str | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    hot: HotKeys | None = None,
    hash_key_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``hashKey``, ``hashData``, ``startDate``, ``endDate`` and the load-date column.

    A row is valid from its defining value up to that of the key's next row in the batch; the
    last row stays open (``endDate`` NULL). Rows tied on the defining column are ordered by
    ``tiebreak``, then by a hash of the row. Rows with a NULL key form one chain.

    Counting rows per key (to find hot keys) is a job of its own over the key column, run here
    unless the caller passes ``hot``. The hashes are made after the shuffle by key, which would
    otherwise carry their 128 characters per row.
    """
    _check_names(df, partition_col)
    if hot is None:
        hot = find_hot_keys(group_sizes(df, [key]), rows_per_slice)
    rows = ordered_rows(df, [key], [defining, *tiebreak], hot)
    ended = "__end"
    rows = rows.with_next(ended, defining).result()
    rows = with_hashes(
        rows, key, data_cols, defining, partition_col, load_date, null_token, hash_key_cols
    )
    columns = [*df.columns, HASH_KEY, HASH_DATA, START, END, partition_col]
    return rows.withColumnRenamed(ended, END).select(*map(quoted, columns))
