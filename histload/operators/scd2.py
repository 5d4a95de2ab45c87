"""Type-2 history: which rows of a batch close or open rows of the history.

``batch`` and ``history`` carry the audit columns. A history row is open while its ``endDate``
is NULL. The batch that arrives last wins, whatever its defining values: it closes the open row
with its own start date even if that lies earlier.

The operators read ``batch`` and ``history`` several times, so both should be tables or persisted
rather than long computations. Where batch rows are joined, ``hot`` names the batch's hot keys;
if it is not given, they are found by counting, in a job of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from histload.names import END, HASH_DATA, MERGE_KEY, START, quoted
from histload.operators.bitmap import MOST_BITS, bits_for, common_type, key_bits, with_may_match
from histload.operators.skew import ROWS, HotKeys, find_hot_keys, group_sizes, join_on_key
from histload.session import shared_folder

# Names no data column has.
IS_NEW, MAY_MATCH, PRIOR_ROW = "__is_new", "__may_match", "__prior"
# The bits of a batch's keys are worth a look at the open rows if these are so many times the batch's.
MORE_OPEN_ROWS = 4


def current_rows(history: DataFrame) -> DataFrame:
    return history.where(F.col(END).isNull())


def closed_rows(history: DataFrame) -> DataFrame:
    return history.where(F.col(END).isNotNull())


def is_small(batch: DataFrame, hot: HotKeys) -> bool:
    """Whether the batch, as one row (key, hash, start date) per key, is known to fit a broadcast.
    Start dates kept as text have no bound."""
    return hot.small and not isinstance(batch.schema[START].dataType, (BinaryType, StringType))


def _open_hashes(history: DataFrame, batch: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    """(``__key``, ``__hash``) of the open rows whose key occurs in the batch.

    The semi join keeps this no larger than the batch needs: with a small batch, the open
    rows are filtered where they are read and never shuffled. Else those are left out first that the
    bits of the batch's keys tell to have no partner.
    """
    open_rows = current_rows(history).select(quoted(key), HASH_DATA)
    if not hot.small:
        marked = _with_may_match(open_rows, batch, key, hot.total)
        open_rows = open_rows if marked is None else marked.where(MAY_MATCH)
    hashes = open_rows.select(F.col(quoted(key)).alias("__key"), F.col(HASH_DATA).alias("__hash"))
    keys = batch.select(F.col(quoted(key)).alias("__batch_key")).distinct()
    keys = F.broadcast(keys) if hot.small else keys
    return hashes.join(keys, F.col("__key") == F.col("__batch_key"), "left_semi")


def _with_may_match(
    open_rows: DataFrame, batch: DataFrame, key: str, batch_rows: int | None = None
) -> DataFrame | None:
    """``open_rows`` with MAY_MATCH, by the bits of the batch's keys; None where these would tell little,
    because the batch has nearly as many rows or more than the bits. Parquet tells its rows unread."""
    batch_rows = batch.count() if batch_rows is None else batch_rows
    if 4 * batch_rows > MOST_BITS or open_rows.count() < MORE_OPEN_ROWS * batch_rows:
        return None
    kind, size = common_type(open_rows, batch, key), bits_for(batch_rows)
    return with_may_match(open_rows, key_bits(batch, key, kind, size), key, kind, size, MAY_MATCH)


def _with_open_hash(
    batch: DataFrame, history: DataFrame, key: str, how: str, hot: HotKeys | None
) -> DataFrame:
    if hot is None:
        hot = find_hot_keys(group_sizes(batch, [key]))
    hashes = _open_hashes(history, batch, key, hot)
    return join_on_key(batch, hashes, key, "__key", how, hot)


def changed_rows(
    batch: DataFrame, history: DataFrame, key: str, hot: HotKeys | None = None
) -> DataFrame:
    """Batch rows whose key has an open row with another data hash."""
    return (
        _with_open_hash(batch, history, key, "inner", hot)
        .where(F.col(HASH_DATA) != F.col("__hash"))
        .select(*map(quoted, batch.columns))
    )


def stage_updates(
    batch: DataFrame, history: DataFrame, key: str, hot: HotKeys | None = None
) -> DataFrame:
    """The merge input: every batch row under its key, changed rows once more under NULL.

    The keyed copy meets the open row and closes it (or is inserted, for a new key); the NULL
    copy meets nothing and is inserted as the new version. ``merge_next`` has the same result
    without the second copy; this form is for catalogs with a MERGE of their own.
    """
    key_type = batch.schema[key].dataType
    changed = changed_rows(batch, history, key, hot)
    inserts = changed.withColumn(MERGE_KEY, F.lit(None).cast(key_type))
    keyed = batch.withColumn(MERGE_KEY, F.col(quoted(key)))
    columns = [MERGE_KEY, *map(quoted, batch.columns)]
    return inserts.select(*columns).unionByName(keyed.select(*columns), allowMissingColumns=True)


def ambiguous_keys(batch: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Keys with an open row and several batch rows, as (``key``, ``__rows``): such a batch cannot be
    merged, since two of its rows would update the same history row."""
    several = (
        batch.where(F.col(quoted(key)).isNotNull())
        .groupBy(quoted(key))
        .agg(F.count(F.lit(1)).alias(ROWS))
        .where(F.col(ROWS) > 1)
    )
    open_keys = current_rows(history).select(F.col(quoted(key)).alias("__key"))
    return several.join(open_keys, F.col(quoted(key)) == F.col("__key"), "left_semi")


def _per_key(batch: DataFrame, key: str) -> DataFrame:
    """One narrow row per key of the batch."""
    keyed = batch.where(F.col(quoted(key)).isNotNull()).groupBy(F.col(quoted(key)).alias("__key"))
    return keyed.agg(
        F.count(F.lit(1)).alias("__n"),
        F.max(HASH_DATA).alias("__hash"),
        F.max(START).alias("__start"),
    )


def _several(key: str, value: Column) -> Column:
    return F.concat(F.lit(f"several batch rows for one open key, {key} = "), value.cast("string"))


def closed_by_batch(
    open_rows: DataFrame, batch: DataFrame, key: str, small: bool = False
) -> DataFrame:
    """The open rows, with ``endDate`` set where the batch brings another version of the key.

    The batch is reduced to one narrow row per key before the join, and broadcast if it is
    ``small``. Several batch rows for an open key fail the job.
    """
    per_key = _per_key(batch, key)
    per_key = F.broadcast(per_key) if small else per_key
    end = (
        F.when(F.col("__n") > 1, F.raise_error(_several(key, F.col(quoted(key)))))
        .when(F.col("__hash") != F.col(HASH_DATA), F.col("__start"))
        .otherwise(F.col(END))
    )
    keyed = (
        open_rows.where(F.col(quoted(key)).isNotNull())
        .join(per_key, F.col(quoted(key)) == F.col("__key"), "left")
        .withColumn(END, end)
        .select(*map(quoted, open_rows.columns))
    )
    # NULL keys match nothing; kept out of the join, where they would share one partition.
    return keyed.unionByName(open_rows.where(F.col(quoted(key)).isNull()))


def rows_to_insert(
    batch: DataFrame, history: DataFrame, key: str, hot: HotKeys | None = None
) -> DataFrame:
    """Batch rows that become history rows: new keys, NULL keys and changed data."""
    if hot is None:
        hot = find_hot_keys(group_sizes(batch, [key]))
    return _new_rows(batch, _open_hashes(history, batch, key, hot), key, hot)


def _new_rows(batch: DataFrame, hashes: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    """``rows_to_insert`` by the open rows' (``__key``, ``__hash``)."""
    has_key = F.col(quoted(key)).isNotNull()
    keyed = (
        join_on_key(batch.where(has_key), hashes, key, "__key", "left", hot)
        .where(F.col("__key").isNull() | (F.col("__hash") != F.col(HASH_DATA)))
        .select(*map(quoted, batch.columns))
    )
    return keyed.unionByName(batch.where(~has_key))


def _touched_hashes(open_rows: DataFrame, batch: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    """``_open_hashes`` computed once: two narrow columns of the open rows are read, and no more is kept
    than the batch needs."""
    shared_folder(batch.sparkSession)
    return _open_hashes(open_rows, batch, key, hot).checkpoint()


def _merge(open_rows, batch, key, hot) -> tuple[DataFrame, DataFrame]:
    hashes = _touched_hashes(open_rows, batch, key, hot)
    updated = closed_by_batch(open_rows, batch, key, is_small(batch, hot))
    return updated, _new_rows(batch, hashes, key, hot)


def merge_parts(
    open_rows: DataFrame, batch: DataFrame, key: str, hot: HotKeys | None = None
) -> tuple[DataFrame, DataFrame]:
    """What one load writes, as (the former open rows, now open or closed; rows brought by the batch).

    The open rows are read twice: key and hash, to tell what the batch brings, then whole, to pass them on. For
    a small batch neither shuffles them.
    """
    if hot is None:
        hot = find_hot_keys(group_sizes(batch, [key]))
    return _merge(open_rows, batch, key, hot)


def merge_changes(
    open_rows: DataFrame, batch: DataFrame, key: str, hot: HotKeys | None = None
) -> DataFrame:
    """What one merge changes: the batch's new rows, and key, data hash and end date of the open rows it
    closes, with PRIOR_ROW set. Of the open rows only key and hash are read, once."""
    if hot is None:
        hot = find_hot_keys(group_sizes(batch, [key]))
    hashes = _touched_hashes(open_rows, batch, key, hot)
    per_key = _per_key(batch, key).withColumnsRenamed({"__key": "__batch_key", "__hash": "__batch_hash"})
    per_key = F.broadcast(per_key) if is_small(batch, hot) else per_key
    start = F.when(
        F.col("__n") > 1, F.raise_error(_several(key, F.col("__key"))).cast(batch.schema[START].dataType)
    ).otherwise(F.col("__start"))
    met = hashes.distinct().join(per_key, F.col("__key") == F.col("__batch_key")).withColumn("__start", start)
    closed = met.where((F.col("__batch_hash") != F.col("__hash")) & F.col("__start").isNotNull())
    closed = closed.select(
        F.col("__key").alias(key),
        F.col("__hash").alias(HASH_DATA),
        F.col("__start").alias(END),
        F.lit(True).alias(PRIOR_ROW),
    )
    new = _new_rows(batch, hashes, key, hot).withColumn(PRIOR_ROW, F.lit(False))
    return new.unionByName(closed, allowMissingColumns=True)


def merge_open(
    open_rows: DataFrame, batch: DataFrame, key: str, hot: HotKeys | None = None
) -> DataFrame:
    """Both parts in one: the former open rows (now open or closed) and the new rows.

    Columns only one side has are NULL on the other. A batch that is not broadcast and has no hot
    keys meets the open rows in one shuffle by key, which those that the bits of its keys tell to have no
    partner do not enter; hot keys are joined apart.
    """
    if hot is None:
        hot = find_hot_keys(group_sizes(batch, [key]))
    if not hot.rows and not is_small(batch, hot):
        marked = _with_may_match(open_rows, batch, key, hot.total)
        if marked is None:
            return _merge_in_one_shuffle(open_rows, batch, key)
        rest = marked.where(~F.col(MAY_MATCH)).drop(MAY_MATCH)
        merged = _merge_in_one_shuffle(marked.where(MAY_MATCH).drop(MAY_MATCH), batch, key)
        return merged.unionByName(rest, allowMissingColumns=True)
    updated, inserted = _merge(open_rows, batch, key, hot)
    return updated.unionByName(inserted, allowMissingColumns=True)


def _merge_in_one_shuffle(open_rows: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Open and batch rows of a key side by side in a window, which tells what becomes of each.

    As a join would have it, a batch row is inserted once for each open row it differs from.
    """
    both = open_rows.withColumn(IS_NEW, F.lit(False)).unionByName(
        batch.withColumn(IS_NEW, F.lit(True)), allowMissingColumns=True
    )
    columns = [quoted(name) for name in both.columns if name != IS_NEW]
    has_key = F.col(quoted(key)).isNotNull()
    of_key = Window.partitionBy(quoted(key))
    new, own = F.col(IS_NEW), F.col(HASH_DATA)

    def over(aggregate, value: Column, side: Column) -> Column:
        return aggregate(F.when(side, value)).over(of_key)

    rows = both.where(has_key).withColumns(
        {
            "__open": over(F.collect_list, own, ~new),
            "__n": over(F.count, F.lit(1), new),
            "__hash": over(F.max, own, new),
            "__start": over(F.max, F.col(START), new),
        }
    )
    end = (
        F.when(new, F.col(END))
        .when(F.col("__n") > 1, F.raise_error(_several(key, F.col(quoted(key)))))
        .when(F.col("__hash") != own, F.col("__start"))
        .otherwise(F.col(END))
    )
    differing = F.size(F.filter("__open", lambda other: other != F.col(HASH_DATA)))
    copies = F.when(~new | (F.size("__open") == 0), 1).otherwise(differing)
    rows = rows.withColumn(END, end).withColumn("__copy", F.explode(F.array_repeat(F.lit(0), copies)))
    return rows.select(*columns).unionByName(both.where(~has_key).select(*columns))


def merge_next(
    history: DataFrame, batch: DataFrame, key: str, hot: HotKeys | None = None
) -> DataFrame:
    """The whole history after merging one batch. Merging the same batch again changes nothing."""
    merged = merge_open(current_rows(history), batch, key, hot)
    return closed_rows(history).unionByName(merged, allowMissingColumns=True)
