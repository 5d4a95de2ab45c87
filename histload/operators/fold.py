"""Many batches of one table merged in one pass, with the result of merging them one by one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histload.names import DEFAULT_PARTITION, END, HASH_DATA, HASH_KEY, START, quoted
from histload.operators.chains import fold_chains, opening_rows
from histload.operators.ordered import ordered_rows
from histload.operators.scd2 import PRIOR_ROW, closed_rows, current_rows
from histload.operators.skew import ROWS, ROWS_PER_SLICE, HotKeys, find_hot_keys, group_sizes

CHAIN = "__chain"
UNDATED = "__undated"
EARLIER = "__earlier"
PRIOR = -1  # the place of a table's open rows, before every batch


def with_chain(df: DataFrame, seq: str, key: str) -> DataFrame:
    """NULL keys meet no earlier row, so each batch's NULL-key rows are a chain of their own."""
    return df.withColumn(CHAIN, F.when(F.col(quoted(key)).isNull(), F.col(quoted(seq))))


def fold_batches(
    batches: DataFrame,
    seq: str,
    key: str,
    tiebreak: Sequence[str] = (),
    rows_per_slice: int = ROWS_PER_SLICE,
    hot: HotKeys | None = None,
    partition_col: str = DEFAULT_PARTITION,
) -> DataFrame:
    """History made by merging the batches in the order of ``seq`` (integer) into an empty table.

    ``batches`` has the columns of ``audit.with_hashes``. A key's rows of its first batch are all
    kept; later rows are kept where the data hash differs from the row before. Each kept row ends
    where the next kept row of its key starts. Precondition: ``ambiguous_batches`` is empty.
    """
    rows = with_chain(batches, seq, key)
    if hot is None:
        hot = find_hot_keys(group_sizes(rows, [key, CHAIN]), rows_per_slice)
    added = [seq, CHAIN, HASH_KEY, HASH_DATA, START, partition_col]
    ordered = ordered_rows(rows, [key, CHAIN], [seq, START, *tiebreak], hot, added)
    kept = (
        ordered.with_first("__first", seq)
        .with_previous("__hash_before", HASH_DATA)
        .where(
            F.col(quoted(key)).isNull()
            | (F.col(quoted(seq)) == F.col("__first"))
            | (F.col(HASH_DATA) != F.col("__hash_before"))
        )
    )
    return kept.with_next(END, START).result().drop(CHAIN, "__first", "__hash_before")


def touched_rows(
    open_rows: DataFrame, batch_keys: DataFrame, key: str, small: bool = False, how: str = "left_semi"
) -> DataFrame:
    """The open rows whose key is among ``batch_keys`` (one column, repeats allowed), or by ``left_anti``
    the others. ``small``: the keys are broadcast, and the open rows not shuffled."""
    keys = batch_keys.toDF("__key").where(F.col("__key").isNotNull()).distinct()
    keys = F.broadcast(keys) if small else keys
    return open_rows.join(keys, F.col(quoted(key)) == F.col("__key"), how)


def fold_parts(
    open_rows: DataFrame,
    batches: DataFrame,
    seq: str,
    key: str,
    tiebreak: Sequence[str] = (),
    rows_per_slice: int = ROWS_PER_SLICE,
    hot: HotKeys | None = None,
    batch_keys: DataFrame | None = None,
    partition_col: str = DEFAULT_PARTITION,
    touched: DataFrame | None = None,
    odd_keys: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """What folding the batches onto a table's open rows writes, as (open rows whose key is in no
    batch, all rows of the batches' keys).

    Only the second part enters the fold; for small batches the first is passed on without a
    shuffle. ``batch_keys`` (one column, the batches' keys, repeats allowed) spares a pass over
    the batches to find them, ``touched`` (the open rows of these keys) one over the open rows.
    ``odd_keys``: see ``fold_odd_batches``.
    """
    if hot is None:
        sizes = group_sizes(with_chain(batches, seq, key), [key, CHAIN])
        hot = find_hot_keys(sizes, rows_per_slice)
    if batch_keys is None:
        batch_keys = batches.select(quoted(key))
    if touched is None:
        touched = touched_rows(open_rows, batch_keys, key, hot.small)
    untouched = touched_rows(open_rows, batch_keys, key, hot.small, "left_anti")
    folded = fold_odd_batches(touched, batches, seq, key, tiebreak, rows_per_slice, hot, partition_col, odd_keys)
    return untouched, folded.drop(seq)


def fold_changes(
    touched: DataFrame,
    batches: DataFrame,
    seq: str,
    key: str,
    tiebreak: Sequence[str] = (),
    rows_per_slice: int = ROWS_PER_SLICE,
    hot: HotKeys | None = None,
    partition_col: str = DEFAULT_PARTITION,
    odd_keys: DataFrame | None = None,
) -> DataFrame:
    """What folding the batches onto the open rows of their keys (``touched_rows``) changes: the rows they
    bring, and the touched rows with PRIOR_ROW set and their end dates, if they have one now."""
    folded = fold_odd_batches(touched, batches, seq, key, tiebreak, rows_per_slice, hot, partition_col, odd_keys)
    return folded.withColumn(PRIOR_ROW, F.col(quoted(seq)) == PRIOR).drop(seq)


def fold_odd_batches(
    touched: DataFrame | None,
    batches: DataFrame,
    seq: str,
    key: str,
    tiebreak: Sequence[str] = (),
    rows_per_slice: int = ROWS_PER_SLICE,
    hot: HotKeys | None = None,
    partition_col: str = DEFAULT_PARTITION,
    odd_keys: DataFrame | None = None,
) -> DataFrame:
    """``fold_batches`` onto open rows, whose ``seq`` is PRIOR in the result.

    ``odd_keys`` (one column, repeats allowed): keys with several open rows, or with a row without a date
    in the batches. They are folded as chains, apart from all others; without them there must be none.
    """
    if touched is not None:
        touched = touched.drop(END).withColumn(seq, F.lit(PRIOR))

    def folded(prior, rows):
        rows = rows if prior is None else prior.unionByName(rows, allowMissingColumns=True)
        return fold_batches(rows, seq, key, tiebreak, rows_per_slice, hot, partition_col)

    if odd_keys is None:
        return folded(touched, batches)
    odd = odd_keys.toDF("__odd").where(F.col("__odd").isNotNull()).distinct()
    odd = F.broadcast(odd) if hot is not None and hot.small else odd

    def of(rows, how):
        return None if rows is None else rows.join(odd, F.col(quoted(key)) == F.col("__odd"), how)

    rest = folded(of(touched, "left_anti"), of(batches, "left_anti"))
    prior, rows = of(touched, "left_semi"), of(batches, "left_semi")
    open_keys = rows.where(F.lit(False)) if prior is None else prior
    opening, later = opening_rows(rows, open_keys.select(quoted(key)), seq, key)
    opened = fold_batches(opening, seq, key, tiebreak, rows_per_slice, hot, partition_col)
    heads = opened.where(F.col(END).isNull()).drop(END)
    heads = heads if prior is None else heads.unionByName(prior, allowMissingColumns=True)
    chains = fold_chains(heads, later, seq, key).unionByName(
        opened.where(F.col(END).isNotNull()), allowMissingColumns=True
    )
    return rest.unionByName(chains, allowMissingColumns=True)


def fold_next(
    history: DataFrame,
    batches: DataFrame,
    seq: str,
    key: str,
    tiebreak: Sequence[str] = (),
    rows_per_slice: int = ROWS_PER_SLICE,
    hot: HotKeys | None = None,
    partition_col: str = DEFAULT_PARTITION,
) -> DataFrame:
    """The whole history after folding the batches onto it."""
    untouched, folded = fold_parts(
        current_rows(history),
        batches,
        seq,
        key,
        tiebreak,
        rows_per_slice,
        hot,
        partition_col=partition_col,
    )
    prior = closed_rows(history).unionByName(untouched)
    return prior.unionByName(folded, allowMissingColumns=True)


def batch_census(batches: DataFrame, seq: str, key: str) -> DataFrame:
    """Rows per (batch, key): what row counts, hot keys and ambiguity are told from."""
    return batches.groupBy(quoted(seq), quoted(key)).agg(
        F.count(F.lit(1)).alias(ROWS),
        F.count_if(F.col(START).isNull()).alias(UNDATED),
    )


def ambiguous_batches(
    census: DataFrame, seq: str, key: str, open_keys: DataFrame | None = None
) -> DataFrame:
    """(``seq``, ``key``, ``__rows``) where a batch has several rows for a key that is open by then.

    With ``open_keys`` (one column): keys the table has an open row for. Without: keys that an
    earlier batch brought.
    """
    census = census.where(F.col(quoted(key)).isNotNull())
    several = census.where(F.col(ROWS) > 1).select(quoted(seq), quoted(key), ROWS)
    same_key = F.col(quoted(key)) == F.col("__key")
    if open_keys is not None:
        return several.join(open_keys.toDF("__key"), same_key, "left_semi")
    first = census.groupBy(F.col(quoted(key)).alias("__key")).agg(
        F.min(quoted(seq)).alias("__first")
    )
    earlier = F.col("__first") < F.col(quoted(seq))
    return several.join(first, same_key & earlier, "left_semi")


def clashing_batches(census: DataFrame, seq: str, key: str) -> DataFrame:
    """(``seq``, ``key``, ``__rows``, ``__earlier``): each batch with several rows of a key, with every earlier
    batch that brings this key."""
    census = census.where(F.col(quoted(key)).isNotNull())
    several = census.where(F.col(ROWS) > 1).select(quoted(seq), quoted(key), ROWS)
    brought = census.select(F.col(quoted(key)).alias("__key"), F.col(quoted(seq)).alias(EARLIER))
    earlier = (F.col(quoted(key)) == F.col("__key")) & (F.col(EARLIER) < F.col(quoted(seq)))
    return several.join(brought, earlier).drop("__key")
