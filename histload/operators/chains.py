"""Batches folded onto keys with several open rows, or with rows without a date.

Merged one by one, a dated row replaces every open row of its key that differs from it: it closes the row and is
inserted once for each. A row without a date closes nothing; it is inserted beside each open row it differs
from. So every open row starts a chain of its own, of the dated rows after it that differ from the one before,
and a row without a date starts a chain more for each chain it differs from at its place.

Chains are built in generations: those of the rows open at first, then those that rows without a date have
started in them, and so on. There are as many generations as a chain of such rows is long, whatever
the number of batches; each has the rows of the keys concerned alone. A row may be in many chains before those it
does not change are left, so chains are made of row numbers, keys, dates and numbers of the data hash; the rows
themselves are joined to what is kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histload.names import END, HASH_DATA, START, quoted
from histload.session import shared_folder

# Names no data column has.
_CHAIN_ROW, _STARTS = "__chain_row", "__starts"
_ROW, _KEY, _SEQ, _DATE, _HASH, _END = "__whole_row", "__key", "__seq_of", "__date", "__hash_no", "__chain_end"


def fold_chains(open_rows: DataFrame, later: DataFrame, seq: str, key: str) -> DataFrame:
    """The rows of all chains, with END: ``open_rows`` (no column END; ``seq`` tells when each was opened) and
    the rows of ``later`` batches that they make. Keys are not NULL, and a batch has one row of a key at most
    that was open before it."""
    shared_folder(later.sparkSession)
    whole = open_rows.withColumn(_STARTS, F.lit(True)).unionByName(
        later.withColumn(_STARTS, F.lit(False)), allowMissingColumns=True
    )
    # A number of its own for each row; fixed by the checkpoint, before anything is joined to it.
    whole = whole.withColumn(_ROW, F.monotonically_increasing_id()).checkpoint()
    hashes = Window.partitionBy(quoted(key)).orderBy(HASH_DATA)
    narrow = whole.select(
        _ROW, F.col(quoted(key)).alias(_KEY), F.col(quoted(seq)).alias(_SEQ), F.col(START).alias(_DATE),
        F.when(F.col(HASH_DATA).isNotNull(), F.dense_rank().over(hashes)).alias(_HASH), _STARTS,
    ).checkpoint()
    dated = F.col(_DATE).isNotNull()
    along = Window.partitionBy(_CHAIN_ROW).orderBy(_SEQ)
    heads, later, done = narrow.where(_STARTS), narrow.where(~F.col(_STARTS)), []
    while True:
        heads = heads.withColumns({_CHAIN_ROW: F.monotonically_increasing_id(), _STARTS: F.lit(True)}).checkpoint()
        after = heads.select(F.col(_KEY).alias("__of"), F.col(_SEQ).alias("__from"), _CHAIN_ROW)
        members = later.join(after, (F.col(_KEY) == F.col("__of")) & (F.col(_SEQ) > F.col("__from")))
        rows = heads.unionByName(members.drop("__of", "__from"))
        # Rows without a date leave the chain as it is.
        state = F.last(F.when(F.col(_STARTS) | dated, F.col(_HASH)), ignorenulls=True)
        before = state.over(along.rowsBetween(Window.unboundedPreceding, -1))
        rows = rows.withColumn("__before", before)
        rows = rows.where(F.col(_STARTS) | (F.col(_HASH) != F.col("__before"))).drop("__before").checkpoint()
        chain = rows.where(F.col(_STARTS) | dated).withColumn(_END, F.lead(_DATE).over(along))
        done.append(chain.select(_ROW, _END))
        heads = rows.where(~F.col(_STARTS) & ~dated).drop(_CHAIN_ROW)
        if heads.isEmpty():
            ends = reduce(DataFrame.union, done)
            return whole.join(ends, _ROW).drop(_ROW, _STARTS).withColumnRenamed(_END, END)


def opening_rows(batches: DataFrame, open_keys: DataFrame, seq: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the first batch of each key that has no open row, all others); ``open_keys`` has one column."""
    first = batches.groupBy(F.col(quoted(key)).alias("__key")).agg(F.min(quoted(seq)).alias("__first"))
    same = F.col("__key") == F.col("__open")
    first = first.join(open_keys.toDF("__open").distinct(), same, "left_anti")
    own = (F.col(quoted(key)) == F.col("__key")) & (F.col(quoted(seq)) == F.col("__first"))
    return batches.join(first, own, "left_semi"), batches.join(first, own, "left_anti")
