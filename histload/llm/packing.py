"""Shards of near-equal bytes, tokens and rows, by vector bin packing of groups of equal texts.

A group is a vector (bytes, tokens, rows), in parts of the whole table. Groups larger than
1 / (shards * parcels_per_shard) of any of the three are parcels of their own; only what exceeds half a
shard is cut, by a hash of the doc_id and the number of a row among equal ones. All smaller groups are gathered whole, by a hash of their text,
into that many parcels. The parcels, largest first, then go each to the shard where the dot product
of its vector with the shard's residual capacity is highest. Their number is bounded by the
parameters, whatever the table holds, so the packing is a small step on the driver. At its end parcels are
moved or swapped between shards to even out bytes, where neither tokens nor rows get worse by it. Rows are numbered
in cells, parts of a parcel of at most about its usual size, so no task sorts a large group.

Defined results: a NULL text is empty, with no bytes and no tokens. Equal rows of a group that is cut are
dealt out over its cells. Slots follow doc_id (NULL first), then the text's hash, in each cell; equal rows get different
slots. An empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histload.llm.tables import with_repeat, with_row_id

SHARDS = 40
PARCELS_PER_SHARD = 64
ROW_BYTES = 16
BYTES_WEIGHT = 4.0  # of bytes in the dot product, against 1 of tokens and of rows
ROUNDS = 50  # of moves for each shard, at most
TRIED = 8  # smaller shards that the largest one tries to move to
WORD = r"[^\x20\x09-\x0D]+"


def pack(vectors: np.ndarray, shards: int, weights: np.ndarray) -> np.ndarray:
    """The shard of each vector (rows are parcels; each column sums to 1)."""
    residual = np.full((shards, vectors.shape[1]), 1.0 / shards)
    out = np.empty(len(vectors), np.int64)
    order = np.argsort(-(vectors * weights).sum(axis=1), kind="stable")
    for n in order:
        shard = int(np.argmax(residual @ (vectors[n] * weights)))
        out[n] = shard
        residual[shard] -= vectors[n]
    return out


def even_out(placed: np.ndarray, vectors: np.ndarray, shards: int) -> np.ndarray:
    """Move or swap parcels between the largest shard and a smaller one, by the first column of ``vectors``,
    while that helps and leaves no other column's larger load of the two above both its mean and itself."""
    placed, sizes = placed.copy(), vectors[:, 0]
    loads = np.zeros((shards, vectors.shape[1]))
    np.add.at(loads, placed, vectors)
    mean = loads.mean(axis=0)
    for _ in range(ROUNDS * shards):
        high = int(np.argmax(loads[:, 0]))
        move = next(
            (found for low in np.argsort(loads[:, 0], kind="stable")[: TRIED] if low != high
             and (found := _best_move(placed, vectors, sizes, loads, mean, high, int(low)))), None
        )
        if move is None:
            break
        low, ours, theirs = move
        for parcel, shard in ((ours, low), *(((theirs, high),) if theirs is not None else ())):
            loads[placed[parcel]] -= vectors[parcel]
            loads[shard] += vectors[parcel]
            placed[parcel] = shard
    return placed


def _best_move(placed, vectors, sizes, loads, mean, high, low):
    """(low, parcel of the larger shard, one of the smaller for it or None) that evens most, or None."""
    gap = loads[high, 0] - loads[low, 0]
    ours, theirs = np.flatnonzero(placed == high), np.flatnonzero(placed == low)
    if gap <= 1e-6 * mean[0] or not len(ours):
        return None
    theirs = theirs[np.argsort(sizes[theirs], kind="stable")]
    other = np.vstack((np.zeros(vectors.shape[1]), vectors[theirs]))  # nothing, or one of theirs
    near = np.searchsorted(other[:, 0], sizes[ours] - gap / 2)
    best, gained = None, 1e-6 * mean[0]
    most = np.maximum(np.maximum(loads[high], loads[low]), mean)[1:] * (1 + 1e-9)
    for step in (-2, -1, 0, 1):
        tried = np.clip(near + step, 0, len(theirs))
        moved = vectors[ours] - other[tried]
        gain = np.minimum(moved[:, 0], gap - moved[:, 0])
        worse = (np.maximum(loads[high] - moved, loads[low] + moved)[:, 1:] > most).any(axis=1)
        gain[worse] = -1
        n = int(np.argmax(gain))
        if gain[n] > gained:
            gained = gain[n]
            best = (low, ours[n], theirs[tried[n] - 1] if tried[n] else None)
    return best


def packed(
    docs: DataFrame,
    shards: int = SHARDS,
    parcels_per_shard: int = PARCELS_PER_SHARD,
) -> DataFrame:
    """(doc_id, size, text_crc32, tokens, shard, slot) for every row of ``docs`` (doc_id,
    text); ``size`` is the bytes of the text and ROW_BYTES, ``slot`` counts a shard's rows from 0."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = with_row_id(
        docs.select(
            "doc_id",
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"),
            F.crc32(text).alias("text_crc32"),
            F.md5(text).alias("digest"),
        ),
        "sizes",
    )
    parcels = shards * parcels_per_shard
    vector = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    whole = rows.agg(*vector).first()
    totals = np.array([whole["size"] or 1, whole["tokens"] or 1, whole["rows"] or 1], float)

    # Fewer than 3 * parcels groups can have more than 1 / parcels of bytes, tokens or rows.
    groups = rows.groupBy("digest").agg(*vector)
    share = F.greatest(*(F.col(c) / float(t) for c, t in zip(("size", "tokens", "rows"), totals)))
    large = groups.withColumn("share", share * parcels).where(F.col("share") > 1)
    cells = F.least(F.ceil("share"), F.col("rows")).cast("int").alias("cells")
    large = large.select("digest", cells).orderBy("digest").collect()
    bases = (parcels + np.cumsum([0, *(row["cells"] for row in large)])).tolist()
    cut = spark.createDataFrame(
        [(row["digest"], base, row["cells"]) for row, base in zip(large, bases)],
        "digest string, base int, cells int",
    )

    small = F.pmod(F.xxhash64("digest"), F.lit(parcels))
    rows = rows.join(F.broadcast(cut), "digest", "left")
    whole = rows.where(F.col("base").isNull()).withColumn("cell", small.cast("int"))
    # Rows of a cut group, with the number of each among equal ones.
    parts = with_repeat(rows.where(F.col("base").isNotNull()), ["digest", "doc_id"], "again")
    cell = F.col("base") + F.pmod(F.xxhash64("doc_id") + F.col("again"), F.col("cells"))
    parts = parts.withColumn("cell", cell.cast("int")).drop("again")
    rows = (whole.unionByName(parts) if large else whole).drop("base", "cells")

    found = rows.groupBy("cell").agg(*vector).orderBy("cell").collect()
    # Cells of a group are one parcel, up to half a shard; below ``parcels`` a cell is one.
    numbers = np.array([row["cell"] for row in found], np.int64)
    group = np.searchsorted(bases, numbers, "right") - 1
    start = np.array([0, *bases])[group + 1]
    together = np.where(group < 0, numbers, start + (numbers - start) // (parcels_per_shard // 2))
    names, parcel = np.unique(together, return_inverse=True)
    vectors = np.zeros((len(names), 3))
    np.add.at(vectors, parcel, [[r["size"], r["tokens"], r["rows"]] for r in found] or np.zeros((0, 3)))
    placed = pack(vectors / totals, shards, np.array([BYTES_WEIGHT, 1.0, 1.0]))
    placed = even_out(placed, vectors / totals, shards)
    table, taken = [], [0] * shards
    for row, shard in zip(found, placed[parcel].tolist()):
        table.append((row["cell"], shard, taken[shard]))
        taken[shard] += row["rows"]
    plan = spark.createDataFrame(table, "cell int, shard int, before long")
    order = Window.partitionBy("cell").orderBy("doc_id", "digest")
    return (
        rows.withColumn("place", F.row_number().over(order))
        .join(F.broadcast(plan), "cell")
        .select(
            "doc_id", "size", "text_crc32", "tokens", "shard",
            (F.col("before") + F.col("place") - 1).alias("slot"),
        )
    )
