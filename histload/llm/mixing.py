"""Sources mixed to target weights by a multivariate-hypergeometric splitting tree.

A source's documents are permuted by a hash and cut into blocks along it. The target gives each
source its quota: so many whole passes over its blocks, then blocks of one more pass, then part of
one block. A tree over the output shards splits the sources' block counts: at each node the left
half of the shards draws its share of the blocks without replacement (multivariate-hypergeometric),
the right half has the rest. So every shard gets an exact number of blocks of each source, and the
sources stay mixed as one draw without replacement would mix them. Each source deals its permuted
blocks out by these quotas, disjointly, and a shard orders its rows by another hash.

Only sums per source and per block pass through the driver: ``shards * blocks_per_shard`` blocks and
one more per source at most. What a row gets depends on the row, its block and its source alone, so
tasks that run again agree, and so do reruns.

Defined results: sources are ordered by code point, NULL last; a NULL text has size 0. Rows of size
0 belong to their blocks like others. Equal rows are numbered, and each has a place of its own in the
permutation. A source without words has target 0. An empty table gives no rows. Other columns, whatever
their names, are passed on, except for those named in TAKEN, which must not be there.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import floor

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histload.llm.tables import byte_size, local_rows, maybe_broadcast, stored, with_repeat, with_row_id

WEIGHTS = (3.0, 1.0, 2.0)
SHARE, LIMIT = 1.5, 2.0  # words taken of all words; words taken of a source's at most
SHARDS, BLOCKS_PER_SHARD = 40, 64
SEED = 20240201
WORD = r"[^\x20\x09-\x0D]+"
TAKEN = {
    "mix_size", "mix_key", "mix_block", "mix_blocks", "mix_shards", "mix_source",
    "mix_source_size", "mix_target", "mix_row", "mix_number", "mix_again", "mix_rows",
}


@dataclass(frozen=True)
class Source:
    """A source, its words, its target and the number of its blocks."""

    name: str | None
    size: int
    target: float
    blocks: int


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: tuple[float, ...] = WEIGHTS, share=SHARE, limit=LIMIT):
    """Targets of sources in order; what one cannot take is shared by the others by weight."""
    each = [weights[n % len(weights)] for n in range(len(sizes))]
    out = [0.0] * len(sizes)
    free, rest = set(range(len(sizes))), share * sum(sizes)
    while free:
        total = sum(each[n] for n in free)
        full = {n for n in free if rest * each[n] / total > limit * sizes[n]}
        if not full:
            for n in free:
                out[n] = rest * each[n] / total
            break
        for n in full:
            out[n] = limit * sizes[n]
        free -= full
        rest -= sum(out[n] for n in full)
    return out


def split_quotas(counts: list[int], shards: int, rng: np.random.Generator) -> np.ndarray:
    """Blocks of each source (columns) for each shard (rows), drawn down a tree of halves."""
    out = np.zeros((shards, len(counts)), np.int64)
    nodes = [(0, shards, np.array(counts, np.int64))]
    while nodes:
        first, last, left = nodes.pop()
        if last - first == 1:
            out[first] = left
            continue
        middle = (first + last) // 2
        share = int(left.sum()) * (middle - first) // (last - first)
        drawn = rng.multivariate_hypergeometric(left, share, method="marginals")
        nodes += [(middle, last, left - drawn), (first, middle, drawn)]
    return out


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    """Each row's size and its place in its source's permutation."""
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    return docs.withColumns({"mix_size": word_count(F.col("text")), "mix_key": key})


def _of(rows: DataFrame, again: DataFrame, how: str) -> DataFrame:
    """``rows`` semi- or anti-joined with (source, mix_key)."""
    keys = again.select(F.col("source").alias("mix_source"), F.col("mix_key").alias("mix_again"))
    width = F.lit(64) + F.coalesce(F.octet_length("mix_source"), F.lit(0))
    keys = maybe_broadcast(keys, byte_size(keys, width))
    same = F.col("source").eqNullSafe(F.col("mix_source")) & (F.col("mix_key") == F.col("mix_again"))
    return rows.join(keys, same, how)


def _told_apart(rows: DataFrame, again: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """(``rows`` in which equal ones have places of their own, those among them). Only rows that occur several
    times are written, to be numbered."""
    repeated = with_row_id(_of(rows, again, "left_semi"), "mix_again", "mix_row")
    repeated = with_repeat(repeated, ["source", "mix_key"], "mix_number", "mix_row")
    own = F.xxhash64(F.lit(seed), F.col("mix_key"), F.col("mix_number"))
    key = F.when(F.col("mix_number") > 0, own).otherwise(F.col("mix_key"))
    repeated = repeated.withColumn("mix_key", key).drop("mix_row", "mix_number")
    repeated = stored(repeated, "mix_apart")
    return _of(rows, again, "left_anti").unionByName(repeated), repeated


def _block(blocks: Column) -> Column:
    place = F.col("mix_key") / F.lit(2.0**64) + 0.5
    return F.least(F.floor(place * blocks).cast("int"), blocks - 1)


def _with_sources(rows: DataFrame, sources: list[Source]) -> DataFrame:
    spark = rows.sparkSession
    table = local_rows(
        spark,
        [(s.name, s.size, s.target, s.blocks) for s in sources],
        "mix_source string, mix_source_size bigint, mix_target double, mix_blocks int",
    )
    same = F.col("source").eqNullSafe(F.col("mix_source"))
    return rows.join(F.broadcast(table), same).withColumn("mix_block", _block(F.col("mix_blocks")))


def mixed(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    limit: float = LIMIT,
    shards: int = SHARDS,
    blocks_per_shard: int = BLOCKS_PER_SHARD,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` (doc_id, text, source and others) with ``mix_size``, ``mix_key`` (its place among its source's),
    ``mix_source_size``, ``mix_target`` and ``mix_shards``: the shard of every copy the mix takes of the row."""
    taken = {name.lower() for name in docs.columns} & TAKEN
    if taken:
        raise ValueError(f"columns clash with those of the mix: {sorted(taken)}")
    rows = _keyed(docs, seed)
    columns = ("source", "mix_size", "mix_key")
    narrow = stored(_keyed(docs.select("doc_id", "text", "source"), seed).select(*columns), "mix")
    again = narrow.groupBy("source", "mix_key").agg(F.count(F.lit(1)).alias("mix_rows"))
    again = stored(again.where(F.col("mix_rows") > 1).select("source", "mix_key"), "mix_repeats")
    if not again.isEmpty():
        rows, repeated = _told_apart(rows, again, seed)
        narrow = stored(
            _of(narrow, again, "left_anti").unionByName(repeated.select(*columns)), "mix"
        )
    sums = narrow.groupBy("source").agg(F.sum("mix_size").alias("size")).collect()
    if not sums:
        columns = "mix_size bigint, mix_key bigint, mix_source_size bigint, mix_target double, mix_shards array<int>"
        nothing = [F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in columns.split(", ")]
        return docs.select("*", *nothing)
    sums.sort(key=lambda row: (row["source"] is None, row["source"] or ""))
    sizes = [row["size"] for row in sums]
    wanted = targets(sizes, weights, share, limit)
    whole = max(1, sum(sizes))
    sources = [
        Source(row["source"], row["size"], target, max(1, round(shards * blocks_per_shard * row["size"] / whole)))
        for row, target in zip(sums, wanted)
    ]
    plan = _draw(narrow, sources, shards, seed)
    rows = _with_sources(rows, sources)
    same = F.col("source").eqNullSafe(F.col("plan_source")) & (F.col("mix_block") == F.col("plan_block"))
    rows = rows.join(F.broadcast(plan), same, "left")
    part = (F.col("mix_key") <= F.col("cut_key")) & (F.col("mix_size") <= F.col("cut_size"))
    part = F.coalesce(part, F.lit(False)) | F.coalesce(F.col("mix_key") == F.col("extra_key"), F.lit(False))
    none = F.array().cast("array<int>")
    in_part = F.when(part & F.col("cut_shard").isNotNull(), F.array("cut_shard")).otherwise(none)
    rows = rows.withColumn("mix_shards", F.concat(F.coalesce("plan_shards", none), in_part))
    return rows.select(*docs.columns, "mix_size", "mix_key", "mix_source_size", "mix_target", "mix_shards")


def _draw(narrow: DataFrame, sources: list[Source], shards: int, seed: int) -> DataFrame:
    """A row for each block: the shards its passes go to, and which of its rows one pass more takes."""
    blocks = _with_sources(narrow, sources).groupBy("source", "mix_block")
    of_source: dict = {source.name: {} for source in sources}
    for row in blocks.agg(F.sum("mix_size").alias("size")).collect():
        of_source[row["source"]][row["mix_block"]] = row["size"]

    rng = np.random.default_rng(seed)
    drawn, cuts = [], []  # for each source its blocks, as often as they are taken; its divided block
    for source in sources:
        own = of_source[source.name]
        order = [sorted(own)[n] for n in rng.permutation(len(own))]
        passes = floor(source.target / source.size + 1e-12) if source.size else 0
        rest, last, larger = source.target - passes * source.size, [], []
        for block in order:
            if own[block] <= rest:
                last.append(block)
                rest -= own[block]
            else:
                larger.append(block)
        divided = min(larger, key=own.get) if larger and rest >= 1 else None
        units = [block for _ in range(passes) for block in order] + last
        drawn.append(units + ([divided] if divided is not None else []))
        cuts.append((source.name, divided, rest))
    quotas = split_quotas([len(units) for units in drawn], shards, rng)

    found = _cut_keys(narrow, sources, [cut for cut in cuts if cut[1] is not None])
    rows = []
    for n, (source, units) in enumerate(zip(sources, drawn)):
        dealt = np.repeat(np.arange(shards), quotas[:, n]).tolist()
        by_block: dict = {}
        divided = cuts[n][1]
        part = dealt[-1] if divided is not None else None
        order = rng.permutation(len(dealt)) if divided is None else rng.permutation(len(dealt) - 1)
        for unit, place in enumerate(order.tolist()):
            by_block.setdefault(units[unit], []).append(dealt[place])
        for block in {*by_block, *([divided] if divided is not None else [])}:
            cut = found.get(source.name, (None, None)) if block == divided else (None, None)
            rows.append(
                (
                    source.name, block, sorted(by_block.get(block, [])),
                    part if block == divided else None, cut[0],
                    floor(cuts[n][2]) if block == divided else None, cut[1],
                )
            )
    return local_rows(
        narrow.sparkSession,
        rows,
        "plan_source string, plan_block int, plan_shards array<int>, cut_shard int, "
        "cut_key bigint, cut_size bigint, extra_key bigint",
    )


def _cut_keys(narrow: DataFrame, sources: list[Source], cuts: list[tuple]) -> dict:
    """For each divided block (last key taken, key of one more row): the rows up to a key whose
    words still fit, then the one row that comes nearest to what is missing."""
    if not cuts:
        return {}
    spark = narrow.sparkSession
    wanted = local_rows(
        spark,
        [(name, block, floor(rest)) for name, block, rest in cuts],
        "cut_source string, cut_block int, rest bigint",
    )
    same = F.col("source").eqNullSafe(F.col("cut_source")) & (F.col("mix_block") == F.col("cut_block"))
    rows = _with_sources(narrow, sources).join(F.broadcast(wanted), same)
    sums = rows.groupBy("source", "mix_key", "rest").agg(
        F.sum("mix_size").alias("size"), F.max("mix_size").alias("each")
    )
    # One block of each source: a bounded number of rows. Rows that are too large alone count not.
    along = Window.partitionBy("source").orderBy("mix_key")
    small = F.col("each") <= F.col("rest")
    sums = sums.withColumn("upto", F.sum(F.when(small, F.col("size")).otherwise(0)).over(along))
    sums = stored(sums, "cuts")
    fits = small & (F.col("upto") <= F.col("rest"))
    taken = sums.where(fits).groupBy("source", "rest").agg(
        F.max("mix_key").alias("key"), F.max("upto").alias("upto")
    )
    begun = {row["source"]: (row["key"], row["upto"]) for row in taken.collect()}
    missing = local_rows(
        spark,
        [(name, floor(rest) - begun.get(name, (None, 0))[1]) for name, _, rest in cuts],
        "cut_source string, missing bigint",
    )
    more = sums.where(~fits).join(F.broadcast(missing), F.col("source").eqNullSafe(F.col("cut_source")))
    gap = F.abs(F.col("missing") - F.col("size"))
    nearest = more.where(gap < F.col("missing")).groupBy("source").agg(
        F.min_by("mix_key", F.struct(gap, F.col("mix_key"))).alias("key")
    )
    extra = {row["source"]: row["key"] for row in nearest.collect()}
    return {name: (begun.get(name, (None, 0))[0], extra.get(name)) for name, _, _ in cuts}


def in_shards(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """A row for each copy that ``mixed`` takes, with its ``mix_shard``: shard by shard over the partitions,
    in an order of its own inside each. AQE takes the number of partitions from their size."""
    copies = rows.select("*", F.posexplode("mix_shards").alias("mix_copy", "mix_shard"))
    place = F.xxhash64(F.lit(seed + 1), "mix_key", "mix_copy")
    copies = copies.withColumn("mix_place", place)
    dealt = copies.repartitionByRange("mix_shard", "mix_place")
    ordered = dealt.sortWithinPartitions("mix_shard", "mix_place")
    return ordered.drop("mix_copy", "mix_place", "mix_shards", "mix_key")
