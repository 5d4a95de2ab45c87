"""Near-duplicates by Order MinHash, verified by banded alignment.

A text is its sequence of five-word shingles; equal shingles are told apart by their number of
occurrence. A sketch takes the LENGTH smallest shingles under one hash function and keeps them in
text order, so it survives edits but not a change of order. Two texts with an equal sketch are
candidates. They are linked if the longest common subsequence of their shingle sequences, found
by alignment inside the band that a link allows, has THRESHOLD or more of their united number.
Classes are the connected components of all links.

A bucket of texts with one sketch is not paired out. One of its texts, the leader, is compared with all others;
nearly all links are found so. The texts of buckets that are still divided into several classes (texts that share
a passage and no more, copies with more edits than a link allows) then meet in other buckets, by an exact bound:
linked texts share THRESHOLD of the shingles of either, so also one of the first ones of each, short of that share, in
any order common to all. Rare shingles come first in it, so a passage brings few texts together. Shingles of one text
alone cannot be shared: the number of the others from the place on bounds the size of a text that may be linked, so
that texts with too many edits of their own, or at a late place, leave their buckets before any pair is made. What
is left is mostly linked. Rounds of leaders, a few of each bucket's largest class, meet the texts of the others, and the
rest meets at once when that is COMPARED pairs for each member at most. Before a pair is made, a second exact bound
is asked: every shingle flips one of BITS bits of its text, so texts differ in at least as many shingles as in bits, and
linked texts differ in few. Copies with many edits each, of which few pairs are linked, are told apart by it without
their shingles. So in the end every pair of a bucket is in one class, compared or beyond a bound; none is left out
otherwise, and no round makes pairs with the square of a bucket, but of linked texts of different classes.

Defined results: words as in ``words``. Texts with equal words are one text in all that follows, and
texts without words (NULL, empty) are all equal. Texts of one to four words are one shingle.
The class id is the smallest doc_id in the class, NULL if all are NULL; repeated rows are in one
class. An empty table has no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histload.llm.components import LABEL_BYTES, counted_components
from histload.llm.tables import byte_size, checkpointed, lookup, maybe_broadcast, small_arrow_batches, stored
from histload.llm.words import find_words, mixed, small_batches, text_bytes

SHINGLE, THRESHOLD = 5, 0.8
SKETCHES, LENGTH = 14, 3
# Leaders of a bucket in each round, the first one being of sketches; later ones have MORE times as many.
LEADERS, MORE = (1, 4, 16), 4
COMPARED = 512  # pairs for each member of a bucket, at which the bits of all that is left are compared
BITS = 1024  # a text's parity bits, in columns of 64
PARITY_BYTES = 64 + BITS // 8  # of a text's bits in a broadcast
SPLIT_OVER = 1  # texts of a divided bucket of one sketch that is split
# Ids of texts to verify are broadcast to the scan up to this size, else joined by shuffle.
ID_BYTES, BROADCAST_BYTES = 64, 64 << 20

BATCH_BYTES = 1 << 20  # of text at once: a worker keeps what numpy took for its largest batch

_LAST = np.uint64(2**64 - 1)
_SALTS = np.random.default_rng(77).integers(1, 2**63, 64, dtype=np.uint64) * 2 + 1


class Shingles:
    """Shingles of a text column: ``hashes`` in order, ``bounds`` of each text's shingles."""

    def __init__(self, column: pa.Array):
        words = find_words(*text_bytes(column))
        self.words = words
        counts = np.diff(words.bounds)
        sizes = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
        self.bounds = np.concatenate(([0], np.cumsum(sizes)))
        first = np.repeat(words.bounds[:-1], sizes)
        place = first + np.arange(len(first)) - np.repeat(self.bounds[:-1], sizes)
        stop = np.minimum(place + SHINGLE, np.repeat(words.bounds[1:], sizes))
        total = (stop - place).astype(np.uint64)
        padded = np.concatenate((words.hashes, np.zeros(SHINGLE, np.uint64)))
        for k in range(SHINGLE):
            total = total + np.where(place + k < stop, padded[place + k], 0) * _SALTS[k]
        self.hashes = mixed(total)

    def labelled(self) -> np.ndarray:
        """Hashes in which the n-th occurrence of a shingle in its text differs from the others."""
        return _labelled(self.hashes, self.bounds)


def _labelled(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)).astype(np.uint64)
    keys = mixed(hashes + owner * _SALTS[8])
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    opens = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(keys) else np.zeros(0, bool)
    runs = np.flatnonzero(opens)
    number = np.arange(len(keys)) - np.repeat(runs, np.diff(np.append(runs, len(keys))))
    occurrence = np.empty(len(keys), np.uint64)
    occurrence[order] = number.astype(np.uint64)
    return np.where(occurrence == 0, hashes, mixed(hashes + occurrence * _SALTS[9]))


def sketches(shingles: Shingles) -> tuple[np.ndarray, np.ndarray]:
    """(texts that have shingles, their sketches as rows of SKETCHES values)."""
    sizes = np.diff(shingles.bounds)
    texts = np.flatnonzero(sizes)
    labelled = shingles.labelled()
    if not len(texts):
        return texts, np.zeros((0, SKETCHES), np.uint64)
    starts, sizes = shingles.bounds[:-1][texts], sizes[texts]
    out = np.empty((len(texts), SKETCHES), np.uint64)
    for s in range(SKETCHES):
        values = (labelled ^ _SALTS[16 + s]) * _SALTS[32 + s]
        values ^= values >> np.uint64(29)
        places = np.full((len(texts), LENGTH), len(labelled))
        for j in range(LENGTH):
            lowest = np.minimum.reduceat(values, starts)
            found = np.flatnonzero(values == np.repeat(lowest, sizes))
            row = np.searchsorted(starts, found, "right") - 1
            fresh = lowest[row] != _LAST
            places[row[fresh], j] = found[fresh]
            values[found] = _LAST
        places.sort(axis=1)
        padded = np.append(labelled, np.uint64(0))
        total = np.full(len(texts), s, np.uint64)
        for j in range(LENGTH):
            total = total + padded[places[:, j]] * _SALTS[10 + j]
        out[:, s] = mixed(total)
    return texts, out


def _digests(words) -> list[bytes]:
    raw = words.hashes.tobytes()
    return [
        hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest()
        for a, b in zip(words.bounds[:-1], words.bounds[1:])
    ]


def _sketch_rows(batches):
    for batch in small_batches(batches, "text", BATCH_BYTES):
        shingles = Shingles(batch.column("text"))
        texts, values = sketches(shingles)
        sizes = np.zeros(batch.num_rows, np.int64)
        sizes[texts] = SKETCHES
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()),
            pa.array(values.ravel().view(np.int64)),
        )
        digests = pa.array(_digests(shingles.words), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), digests, lists],
            names=["doc_id", "text_hash", "digest", "sketches"],
        )


_PARITY = [f"parity_{n}" for n in range(BITS // 64)]


def parity(shingles: Shingles) -> np.ndarray:
    """BITS bits of each text as rows of 64-bit numbers: each of its shingles flips one. The texts have at least as
    many shingles that are not common to both, by number of occurrence, as they differ in bits."""
    values = mixed(shingles.labelled() ^ _SALTS[11])
    columns = BITS // 64
    out = np.zeros((len(shingles.bounds) - 1, columns), np.uint64)
    owner = np.repeat(np.arange(len(out)), np.diff(shingles.bounds))
    place = owner * columns + ((values >> np.uint64(6)) % np.uint64(columns)).astype(np.int64)
    np.bitwise_xor.at(out.ravel(), place, np.uint64(1) << (values & np.uint64(63)))
    return out


def _shingle_rows(batches):
    """(node, shingle hashes, their number, parity) of the texts whose digest is the wanted one."""
    for batch in small_batches(batches, "text", BATCH_BYTES):
        shingles = Shingles(batch.column("text"))
        raw = shingles.hashes.tobytes()
        cuts = shingles.bounds * 8
        digests = _digests(shingles.words)
        wanted = batch.column("digest").to_pylist()
        kept = [i for i, digest in enumerate(digests) if digest == wanted[i]]
        bits = parity(shingles).view(np.int64)[kept]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("node").take(pa.array(kept, pa.int64())),
                pa.array([raw[cuts[i] : cuts[i + 1]] for i in kept], pa.binary()),
                pa.array(np.diff(shingles.bounds)[kept].astype(np.int32)),
                *(pa.array(np.ascontiguousarray(column)) for column in bits.T),
            ],
            names=["node", "shingles", "total", *_PARITY],
        )


def similar(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> bool:
    """Whether the common subsequence of two shingle sequences reaches ``threshold``."""
    if not len(a) or not len(b):
        return len(a) == len(b)
    need = ceil(threshold * (len(a) + len(b)) / (1 + threshold) - 1e-9)
    if min(len(a), len(b)) < need:
        return False
    # Equal ends belong to a longest common subsequence.
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b, short = a[head:], b[head:], short - head
    differ = np.flatnonzero(a[len(a) - short :][::-1] != b[len(b) - short :][::-1])
    tail = int(differ[0]) if len(differ) else short
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    need -= head + tail
    if need <= 0:
        return True
    values, counts = np.unique(b, return_counts=True)
    own, own_counts = np.unique(a, return_counts=True)
    both, at, own_at = np.intersect1d(values, own, assume_unique=True, return_indices=True)
    if np.minimum(counts[at], own_counts[own_at]).sum() < need:
        return False
    return _common(a, b, set(both.tolist()), len(a) + len(b) - 2 * need) >= need


def _common(a: np.ndarray, b: np.ndarray, both: set, band: int) -> int:
    """Length of the longest common subsequence along diagonals within ``band``, a row at a time;
    the bits of a number are the columns, a zero bit is a step of the length."""
    columns: dict[int, int] = {}
    for j, value in enumerate(b.tolist()):
        if value in both:
            columns[value] = columns.get(value, 0) | 1 << j
    whole = (1 << len(b)) - 1
    width = (1 << (2 * band + 1)) - 1
    row = whole
    for i, value in enumerate(a.tolist()):
        hits = columns.get(value)
        if hits is None:
            continue
        inside = width << (i - band) if i >= band else width >> (band - i)
        met = row & hits & inside
        row = ((row + met) | (row - met)) & whole
    return len(b) - row.bit_count()


def _verified(batches):
    for batch in batches:
        left, right = batch.column("left_shingles"), batch.column("right_shingles")
        linked = [
            similar(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64))
            for a, b in zip(left, right)
        ]
        keep = pa.array(linked, pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"]
        )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, class_id, class_size, kept): a row for every row of ``docs`` (doc_id, text).

    ``text_hash`` is ``xxhash64(text)``. One document of each class is ``kept``; if the table has equal
    rows of it, all of them are.
    """
    spark = docs.sparkSession
    small_arrow_batches(spark)
    docs = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    ddl = f"doc_id {id_type}, text_hash bigint, digest binary, sketches array<bigint>"
    rows = stored(hashed.mapInArrow(_sketch_rows, ddl), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))
    texts = rows.groupBy("digest").agg(
        first.alias("first"),
        F.count(F.lit(1)).alias("copies"),
        F.first("sketches").alias("sketches"),
    )
    texts = stored(texts.withColumn("node", F.monotonically_increasing_id()), "texts")
    every = texts.select("node", F.explode("sketches").alias("bucket"))
    shared = every.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"))
    shared = stored(shared.where(F.col("members") > 1), "buckets")
    total = shared.agg(F.sum("members")).first()[0] or 0
    buckets = stored(
        lookup(every, shared, ["bucket"], F.col("members"), total, "inner").select("bucket", "node"),
        "members",
    )
    shingles = _candidate_shingles(docs, texts, buckets)
    labels = _labels(spark, buckets, shingles)
    return _classes(rows, texts, labels)


def _candidate_shingles(docs, texts, buckets) -> DataFrame:
    """Shingles of each text that shares a bucket."""
    wanted = buckets.select("node").distinct().join(texts, "node")
    wanted = checkpointed(wanted.select("node", "digest", "first.doc_id", "first.text_hash"))
    width = F.lit(ID_BYTES) + F.coalesce(F.octet_length(F.col("doc_id").cast("string")), F.lit(0))
    small = byte_size(wanted, width) <= BROADCAST_BYTES
    wanted = F.broadcast(wanted) if small else wanted
    # The hash as well as the id: many rows may have no id.
    same = docs["doc_id"].eqNullSafe(wanted["doc_id"]) & (F.xxhash64(docs["text"]) == wanted["text_hash"])
    found = docs.join(wanted, same)
    found = found.select("text", "node", "digest")
    ddl = "node bigint, shingles binary, total int, " + ", ".join(f"{name} bigint" for name in _PARITY)
    found = found.mapInArrow(_shingle_rows, ddl)
    return stored(found.dropDuplicates(["node"]), "shingles")


def _labels(spark, buckets, shingles) -> DataFrame:
    """(``node``, ``label``) of all texts with links, which are found in rounds (see above)."""
    parts, labels, rows = [], None, 0
    texts = byte_size(shingles, F.lit(PARITY_BYTES))
    schedule = list(LEADERS)
    members = _bounded(buckets)
    while True:
        members = _divided(members, labels, rows)
        if members.isEmpty():
            break
        if len(parts) == 1:
            members = _divided(_split(members, shingles, SPLIT_OVER), labels, rows)
        count = schedule.pop(0) if schedule else MORE * count
        # What is left meets at once if that is so many pairs a member at most; leaders have linked most by then.
        last = len(parts) > 1 and _few_pairs(members)
        leaders = _of_smaller_classes(members) if last else _leaders(members, count, labels is None)
        met = _with_parity(members, shingles, texts, "")
        pairs = met.join(_with_parity(leaders, shingles, texts, "leader_"), "bucket").where(
            (F.col("label") != F.col("own"))
            & (F.col("size") <= F.col("leader_reach"))
            & (F.col("leader_size") <= F.col("reach"))
            & _may_be_linked("", "leader_")
        )
        pairs = pairs.select(
            F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")
        ).distinct()
        # A round's links outlive it as files in the shared folder.
        links = stored(_verify(pairs, shingles), "links")
        if labels is None or not links.isEmpty():
            labels, rows = counted_components(reduce(DataFrame.union, [*parts, links]))
        parts.append(links)
        if last:
            break
        # A leader has met its whole bucket.
        met = leaders.select("bucket", F.col("leader").alias("node"))
        members = members.join(met, ["bucket", "node"], "left_anti")
    return labels if labels is not None else spark.createDataFrame([], "node bigint, label bigint")


def _with_parity(rows: DataFrame, shingles: DataFrame, size: int, prefix: str) -> DataFrame:
    """``rows`` (with ``node``, or ``leader``) with the number of shingles and the parity of each text; these are
    broadcast if their ``size`` allows it."""
    names = {name: f"{prefix}{name}" for name in ("total", *_PARITY)}
    node = "leader" if prefix else "node"
    bits = shingles.select(F.col("node").alias(node), *names).withColumnsRenamed(names)
    return rows.join(maybe_broadcast(bits, size), node)


def _may_be_linked(left: str, right: str) -> Column:
    """Whether the bits of two texts allow them to have THRESHOLD of their shingles in common."""
    differ = reduce(
        lambda a, b: a + b,
        (F.bit_count(F.col(f"{left}{name}").bitwiseXOR(F.col(f"{right}{name}"))) for name in _PARITY),
    )
    both = F.col(f"{left}total") + F.col(f"{right}total")
    # Linked texts of m and n shingles share THRESHOLD / (1 + THRESHOLD) of m + n.
    return differ <= both * F.lit((1 - THRESHOLD) / (1 + THRESHOLD)) + 1e-6


def _few_pairs(members: DataFrame) -> bool:
    """Whether the pairs of different classes in all buckets are COMPARED a member at most."""
    classes = members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("texts"))
    texts = F.col("texts").cast("double")
    buckets = classes.groupBy("bucket").agg(F.sum(texts).alias("texts"), F.sum(texts * texts).alias("same"))
    row = buckets.agg(F.sum("texts").alias("members"), F.sum((texts * texts - F.col("same")) / 2).alias("pairs")).first()
    return (row["pairs"] or 0) <= COMPARED * (row["members"] or 0)


def _bounded(members: DataFrame) -> DataFrame:
    """Members (bucket, node) with a ``size`` and a ``reach`` that bound nothing."""
    return members.select("bucket", "node", F.lit(0).alias("size"), F.lit(2**31 - 1).alias("reach"))


def _divided(members: DataFrame, labels: DataFrame | None, rows: int = 0) -> DataFrame:
    """Members, with the ``label`` of their class so far, of the buckets with several classes, without those
    whose ``reach`` is below every size in their bucket. ``labels`` has ``rows`` rows."""
    columns = ("bucket", "node", "size", "reach")
    if labels is None:
        return members.select(*columns, F.col("node").alias("label"))
    labels = maybe_broadcast(labels, rows * LABEL_BYTES)
    members = members.select(*columns).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    for _ in range(2):  # what goes first may leave a bucket undivided
        several = members.groupBy("bucket").agg(
            F.min("label").alias("low"), F.max("label").alias("high"),
            F.min("size").alias("least"), F.max("reach").alias("most"),
        )
        several = several.where("low != high").drop("low", "high")
        inside = (F.col("reach") >= F.col("least")) & (F.col("size") <= F.col("most"))
        members = checkpointed(members.join(several, "bucket").where(inside).drop("least", "most"))
    return members


def _leaders(members: DataFrame, count: int, first: bool) -> DataFrame:
    """(``bucket``, ``leader``, ``own``, ``leader_size``, ``leader_reach``): members of each bucket's largest
    classes, which meet those of all others. In the first round every text is a class of its own, and one leads."""
    if first:
        lead = members.groupBy("bucket").agg(F.min(F.struct("node", "label", "size", "reach")).alias("lead"))
        return _as_leaders(lead.select("bucket", "lead.*"))
    sizes = members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("texts"))
    order = Window.partitionBy("bucket").orderBy(F.desc("texts"), F.xxhash64("node"), "node")
    ranked = members.join(sizes, ["bucket", "label"]).withColumn("place", F.row_number().over(order))
    return _as_leaders(ranked.where(F.col("place") <= count))


def _of_smaller_classes(members: DataFrame) -> DataFrame:
    """All members but those of each bucket's largest class, as leaders: every pair of different classes has one
    of them, and they meet no more than twice the members of other classes."""
    sizes = members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("texts"))
    largest = sizes.groupBy("bucket").agg(F.max_by("label", F.struct("texts", "label")).alias("largest"))
    return _as_leaders(members.join(largest, "bucket").where(F.col("label") != F.col("largest")))


def _as_leaders(members: DataFrame) -> DataFrame:
    return members.select(
        "bucket", F.col("node").alias("leader"), F.col("label").alias("own"),
        F.col("size").alias("leader_size"), F.col("reach").alias("leader_reach"),
    )


def _verify(pairs: DataFrame, shingles: DataFrame) -> DataFrame:
    right = shingles.select(F.col("node").alias("b"), F.col("shingles").alias("right_shingles"))
    left = shingles.select(F.col("node").alias("a"), F.col("shingles").alias("left_shingles"))
    # A leader of many pairs is one row of ``left``; AQE splits the other side of its join.
    return pairs.join(right, "b").join(left, "a").mapInArrow(_verified, "a bigint, b bigint")


def _split(divided: DataFrame, shingles: DataFrame, limit: int) -> DataFrame:
    """(bucket, node, size, reach): buckets with up to ``limit`` members as they are, and for all others
    those of their texts' first shingles. ``reach`` bounds the size of texts linked by way of a bucket."""
    sizes = divided.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"))
    large = checkpointed(sizes.where(F.col("members") > limit).select("bucket"))
    small = _bounded(divided.join(large, "bucket", "left_anti"))
    nodes = divided.join(large, "bucket", "left_semi").select("node").distinct()
    ones = nodes.join(shingles.select("node", "shingles"), "node").mapInArrow(_single_rows, "node bigint, size int, shingle bigint")
    ones = stored(ones, "single")
    shared = ones.groupBy("shingle").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    shared = stored(shared, "shared")
    total = shared.agg(F.sum("texts")).first()[0] or 0
    ones = lookup(ones, shared, ["shingle"], F.col("texts"), total, "inner")
    # Shingles that no other text has come first; they bring nothing together and cannot be shared.
    own = Window.partitionBy("node")
    ones = ones.withColumn("place", F.row_number().over(own.orderBy("texts", "shingle")))
    ones = ones.withColumn("left", F.count(F.lit(1)).over(own) - F.col("place") + 1)
    # Texts of sizes m and n are linked if they share THRESHOLD / (1 + THRESHOLD) of m + n.
    reach = F.floor(F.col("left") * F.lit((1 + THRESHOLD) / THRESHOLD) - F.col("size") + 1e-6)
    first = ones.where(F.col("left") >= F.col("size") * F.lit(THRESHOLD) - 1e-9)
    first = first.select(F.col("shingle").alias("bucket"), "node", "size", reach.cast("int").alias("reach"))
    first = stored(first, "first")
    several = first.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    return stored(small.union(first.join(several.select("bucket"), "bucket")), "split")


def _single_rows(batches):
    """(node, number of its shingles, shingle) for each shingle."""
    for batch in batches:
        for node, raw in zip(batch.column("node").to_pylist(), batch.column("shingles")):
            hashes = np.frombuffer(raw.as_buffer(), np.uint64)
            size = len(hashes)
            labelled = _labelled(hashes, np.array([0, size])).view(np.int64)
            columns = [np.full(size, node), np.full(size, size, np.int32), labelled]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column) for column in columns], names=["node", "size", "shingle"]
            )


def _classes(rows: DataFrame, texts: DataFrame, labels: DataFrame) -> DataFrame:
    labelled = texts.select("node", "digest", "first", "copies").join(labels, "node", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "node"))
    sums = labelled.groupBy("label").agg(
        F.min("first").alias("lead"),
        F.sum("copies").alias("class_size"),
        F.count(F.lit(1)).alias("texts"),
    )
    sums = checkpointed(sums)
    total = rows.count()
    per_text = lookup(labelled, sums, ["label"], F.col("texts"), total, "inner")
    per_text = stored(per_text.select("digest", "copies", "lead", "class_size"), "classes")
    rows = rows.select("doc_id", "text_hash", "digest")
    out = lookup(rows, per_text, ["digest"], F.col("copies"), total, "inner")
    kept = F.col("doc_id").eqNullSafe(F.col("lead.doc_id")) & (F.col("text_hash") == F.col("lead.text_hash"))
    class_id = F.col("lead.doc_id").alias("class_id")
    return out.select("doc_id", "text_hash", class_id, "class_size", kept.alias("kept"))
