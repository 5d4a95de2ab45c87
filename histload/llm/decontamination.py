"""Benchmark passages in documents: a prefix-filtered join of windows, verified word by word.

A window is WINDOW consecutive words of an item (all words of a shorter item). A document that
contains it contains each of its words, so its rarest word over all documents is a necessary
prefix: only where a document has that word, a window can begin, at a known distance before. The
window must lie inside the document (position and length bounds); then its words are compared.
Everything is DataFrame functions. Word counts and candidates take one pass over the documents
each, in which words meet a broadcast of the benchmark; a benchmark over ``broadcast_bytes`` is
taken in blocks of that size, a pass for each. Texts are read once more to verify.

Defined results: a NULL or empty text has no words; an item without words has no windows. Items
with a NULL item_id mark words, but are not among the items of a document; rows with one item_id
are one item. Repeated documents have equal rows. An empty benchmark hits nothing. Columns other
than doc_id, text and item_id are not read.
"""

from __future__ import annotations

import string
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histload.llm.tables import BROADCAST_BYTES, byte_size, checkpointed, lookup, stored

WINDOW = 10
# Fixed value: what lies between words - all ASCII characters but digits and lower-case letters.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text, ASCII letters lower-cased."""
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, GAPS), "")


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, win): the windows of each item; ``win`` is their words, joined by spaces."""
    words = F.col("words")
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - size + 1, F.lit(1)))
    windows = F.transform(starts, lambda at: F.array_join(F.slice(words, at, size), " "))
    split = items.select("item_id", words_of(F.col("text")).alias("words"))
    return (
        split.where(F.size("words") > 0)
        .select(F.col("item_id").cast("string").alias("item_id"), F.explode(windows).alias("win"))
        .distinct()
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, items): for every row of ``docs`` (doc_id, text) its words,
    those inside a window of a ``benchmark`` item (item_id, text), and the items, sorted as text.
    ``text_hash`` is ``xxhash64(text)``."""
    docs = docs.select("doc_id", "text")
    owners = stored(item_windows(benchmark, size), "windows")
    prefixes = checkpointed(_prefixes(docs, owners.select("win").distinct(), broadcast_bytes))
    found = _candidates(docs, prefixes, broadcast_bytes)
    rows = stored(_verified(docs, found, broadcast_bytes), "hits")
    return _with_items(rows, owners)


def _blocks(df: DataFrame, key: str, width: Column, limit: int) -> list[DataFrame]:
    """``df`` in blocks of about ``limit`` bytes each, by hash of ``key``."""
    count = max(1, ceil(byte_size(df, width) / limit))
    if count == 1:
        return [df]
    return [df.where(F.pmod(F.xxhash64(key), F.lit(count)) == n) for n in range(count)]


def _prefixes(docs, windows, limit) -> DataFrame:
    """(word, win, offset, length) of each window that may occur: its rarest word, and where it is."""
    parts = F.posexplode(F.split("win", " ")).alias("offset", "word")
    words = windows.select("win", F.size(F.split("win", " ")).alias("length"), parts)
    words = stored(words, "window_words")
    vocabulary = words.select("word").distinct()
    in_docs = docs.select(F.explode(words_of(F.col("text"))).alias("word"))
    counts = [
        in_docs.join(F.broadcast(block), "word", "left_semi")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("count"))
        for block in _blocks(vocabulary, "word", F.octet_length("word") + 32, limit)
    ]
    counted = words.join(reduce(DataFrame.union, counts), "word", "left")
    rarity = F.struct(F.coalesce("count", F.lit(0)).alias("count"), "word", "offset")
    first = counted.groupBy("win", "length").agg(F.min(rarity).alias("first"))
    # A word that no document has rules its windows out.
    first = first.where(F.col("first.count") > 0)
    return first.select("first.word", "win", "first.offset", "length")


def _candidates(docs, prefixes, limit) -> DataFrame:
    """(key, found): the windows to verify in the documents with that hash of their text."""
    keyed = docs.select(F.xxhash64("text").alias("key"), words_of(F.col("text")).alias("words"))
    placed = keyed.select("key", F.size("words").alias("n"), F.posexplode("words").alias("pos", "word"))
    parts = []
    for block in _blocks(prefixes, "win", 2 * F.octet_length("win") + 64, limit):
        met = placed.join(F.broadcast(block), "word")
        begin = (F.col("pos") - F.col("offset")).alias("begin")
        parts.append(met.select("key", begin, "n", "length", "win"))
    inside = (F.col("begin") >= 0) & (F.col("begin") + F.col("length") <= F.col("n"))
    places = reduce(DataFrame.union, parts).where(inside).select("key", "begin", "length", "win")
    # Copies of a text have the same places; a text's places are no more than its row can hold.
    return stored(
        places.distinct()
        .groupBy("key")
        .agg(F.collect_list(F.struct("begin", "length", "win")).alias("found")),
        "candidates",
    )


def _verified(docs, found, limit) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, same, windows); ``same`` tells apart the texts that have hits."""
    width = F.aggregate("found", F.lit(64), lambda n, one: n + F.octet_length(one["win"]) + 48)
    size = byte_size(found, width)
    found = F.broadcast(found) if size <= limit else found
    keyed = docs.withColumn("key", F.xxhash64("text")).join(found, "key", "left")
    words = F.col("words")

    def is_there(one):
        passage = F.slice(words, one["begin"] + 1, one["length"])
        return F.array_join(passage, " ") == one["win"]

    def places(one):
        return F.sequence(one["begin"], one["begin"] + one["length"] - 1)

    hits = keyed.select("doc_id", "key", "text", "found", words_of(F.col("text")).alias("words")).select(
        "doc_id",
        F.col("key").alias("text_hash"),
        F.size("words").alias("n_words"),
        "text",
        F.when(F.col("found").isNotNull(), F.filter("found", is_there)).alias("hits"),
    )
    some = F.size("hits") > 0
    hit = F.size(F.array_distinct(F.flatten(F.transform("hits", places))))
    return hits.select(
        "doc_id",
        "text_hash",
        F.col("n_words").cast("long").alias("n_words"),
        F.when(some, hit).otherwise(0).cast("long").alias("n_hit"),
        F.when(some, F.sha2("text", 256)).alias("same"),
        F.when(some, F.array_distinct(F.transform("hits", lambda one: one["win"]))).alias("windows"),
    )


def _with_items(rows: DataFrame, owners: DataFrame) -> DataFrame:
    hit = rows.where(F.col("same").isNotNull())
    texts = hit.groupBy("same").agg(
        F.any_value("windows").alias("windows"), F.count(F.lit(1)).alias("copies")
    )
    pairs = texts.select("same", "copies", F.explode("windows").alias("win"))
    items = pairs.join(owners.where(F.col("item_id").isNotNull()), "win", "left")
    items = stored(
        items.groupBy("same", "copies").agg(F.array_sort(F.collect_set("item_id")).alias("items")),
        "items",
    )
    total = items.agg(F.sum("copies")).first()[0] or 0
    known = lookup(hit.drop("windows"), items, ["same"], F.col("copies"), total, "inner")
    names = ["doc_id", "text_hash", "n_words", "n_hit", "items"]
    none = rows.where(F.col("same").isNull()).withColumn("items", F.array().cast("array<string>"))
    return none.select(*names).unionByName(known.select(*names))
