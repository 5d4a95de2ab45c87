"""Collocations of each language, from exact n-gram counts in counting quotient filters.

A word of a language is a 64-bit id, an n-gram the ids of its words side by side. An invertible permutation
spreads this number over all bits; its first QUOTIENT bits are the quotient, all others the remainder, which is
kept in full. A filter is the sorted list of its n-grams: gaps between the quotients in use, the run of each, and
per n-gram remainder and counter. So a filter loses nothing: permuting back gives the ids. Tasks fill filters from
their own texts, cut by leading bits into buckets, and sorted filters of a bucket are merged bucket by bucket.
A frequent n-gram is one counter a filter, so no n-gram is hot.

Ids are hashes. That no two words share one is checked over all words of the table, else another salt is taken.
A phrase is no more frequent than its parts, so pairs are counted of frequent words, and triples where both of
their pairs are frequent. That is told by bits of a fixed bound that are broadcast (a bit may be set by another
word or pair; then an n-gram is counted in vain and dropped).

Defined results: A-Z are lower-cased, texts cut into pieces at ``.,;:!?`` and line ends, pieces into words at blanks
and tabs. A NULL language is ``und``, a NULL text has no words, repeated rows are counted each. Ties are ranked by
phrase in byte order. An empty table has no rows. Columns other than text and lang are not read.
"""

from __future__ import annotations

import struct
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histload.llm.tables import byte_size, maybe_broadcast, small_arrow_batches, stored
from histload.llm.words import mixed, small_batches

LEAST, TOP = 10, 2000
COVERED = 50  # per cent of a phrase's occurrences inside a longer one at which it goes
NO_LANG = "und"

QUOTIENT = 24  # bits of the quotient; 40 bits of the first id remain
BUCKETS_PER_TASK, MOST_BUCKETS = 4, 1 << 20
LOCAL_BITS = 21  # of a word's number inside a task
SLICE = 1 << 18  # words counted at a time
WORDS_HELD = 200_000  # words a task counts, or numbers, before it hands on what it has
HELD = 2 << 20  # n-grams a task keeps before it merges them, and hands them on when half are different
BITS_PER_ENTRY, MOST_BITS = 16, 1 << 29

# Piece ends become a full stop, which no word has, and tabs blanks.
_CUTS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"." * 10 + b" ")
_KEYS = np.random.default_rng(41).integers(1, 2**63, 16, dtype=np.uint64) * 2 + 1
_LOW = np.uint64((1 << (64 - QUOTIENT)) - 1)

Bits = tuple[bytes, int]  # a table of bits and the number of leading bits of a number that tell its place


def permuted(columns: list[np.ndarray], back: bool = False) -> list[np.ndarray]:
    """N-grams, a uint64 column for each word, spread over all bits; ``back`` undoes it. Every round adds a
    mix of the other columns to one of them."""
    columns = list(columns)
    rounds = range(2 * len(columns))
    for n in reversed(rounds) if back else rounds:
        own = n % len(columns)
        total = np.full(len(columns[0]), _KEYS[n], np.uint64)
        for k, column in enumerate(columns):
            if k != own:
                total = mixed(total + column * _KEYS[8 + k])
        columns[own] = columns[own] ^ total
    return columns


def varints(values: np.ndarray) -> bytes:
    """Numbers in groups of seven bits, lowest first, the eighth bit set but in the last one."""
    values = values.astype(np.uint64)
    if not len(values):
        return b""
    width = max(1, -(-int(values.max()).bit_length() // 7))
    groups = (values[:, None] >> (np.arange(width, dtype=np.uint64) * np.uint64(7))) & np.uint64(127)
    later = np.cumsum(groups[:, ::-1] != 0, axis=1)[:, ::-1] > 0  # this group or a later one is in use
    later[:, 0] = True
    groups = groups.astype(np.uint8)
    groups[:, :-1] |= later[:, 1:].astype(np.uint8) << 7
    return groups[later].tobytes()


def from_varints(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    starts = np.concatenate(([0], np.flatnonzero(data < 128)[:-1] + 1))
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    parts = (data & 127).astype(np.uint64) << (place.astype(np.uint64) * np.uint64(7))
    return np.add.reduceat(parts, starts)


def pack_filter(columns: list[np.ndarray], counts: np.ndarray) -> bytes:
    """A filter of permuted n-grams, sorted and without repeats."""
    quotients = columns[0] >> np.uint64(64 - QUOTIENT)
    slots, runs = np.unique(quotients, return_counts=True)
    low = np.ascontiguousarray((columns[0] & _LOW).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : 8 - QUOTIENT // 8])
    parts = [varints(np.diff(slots, prepend=0)), varints(runs), varints(counts), low.tobytes()]
    parts += [column.astype("<u8").tobytes() for column in columns[1:]]
    head = struct.pack("<IIIII", len(counts), len(columns), *map(len, parts[:3]))
    return head + b"".join(parts)


def unpack_filter(raw: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    """(columns of the permuted n-grams, counts) of a filter."""
    total, order, *sizes = struct.unpack_from("<IIIII", raw)
    at, parts = 20, []
    for size in sizes:
        parts.append(from_varints(raw[at : at + size]))
        at += size
    slots, runs, counts = np.cumsum(parts[0]), parts[1].astype(np.int64), parts[2]
    width = 8 - QUOTIENT // 8
    low = np.zeros((total, 8), np.uint8)
    low[:, :width] = np.frombuffer(raw, np.uint8, total * width, at).reshape(-1, width)
    first = np.repeat(slots, runs) << np.uint64(64 - QUOTIENT) | low.view("<u8").ravel()
    at += total * width
    rest = [np.frombuffer(raw, "<u8", total, at + 8 * total * k) for k in range(order - 1)]
    return [first, *rest], counts.astype(np.int64)


def merged(filters: list[tuple[list[np.ndarray], np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted filters as one, counts of equal n-grams added."""
    columns = [np.concatenate(parts) for parts in zip(*(columns for columns, _ in filters))]
    counts = np.concatenate([counts for _, counts in filters])
    order = np.argsort(columns[0], kind="stable")
    columns, counts = [column[order] for column in columns], counts[order]
    if not len(counts):
        return columns, counts
    tied = columns[0][1:] == columns[0][:-1]
    same = tied.copy()
    for column in columns[1:]:
        same &= column[1:] == column[:-1]
    if (tied & ~same).any():  # different n-grams with the same first column, perhaps not side by side
        order = np.lexsort(columns[::-1])
        columns, counts = [column[order] for column in columns], counts[order]
        same = np.logical_and.reduce([column[1:] == column[:-1] for column in columns])
    starts = np.flatnonzero(np.concatenate(([True], ~same)))
    return [column[starts] for column in columns], np.add.reduceat(counts, starts)


def word_id(lang: str, word: bytes, salt: int) -> int:
    import xxhash

    lang = lang.encode()
    return xxhash.xxh64_intdigest(b"%d:%b%b" % (len(lang), lang, word), salt)


def _tokens(batches):
    """(lang, words of its texts in a batch, a full stop at the end of each piece)."""
    for batch in small_batches(batches, "text"):
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            by_lang.setdefault(lang, []).append(text.encode())
        for lang, texts in by_lang.items():
            data = b".".join(texts).lower().translate(_CUTS)
            yield lang, data.replace(b".", b" . ").split()


def _count_words(batches):
    """Texts to (lang, word, n), counted by task."""
    counts: dict[str, Counter] = {}
    for lang, tokens in _tokens(batches):
        counts.setdefault(lang, Counter()).update(tokens)
        if sum(map(len, counts.values())) > WORDS_HELD:
            yield from _word_rows(counts)
            counts = {}
    yield from _word_rows(counts)


def _word_rows(counts: dict[str, Counter]):
    for lang, own in counts.items():
        own.pop(b".", None)
        words = list(own)
        for first in range(0, len(words), 50_000):
            part = words[first : first + 50_000]
            columns = [
                pa.array([lang] * len(part), pa.string()),
                pa.array([word.decode() for word in part], pa.string()),
                pa.array([own[word] for word in part], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "n"])


class _WithIds:
    """(lang, word, f) with the word's id."""

    def __init__(self, salt: int):
        self.salt = salt

    def __call__(self, batches):
        for batch in batches:
            rows = zip(batch.column("lang").to_pylist(), batch.column("word").to_pylist())
            ids = np.array([word_id(lang, word.encode(), self.salt) for lang, word in rows], np.uint64)
            columns = [pa.array(ids.view(np.int64)), *(batch.column(c) for c in ("lang", "word", "f"))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "lang", "word", "f"])


class _Numbers(dict):
    """Frequent words of a language to their numbers in a task; a piece's end and other words are 0."""

    def __init__(self, lang: str, ids: list[int], salt: int, bits: Bits):
        super().__init__({b".": 0})
        self.lang, self.ids, self.salt, (self.bits, width) = lang, ids, salt, bits
        self.shift = 64 - width

    def __missing__(self, word: bytes) -> int:
        own = word_id(self.lang, word, self.salt)
        at = own >> self.shift
        if not self.bits[at >> 3] >> (at & 7) & 1:
            return 0  # and is not kept
        number = self[word] = len(self.ids)
        self.ids.append(own)
        return number


class _Filler:
    """Texts to rows of filters of their n-grams, by bucket."""

    def __init__(self, order: int, salt: int, bucket_bits: int, words: Bits, pairs: Bits | None = None):
        self.order, self.salt, self.bucket_bits = order, salt, bucket_bits
        self.word_bits, self.pair_bits = words, pairs

    def __call__(self, batches):
        self._reset()
        for lang, tokens in _tokens(batches):
            for first in range(0, len(tokens), SLICE):
                if len(self.ids) > WORDS_HELD or self.held > HELD // 2:
                    yield from self._rows()
                    self._reset()
                # The first words of the next slice end n-grams that begin in this one.
                self._count(lang, tokens[first : first + SLICE + self.order - 1])
        yield from self._rows()

    def _reset(self) -> None:
        self.ids: list[int] = [0]
        self.numbers: dict[str, _Numbers] = {}
        self.pending: list[np.ndarray] = []
        self.waiting = self.held = 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def _count(self, lang: str, tokens: list[bytes]) -> None:
        if lang not in self.numbers:
            self.numbers[lang] = _Numbers(lang, self.ids, self.salt, self.word_bits)
        numbers = np.fromiter(map(self.numbers[lang].__getitem__, tokens), np.uint64, len(tokens))
        size = len(numbers) - self.order + 1
        if size <= 0:
            return
        keys, inside = np.zeros(size, np.uint64), np.ones(size, bool)
        for k in range(self.order):
            part = numbers[k : k + size]
            keys = keys << np.uint64(LOCAL_BITS) | part
            inside &= part > 0
        self.pending.append(keys[inside])
        self.waiting += len(self.pending[-1])
        if self.waiting > HELD:
            self._merge()

    def _merge(self) -> None:
        if self.pending:
            keys, counts = np.unique(np.concatenate(self.pending), return_counts=True)
            self.pending, self.waiting = [], 0
            (self.keys,), self.counts = merged([([self.keys], self.counts), ([keys], counts)])
        self.held = len(self.keys)

    def _rows(self):
        self._merge()
        ids = np.array(self.ids, np.uint64)
        mask = np.uint64((1 << LOCAL_BITS) - 1)
        shifts = [np.uint64(LOCAL_BITS * (self.order - 1 - k)) for k in range(self.order)]
        parts = [(self.keys >> shift) & mask for shift in shifts]
        counts = self.counts
        if self.pair_bits is not None:
            frequent = self._are_frequent(ids, parts[0], parts[1]) & self._are_frequent(ids, parts[1], parts[2])
            parts, counts = [part[frequent] for part in parts], counts[frequent]
        columns, counts = merged([(permuted([ids[part] for part in parts]), counts)])
        buckets = (columns[0] >> np.uint64(64 - self.bucket_bits)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(buckets, prepend=-1))
        for first, last in zip(cuts, [*cuts[1:], len(buckets)]):
            raw = pack_filter([column[first:last] for column in columns], counts[first:last])
            yield pa.RecordBatch.from_arrays(
                [pa.array([buckets[first]], pa.int32()), pa.array([raw], pa.binary())], names=["bucket", "filter"]
            )

    def _are_frequent(self, ids, left, right) -> np.ndarray:
        pairs, back = np.unique(left << np.uint64(LOCAL_BITS) | right, return_inverse=True)
        left, right = pairs >> np.uint64(LOCAL_BITS), pairs & np.uint64((1 << LOCAL_BITS) - 1)
        raw, width = self.pair_bits
        at = permuted([ids[left], ids[right]])[0] >> np.uint64(64 - width)
        bits = np.frombuffer(raw, np.uint8)[at >> np.uint64(3)]
        return (bits >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)[back]


class _Merger:
    """Filters, each bucket's together, to the n-grams with ``least`` occurrences: ids of words and ``f``."""

    def __init__(self, order: int, least: int):
        self.order, self.least = order, least

    def __call__(self, batches):
        bucket, waiting, size = None, [], 0
        for batch in batches:
            for number, raw in zip(batch.column("bucket").to_pylist(), batch.column("filter")):
                if number != bucket and waiting:
                    yield self._frequent(merged(waiting))
                    waiting, size = [], 0
                bucket = number
                waiting.append(unpack_filter(raw.as_py()))
                size += len(waiting[-1][1])
                if size > HELD:
                    waiting = [merged(waiting)]
                    size = len(waiting[0][1]) // 2  # merged again once as much has come
        if waiting:
            yield self._frequent(merged(waiting))

    def _frequent(self, found) -> pa.RecordBatch:
        columns, counts = found
        keep = counts >= self.least
        ids = permuted([column[keep] for column in columns], back=True)
        arrays = [pa.array(column.view(np.int64)) for column in ids]
        return pa.RecordBatch.from_arrays(
            [*arrays, pa.array(counts[keep])], names=["a", "b", "c"][: self.order] + ["f"]
        )


def _merge_filters(filters: DataFrame, order: int, least: int, name: str) -> DataFrame:
    ddl = ", ".join(f"{c} long" for c in ["a", "b", "c"][:order]) + ", f long"
    filters = filters.repartition("bucket").sortWithinPartitions("bucket")
    return stored(filters.mapInArrow(_Merger(order, least), ddl), name)


def _bits(rows: DataFrame, columns: list[str]) -> Bits:
    """A bit for each row, at the first bits of its number: a word's id, or a pair's permuted ids. The number
    of bits grows with that of the rows, to MOST_BITS (64 MB) at most."""
    width = max(15, min(MOST_BITS, BITS_PER_ENTRY * max(1, rows.count())).bit_length() - 1)

    def places(batches):
        for batch in batches:
            ids = [batch.column(c).to_numpy().view(np.uint64) for c in columns]
            first = permuted(ids)[0] if len(ids) > 1 else ids[0]
            at = (first >> np.uint64(64 - width)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at)], names=["at"])

    at = rows.select(*columns).mapInArrow(places, "at long")
    # Spark's bitmaps count their buckets from 1, for the positions from 1 on.
    at = at.select((F.col("at") + 1).alias("at"))
    shares = at.groupBy(F.bitmap_bucket_number("at").alias("share"))
    bits = bytearray(1 << (width - 3))
    for row in shares.agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).toLocalIterator():
        first = (row["share"] - 1) * len(row["bits"])
        bits[first : first + len(row["bits"])] = row["bits"]
    return bytes(bits), width


def _counts(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(words (id, lang, word, f), words per language (lang, n), pairs (a, b, f), triples (a, b, c, f)): those
    with ``least`` occurrences."""
    small_arrow_batches(docs.sparkSession)
    texts = docs.select("text", F.coalesce("lang", F.lit(NO_LANG)).alias("lang")).where(F.col("text").isNotNull())
    found = texts.mapInArrow(_count_words, "lang string, word string, n long")
    words = stored(found.groupBy("lang", "word").agg(F.sum("n").alias("f")), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    for salt in range(64):
        with_ids = words.mapInArrow(_WithIds(salt), "id long, lang string, word string, f long")
        if with_ids.groupBy("id").agg(F.count(F.lit(1)).alias("words")).where("words > 1").isEmpty():
            break
    else:
        raise ValueError("two words share an id under every salt")
    words = words.where(F.col("f") >= least).mapInArrow(_WithIds(salt), "id long, lang string, word string, f long")
    words = stored(words, "frequent_words")
    tasks = texts.rdd.getNumPartitions()  # from the plan; nothing runs
    bucket_bits = min(MOST_BUCKETS, max(64, BUCKETS_PER_TASK * tasks)).bit_length()
    ddl, word_bits = "bucket int, filter binary", _bits(words, ["id"])
    filters = texts.mapInArrow(_Filler(2, salt, bucket_bits, word_bits), ddl)
    pairs = _merge_filters(filters, 2, least, "pairs")
    filters = texts.mapInArrow(_Filler(3, salt, bucket_bits, word_bits, _bits(pairs, ["a", "b"])), ddl)
    return words, totals, pairs, _merge_filters(filters, 3, least, "triples")


def _score(left: str, right: str):
    """floor(1000000 * a * a / (left * right)), exact for counts below 10 ** 16."""
    square = f"cast(1000000 as decimal(38,0)) * cast(a as decimal(19,0)) * cast(a as decimal(19,0))"
    return F.expr(f"({square}) div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0)))")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language.

    Phrases of two and three words with ``least`` occurrences, without those of which ``covered`` per cent or
    more lie in one longer phrase. ``a``, ``l``, ``r``: occurrences of the phrase and of its parts at the cut of
    the lowest score; ``n``: words of the language.
    """
    words, totals, pairs, triples = _counts(docs, least)
    words = maybe_broadcast(words, byte_size(words, 48 + F.octet_length("word") + F.octet_length("lang")))
    few_pairs = maybe_broadcast(pairs, 48 * pairs.count())
    totals = stored(totals, "totals")
    totals = maybe_broadcast(totals, byte_size(totals, 32 + F.octet_length("lang")))

    def with_word(rows: DataFrame, column: str) -> DataFrame:
        own = words.select(
            F.col("id").alias(column), F.col("word").alias(f"{column}_word"),
            F.col("f").alias(f"{column}_f"), F.col("lang").alias(f"{column}_lang"),
        )
        return rows.join(own, column)

    def with_pair(rows: DataFrame, left: str, right: str) -> DataFrame:
        own = few_pairs.select(
            F.col("a").alias(left), F.col("b").alias(right), F.col("f").alias(f"{left}{right}_f")
        )
        return rows.join(own, [left, right])

    inside = triples.select("a", "b", "f").union(triples.select("b", "c", "f"))
    inside = inside.groupBy("a", "b").agg(F.max("f").alias("longer"))
    free = pairs.join(inside, ["a", "b"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("f"))
    )
    two = with_word(with_word(free.select("a", "b", "f"), "a"), "b")
    two = two.select(
        F.col("a_lang").alias("lang"),
        F.concat_ws(" ", "a_word", "b_word").alias("phrase"),
        F.col("f").alias("a"),
        F.col("a_f").alias("l"),
        F.col("b_f").alias("r"),
    ).withColumn("score", _score("l", "r"))

    three = with_pair(with_pair(triples, "a", "b"), "b", "c")
    for column in ("a", "b", "c"):
        three = with_word(three, column)
    three = three.select(
        F.col("a_lang").alias("lang"),
        F.concat_ws(" ", "a_word", "b_word", "c_word").alias("phrase"),
        F.col("f").alias("a"),
        F.col("a_f").alias("l1"),
        F.col("bc_f").alias("r1"),
        F.col("ab_f").alias("l2"),
        F.col("c_f").alias("r2"),
    ).withColumns({"s1": _score("l1", "r1"), "s2": _score("l2", "r2")})
    early = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang", "phrase", "a",
        F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )

    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
