"""Spelling variants: words of a corpus one edit apart, found by scanning sorted lists.

A sorted list of words is scanned for each of its words with a banded edit matrix of three diagonals. The
matrix rows of a word's prefix are those of the word before it as far as both share their beginning (the
LCP of neighbours); where a row has no value up to one edit, all words that share this prefix are passed over.

So that no list grows with the vocabulary, words meet only where one edit can lie between them. Two words one
edit apart share, besides one place, all of their beginning and end; so they share either the first or the last
half of the shorter one. Every word is put into the lists of its first and its last half, once as the shorter
or equal word and once as the longer one. Lists of more than LIST words are split again by the same rule, on
the part between the shared beginning and end, down to lists whose words differ in one place at most; these are
bounded by the alphabet. A pair belongs to the list of its beginning wherever both shares hold, so it is found once.

Defined results: a NULL or empty text has no words; a NULL doc_id counts as an empty one; repeated rows are
counted each. Ties between near words go to the smallest in code-point order. An empty table has no rows.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histload.llm.tables import byte_size, checkpointed, maybe_broadcast, small_arrow_batches, stored
from histload.llm.words import small_batches

SHORTEST, LEAST, RATIO = 7, 2, 10
DELETE_EVERY = 31
LIST = 256  # words of a list that is not split again
HELD = 200_000  # words counted in a task before their counts are handed on
_FAR = 2  # more edits than one are not told apart
_NO_LIMIT = 2**31 - 1


class _Counter:
    """Texts to (word, n): counts of a task's words, handed on whenever HELD words are known."""

    def __init__(self, shortest: int, delete_every: int):
        self.shortest, self.delete_every = shortest, delete_every

    def __call__(self, batches):
        runs = re.compile(f"[a-zÀ-ÿ]{{{self.shortest},}}").findall
        counts: Counter = Counter()
        for batch in small_batches(batches, "text"):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for doc_id, text in zip(ids, texts):
                if text:
                    # Bytes have a lower case of ASCII letters alone.
                    found = Counter(runs(text.encode().lower().decode()))
                    self._add(counts, f"{doc_id or ''}:".encode(), found)
            if len(counts) > HELD:
                yield from _count_rows(counts)
                counts = Counter()
        yield from _count_rows(counts)

    def _add(self, counts: Counter, owner: bytes, found: Counter) -> None:
        start, every = crc32(owner), self.delete_every
        for run, n in found.items():
            h = crc32(run.encode(), start)
            if every and h % every == 0:
                place = h % len(run)
                run = run[:place] + run[place + 1 :]
                if len(run) < self.shortest:
                    continue
            counts[run] += n


def _count_rows(counts: Counter):
    words = list(counts)
    for first in range(0, len(words), 50_000):
        part = words[first : first + 50_000]
        columns = [pa.array(part, pa.string()), pa.array([counts[w] for w in part], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["word", "n"])


def vocabulary(
    docs: DataFrame,
    shortest: int = SHORTEST,
    least: int = LEAST,
    delete_every: int = DELETE_EVERY,
) -> DataFrame:
    """(word, n): runs of Latin letters, A-Z in lower case, of ``shortest`` code points and ``least``
    occurrences.

    Of a run whose checksum with its document's id is a multiple of ``delete_every``, one code point is
    deleted first (0: of none), which makes variants that are known.
    """
    small_arrow_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").where(F.col("text").isNotNull())
    counted = rows.mapInArrow(_Counter(shortest, delete_every), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _shared(a: str, b: str) -> int:
    """Length of the common beginning."""
    stop = min(len(a), len(b))
    if a[:stop] == b[:stop]:
        return stop
    n = 0
    while a[n] == b[n]:
        n += 1
    return n


def near_pairs(words: list[str]) -> list[tuple[int, int]]:
    """Places (i, j), i < j, of the words of a sorted list without repeats that are one edit apart."""
    shared = [0] + [_shared(a, b) for a, b in zip(words, words[1:])]
    total, pairs = len(words), []
    for i, query in enumerate(words):
        size = len(query)
        # rows[d]: edits between the first d code points of a word and the first d - 1, d, d + 1 of the query.
        padded = query + "\0\0"
        rows = [(_FAR, 0, 1)]
        depth, j = 0, i + 1
        while j < total:
            word = words[j]
            depth = min(depth, shared[j])
            del rows[depth + 1 :]
            length, alive = len(word), True
            while depth < length:
                if depth > size:
                    alive = False
                    break
                one, before, here, after = word[depth], *rows[depth]
                low = min(before + (padded[depth - 1] != one), here + 1, _FAR)
                middle = min(here + (padded[depth] != one), after + 1, low + 1, _FAR)
                high = min(after + (padded[depth + 1] != one), middle + 1, _FAR)
                depth += 1
                rows.append((low, middle, high))
                if low == middle == high == _FAR:
                    alive = False
                    break
            if alive:
                if -1 <= size - length <= 1 and rows[length][size - length + 1] == 1:
                    pairs.append((i, j))
                j += 1
            else:
                j += 1
                while j < total and shared[j] >= depth:
                    j += 1
    return pairs


def _scanned(batches):
    """Rows (list, s, lo, hi, below, word, n), each list's together and sorted by word, to
    (word, n_near, form_n, form): partners of each word within the list."""
    out: list[tuple] = []
    name, rows = None, []
    columns = ("list", "s", "lo", "hi", "below", "word", "n")
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns)):
            if row[0] != name:
                if len(rows) > 1:
                    _scan_list(rows, out)
                name, rows = row[0], []
            rows.append(row)
        if len(out) > 10_000:
            yield _near_rows(out)
            out = []
    if len(rows) > 1:
        _scan_list(rows, out)
    yield _near_rows(out)


def _scan_list(rows: list[tuple], out: list[tuple]) -> None:
    _, s, lo, hi, below, _, _ = rows[0]
    words, counts = [row[5] for row in rows], [row[6] for row in rows]
    inner = [word[lo : len(word) - hi] for word in words]
    best: dict[int, list] = {}
    for i, j in near_pairs(inner):
        # Two longer words are equal words of another list; a pair that shares more of its beginning
        # is found there.
        if min(len(words[i]), len(words[j])) > s or (
            below != _NO_LIMIT and lo + _shared(inner[i], inner[j]) >= below
        ):
            continue
        for own, other in ((i, j), (j, i)):
            found = best.setdefault(own, [0, (0, "")])
            found[0] += 1
            rank = (-counts[other], words[other])
            if found[0] == 1 or rank < found[1]:
                found[1] = rank
    out.extend((words[i], total, -rank[0], rank[1]) for i, (total, rank) in best.items())


def _near_rows(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out)) if out else [(), (), (), ()]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=["word", "n_near", "form_n", "form"])


def _halves(rows: DataFrame) -> DataFrame:
    """The lists of ``rows`` (word, n, s, lo, hi, below) split: by the first half of what lies between
    the ``lo`` first and ``hi`` last code points of words of ``s`` code points, and by the last half.
    ``below``: pairs that share so much of their beginning are in another list."""
    half = F.floor((F.col("s") - F.col("lo") - F.col("hi")) / 2).cast("int")
    first = F.struct((F.col("lo") + half).alias("lo"), F.col("hi"), F.col("below"))
    last = F.struct(
        F.col("lo"), (F.col("hi") + half).alias("hi"), F.least("below", F.col("lo") + half).alias("below")
    )
    rows = rows.withColumn("part", F.explode(F.array(first, last))).select("word", "n", "s", "part.*")
    ends = F.concat_ws(
        ":",
        *("s", "lo", "hi", "below"),  # one list may be reached on two ways
        F.expr("substring(word, 1, lo)"),
        F.expr("if(hi = 0, '', right(word, hi))"),
    )
    return rows.withColumn("list", ends)


def _lists(words: DataFrame, shortest: int) -> DataFrame:
    """Every list with all its words, none of more than LIST but those that cannot be split."""
    size = F.length("word")
    classes = words.withColumn("s", F.explode(F.array(size, size - 1))).where(F.col("s") >= shortest)
    ready, rows = None, _halves(
        classes.withColumns({"lo": F.lit(0), "hi": F.lit(0), "below": F.lit(_NO_LIMIT)})
    )
    while True:
        rows = stored(rows, "lists")
        sizes = rows.groupBy("list", "s", "lo", "hi").agg(F.count(F.lit(1)).alias("words"))
        # Of lists with one open place nothing can be split off.
        large = sizes.where((F.col("words") > LIST) & (F.col("s") - F.col("lo") - F.col("hi") > 1))
        large = checkpointed(large.select("list"))
        if large.isEmpty():
            return rows if ready is None else ready.unionByName(rows)
        few = maybe_broadcast(large, byte_size(large, F.octet_length("list") + 16))
        done = rows.join(few, "list", "left_anti")
        ready = done if ready is None else ready.unionByName(done)
        rows = _halves(rows.join(few, "list", "left_semi").drop("list"))


def near_words(words: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """(word, n, n_near, form_n, form) of ``words`` (word, n; no repeats, of ``shortest`` code points at
    least): how many others are one edit apart, and the most frequent of them (of ties the smallest)."""
    small_arrow_batches(words.sparkSession)
    lists = _lists(words.select("word", "n"), shortest)
    # No number of partitions is given: AQE may join small ones, and lists stay whole.
    lists = lists.repartition("list").sortWithinPartitions("list", "word")
    found = lists.select("list", "s", "lo", "hi", "below", "word", "n").mapInArrow(
        _scanned, "word string, n_near bigint, form_n bigint, form string"
    )
    none = words.select(
        "word", "n", F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast("struct<less:bigint,form:string>").alias("rank")
    )
    rank = F.struct((-F.col("form_n")).alias("less"), "form")
    found = found.select("word", F.lit(None).cast("bigint").alias("n"), "n_near", rank.alias("rank"))
    near = none.unionByName(found).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("rank").alias("rank")
    )
    return near.select("word", "n", "n_near", (-F.col("rank.less")).alias("form_n"), F.col("rank.form").alias("form"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): where following forms ends. A form has RATIO times the
    word's count, so chains end; each round doubles the steps taken."""
    links = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = stored(links.join(on, "root", "left"), "roots")
        links = stepped.select("word", F.coalesce("next", "root").alias("root"))
        if stepped.where(F.col("next").isNotNull()).isEmpty():
            return links


def spelling_variants(docs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the vocabulary: ``form`` is its most
    frequent near word if that is ``ratio`` times as frequent, ``root`` the end of the chain of forms."""
    near = near_words(stored(vocabulary(docs), "vocabulary"))
    kept = F.col("form_n") >= ratio * F.col("n")
    near = stored(
        near.withColumns({"form": F.when(kept, F.col("form")), "form_n": F.when(kept, F.col("form_n"))}), "near"
    )
    roots = _roots(near.where(F.col("form").isNotNull()))
    return near.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
