"""Token counts that follow edits, from a segment tree for each document.

A text is cut into leaves of about LEAF characters, each at white space, so that no word of the
tokenizer lies in two. The tree holds the sums of characters and of tokens of the leaves below each
node. An edit touches the leaves of its characters and of one character on each side; only their
text is encoded again, is cut into the same leaves, and the sums above are updated. The tables of
trees (``count_tokens``) and edited trees (``apply_edits``) are of one form, so edits can follow edits.

Edits of a document are applied in order, each to the text the one before has left, by one task:
they are steps of one row. Documents do not meet; there is no shuffle but for ``with_edits``, which
joins edits given as a table.

Defined results: a NULL text is empty; an edit's begin and end are cut to the text, a NULL begin is
0, a NULL end the begin, and a NULL replacement is empty. Repeated rows are counted each.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histload.llm.encoding import encoder
from histload.llm.tables import small_arrow_batches
from histload.llm.words import small_batches

LEAF = 128
GROWN = 8  # a leaf that edits leave with so many times LEAF is cut, and the sums above it are built anew
EDITS = "array<struct<begin: bigint, end: bigint, replacement: string>>"
_STATE = "doc_id {id_type}, text string, n_tokens bigint, tree binary"
_SPACE = re.compile("[ \t\n\r\x0b\x0c]")


class Tree:
    """Sums of characters and tokens; the leaves are in the second half, node 1 is the root."""

    def __init__(self, sums: np.ndarray):
        self.sums = sums  # two rows: characters, tokens

    @classmethod
    def of(cls, text: str, count: Callable[[str], int]) -> Tree:
        parts, begin = [], 0
        while begin < len(text):
            found = _SPACE.search(text, begin + LEAF - 1)
            end = found.end() if found else len(text)
            parts.append((end - begin, count(text[begin:end])))
            begin = end
        return cls(_sums(np.array(parts, np.int64).reshape(-1, 2).T))

    @classmethod
    def from_bytes(cls, raw: bytes) -> Tree:
        return cls(np.frombuffer(raw, "<u4").astype(np.int64).reshape(2, -1))

    def to_bytes(self) -> bytes:
        return self.sums.astype("<u4").tobytes()

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def leaf_at(self, position: int) -> tuple[int, int]:
        """(node, first character) of the leaf that holds a character; the last one beyond the end."""
        chars, node, begin = self.sums[0], 1, 0
        half = len(chars) // 2
        position = min(position, max(int(chars[1]) - 1, 0))
        while node < half:
            node *= 2
            if position >= begin + chars[node]:
                begin += int(chars[node])
                node += 1
        return node, begin

    def replace(self, first: int, last: int, parts: list[tuple[int, int]]) -> None:
        """New (characters, tokens) of the leaves ``first`` to ``last``."""
        self.sums[:, first : last + 1] = np.array(parts).T
        while first > 1:
            first, last = first // 2, last // 2
            below = self.sums[:, 2 * first : 2 * last + 2]
            self.sums[:, first : last + 1] = below[:, ::2] + below[:, 1::2]

    def edit(self, text: str, begin: int, end: int, new: str, count: Callable[[str], int]):
        """Apply one edit; returns (edited text, characters encoded again)."""
        first, at = self.leaf_at(max(begin - 1, 0))
        last, last_at = self.leaf_at(end)
        stop = last_at + int(self.sums[0, last])
        region = text[at:begin] + new + text[end:stop]
        edited = text[:at] + region + text[stop:]
        parts, place = [], 0
        for left in range(last - first, -1, -1):
            found = _SPACE.search(region, place + LEAF - 1) if left else None
            cut = found.end() if found else len(region)
            parts.append((cut - place, count(region[place:cut])))
            place = cut
        cuts = _SPACE.search(region, place - parts[-1][0] + LEAF - 1) if parts[-1][0] > GROWN * LEAF else None
        if cuts and cuts.end() < len(region):
            # More leaves than before: those of the region are cut, all others keep their counts.
            inner = Tree.of(region, count).leaves()
            half = self.sums.shape[1] // 2
            self.sums = _sums(np.hstack((self.sums[:, half:first], inner, self.sums[:, last + 1 :])))
        else:
            self.replace(first, last, parts)
        return edited, len(region)

    def leaves(self) -> np.ndarray:
        return self.sums[:, self.sums.shape[1] // 2 :]


def _sums(leaves: np.ndarray) -> np.ndarray:
    """The sums of a tree over leaves (characters, tokens); empty ones are left out."""
    leaves = leaves[:, leaves[0] > 0]
    size = 1
    while size < leaves.shape[1]:
        size *= 2
    sums = np.zeros((2, 2 * size), np.int64)
    sums[:, size : size + leaves.shape[1]] = leaves
    while size > 1:
        sums[:, size // 2 : size] = sums[:, size : 2 * size : 2] + sums[:, size + 1 : 2 * size : 2]
        size //= 2
    return sums


def _counter(tokenizer: str | None) -> Callable[[str], int]:
    encode = encoder(tokenizer).ids
    return lambda text: len(encode(text.encode("utf-8", "replace"))) >> 2


class _Counts:
    def __init__(self, tokenizer: str | None):
        self.tokenizer = tokenizer

    def __call__(self, batches):
        count = _counter(self.tokenizer)
        for batch in small_batches(batches, "text"):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            trees = [Tree.of(text, count) for text in texts]
            columns = [
                batch.column("doc_id"),
                pa.array(texts, pa.string()),
                pa.array([tree.tokens for tree in trees], pa.int64()),
                pa.array([tree.to_bytes() for tree in trees], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "n_tokens", "tree"])


class _Edits:
    def __init__(self, tokenizer: str | None):
        self.tokenizer = tokenizer

    def __call__(self, batches):
        count = _counter(self.tokenizer)
        names = ["doc_id", "text", "n_tokens", "tree", "n_before", "n_edits", "encoded_chars"]
        for batch in small_batches(batches, "text"):
            rows = zip(*(batch.column(name).to_pylist() for name in ("text", "tree", "edits")))
            done = [_edited(text, Tree.from_bytes(tree), edits or [], count) for text, tree, edits in rows]
            columns = [list(column) for column in zip(*done)] or [[], [], [], []]
            kinds = [pa.string(), pa.int64(), pa.binary(), pa.int64()]
            text, tokens, tree, encoded = (pa.array(c, k) for c, k in zip(columns, kinds))
            sizes = pa.array([len(edits or []) for edits in batch.column("edits").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), text, tokens, tree, batch.column("n_tokens"), sizes, encoded],
                names=names,
            )


def _edited(text: str, tree: Tree, edits: list[dict], count: Callable[[str], int]):
    encoded = 0
    for edit in edits:
        begin = min(max(edit["begin"] or 0, 0), len(text))
        end = begin if edit["end"] is None else min(max(edit["end"], begin), len(text))
        text, chars = tree.edit(text, begin, end, edit["replacement"] or "", count)
        encoded += chars
    return text, tree.tokens, tree.to_bytes(), encoded


def count_tokens(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, text, n_tokens, tree) for every row of ``docs`` (doc_id, text)."""
    small_arrow_batches(docs.sparkSession)
    ddl = _STATE.format(id_type=docs.schema["doc_id"].dataType.simpleString())
    return docs.select("doc_id", "text").mapInArrow(_Counts(tokenizer), ddl)


def with_edits(state: DataFrame, edits: DataFrame) -> DataFrame:
    """``state`` with the column ``edits`` from a table (doc_id, number, begin, end, replacement), in the
    order of ``number``. Edits of other documents, or of none, are left out."""
    each = F.struct("number", "begin", "end", "replacement")
    listed = edits.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.array_sort(F.collect_list(each)).alias("edits")
    )
    bare = F.transform("edits", lambda e: F.struct(e["begin"].alias("begin"), e["end"].alias("end"), e["replacement"].alias("replacement")))
    return state.join(listed, "doc_id", "left").withColumn("edits", bare.cast(EDITS))


def apply_edits(state: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The state after its column ``edits``, with the tokens before (``n_before``), the number of
    edits and the characters that were encoded again."""
    small_arrow_batches(state.sparkSession)
    ddl = _STATE.format(id_type=state.schema["doc_id"].dataType.simpleString())
    ddl += ", n_before bigint, n_edits bigint, encoded_chars bigint"
    columns = ["doc_id", "text", "n_tokens", "tree", F.col("edits").cast(EDITS).alias("edits")]
    return state.select(*columns).mapInArrow(_Edits(tokenizer), ddl)
