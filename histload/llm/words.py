"""Words of Arrow text columns as 64-bit hashes, made for a whole column at a time.

A word is a run of ASCII letters and digits and of bytes of other characters; ASCII letters are
lower-cased. The UTF-8 bytes are cut into slices at separators, so the working memory does not
grow with the column or with a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

# Byte -> lower-cased word byte, 0 for a separator.
_WORD_BYTE = np.zeros(256, np.uint8)
for _first, _last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _WORD_BYTE[_first : _last + 1] = np.arange(_first, _last + 1)
_WORD_BYTE[0x41:0x5B] = np.arange(0x61, 0x7B)

# A word's hash is the sum of its bytes, each times the factor of its place, then mixed.
_FACTORS = np.random.default_rng(2024).integers(1, 2**63, 4096, dtype=np.uint64) * 2 + 1


def mixed(values: np.ndarray) -> np.ndarray:
    """Each uint64 spread over all bits, one to one (the finaliser of a 64-bit mixing hash)."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, start of each text and end of the last); a NULL text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(column):
        return raw[:0], np.zeros(1, np.int64)
    raw = raw[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


@dataclass
class Words:
    """Words of a column, in order: hash, first byte and end byte (in the column's bytes)."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # words of text i: bounds[i] to bounds[i + 1]


def find_words(raw: np.ndarray, offsets: np.ndarray) -> Words:
    parts = [
        _slice_words(raw, first, last, offsets) for first, last in _slices(raw, offsets)
    ]
    if parts:
        hashes, starts, ends = (np.concatenate(columns) for columns in zip(*parts))
    else:
        hashes, starts, ends = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets))


def _slices(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about SLICE_BYTES that start at a text's first byte or at a separator."""
    first = 0
    while first < len(raw):
        last = first + SLICE_BYTES
        while last < len(raw):
            stop = min(len(raw), last + SLICE_BYTES)
            cuts = np.flatnonzero(_WORD_BYTE[raw[last:stop]] == 0)
            if len(cuts):
                last += int(cuts[0])
                break
            text = offsets[np.searchsorted(offsets, last)]
            last = min(int(text), stop)
            if last == text:
                break
        last = min(last, len(raw))
        yield first, last
        first = last


def _slice_words(raw, first, last, offsets):
    letters = np.take(_WORD_BYTE, raw[first:last])
    inside = letters != 0
    opens = np.empty(len(inside), bool)
    opens[0] = inside[0]
    np.greater(inside[1:], inside[:-1], out=opens[1:])
    edges = offsets[np.searchsorted(offsets, first) : np.searchsorted(offsets, last)] - first
    opens[edges] = inside[edges]
    starts = np.flatnonzero(opens)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, starts
    closes = np.empty(len(inside), bool)
    closes[-1] = inside[-1]
    np.greater(inside[:-1], inside[1:], out=closes[:-1])
    edges = edges[edges > 0] - 1
    closes[edges] = inside[edges]
    ends = np.flatnonzero(closes) + 1
    # Separators count as byte 0 and add nothing to the sums.
    within = np.arange(len(letters), dtype=np.int32)
    shift = np.zeros(len(letters), np.int32)
    shift[starts] = np.diff(starts, prepend=0)
    within -= np.cumsum(shift, dtype=np.int32)
    values = _FACTORS[within & 4095]
    values *= letters
    sums = np.add.reduceat(values, starts)
    hashes = mixed(sums + (ends - starts).astype(np.uint64))
    return hashes, starts + first, ends + first


def small_batches(
    batches, name: str, limit: int = 4 << 20, rows: int = 4096
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of each have ``limit`` bytes or are one text."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(name))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            last = min(max(last, first + 1), first + rows, batch.num_rows)
            yield batch.slice(first, last - first)
            first = last
