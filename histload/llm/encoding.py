"""Token ids of texts, with a cache of words each Python worker keeps.

Texts are cut at ASCII white space, which the tokenizer drops and never looks across; so the ids
of a text are those of its pieces, and a piece has to be encoded once only. New pieces of plain
Latin characters are cut into the tokenizer's words here and given to its model; all others go
through the whole tokenizer. Made for byte-level tokenizers that lower-case; ``tests`` compare the
ids with those of whole texts.
"""

from __future__ import annotations

import os
import re
from struct import pack

import numpy as np

TOKENIZER = "word_bpe_49k.json"
CACHE_PIECES = 250_000  # of the younger generation of the cache
CACHE_BYTES = 64  # longer pieces are not kept

# Characters whose normal form and lower case need no context, and the words made of them.
_PLAIN = re.compile("[\x21-\x7Eß-öø-ÿÀ-ÖØ-Þ]+")
_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _byte_letters() -> list[str]:
    """The letter by which byte-level models write each byte: itself if it is printable, else the
    next free one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [byte for byte in range(256) if byte not in printable]
    return [chr(byte if byte in printable else 256 + rest.index(byte)) for byte in range(256)]


_LETTERS = _byte_letters()

_encoders: dict[str, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """The worker's encoder for a tokenizer file; by default the public one named above."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    """Ids of pieces and of the words in them, kept in two generations: one that is met again moves to the
    younger, and when that is full, the older one goes. So frequent pieces stay, however many are met once.
    A word is kept as the piece it would be by itself."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces: tuple[dict[bytes, bytes], dict[bytes, bytes]] = ({}, {})
        self.long: list[bytes] = []

    def ids(self, text: bytes) -> bytes:
        """The ids of a UTF-8 text, as little-endian unsigned 32-bit numbers."""
        return self.ids_of([text])[0]

    def ids_of(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each of some texts. New pieces of all of them are encoded together."""
        parts = [text.split() for text in texts]
        known = self._known({piece for part in parts for piece in part})
        out = [b"".join([known[piece] for piece in part]) for part in parts]
        self._age()
        return out

    def counts(self, pieces: list[bytes]) -> list[int]:
        """The number of ids of each piece; pieces hold no ASCII white space."""
        known = self._known(set(pieces))
        out = [len(known[piece]) >> 2 for piece in pieces]
        self._age()
        return out

    def _age(self) -> None:
        for piece in self.long:
            self.pieces[0].pop(piece, None)
        self.long = []
        if len(self.pieces[0]) > CACHE_PIECES:
            self.pieces = ({}, self.pieces[0])

    def _known(self, wanted: set[bytes]) -> dict[bytes, bytes]:
        """The younger generation, in which all ``wanted`` pieces are now."""
        young, old = self.pieces
        new, others = wanted.difference(young), []
        for piece in new:
            ids = old.get(piece)
            if ids is None:
                if piece.isalpha():  # of ASCII letters alone
                    ids = self._word(piece.lower())
                else:
                    text = piece.decode("utf-8", "replace")
                    if "<|" not in text and _PLAIN.fullmatch(text):
                        ids = b"".join([self._word(word.encode()) for word in _WORDS.findall(text.lower())])
                    else:
                        others.append((piece, text))
                        continue
            young[piece] = ids
        if others:
            young.update(self._by_tokenizer(others))
        self.long = [piece for piece in new if len(piece) > CACHE_BYTES]
        return young

    def _word(self, word: bytes) -> bytes:
        """The ids of one of the tokenizer's words, in lower case."""
        young, old = self.pieces
        ids = young.get(word)
        if ids is not None:
            return ids
        ids = old.get(word)
        if ids is None:
            letters = word.decode() if word.isascii() else "".join([_LETTERS[byte] for byte in word])
            found = self.tokenizer.model.tokenize(letters)
            ids = pack(f"<{len(found)}I", *[one.id for one in found])
        if len(word) <= CACHE_BYTES:
            young[word] = ids
        return ids

    def _by_tokenizer(self, pieces: list[tuple[bytes, str]]) -> dict[bytes, bytes]:
        joined = " ".join(text for _, text in pieces)
        found = self.tokenizer.encode(joined, add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        # Each id belongs to the piece in which its characters begin.
        ends = np.cumsum([len(text) + 1 for _, text in pieces])
        begins = np.fromiter((first for first, _ in found.offsets), np.int64, len(ids))
        cuts = (np.searchsorted(begins, np.concatenate(([0], ends))) * 4).tolist()
        raw = ids.tobytes()
        return {piece: raw[a:b] for (piece, _), a, b in zip(pieces, cuts, cuts[1:])}
