"""Whole-text encoding with a public tokenizer, repeated pieces encoded once.

Both tokenizers here never join characters across a step from text to white
space or from a letter to a mark, so a text may be cut there and the pieces encoded
alone: the ids put together equal those of the whole text. Most pieces repeat, and
each distinct piece is encoded once per batch and remembered for later batches in a
table of bounded size. Texts whose white space does not allow the cut are encoded whole.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces in the young table of a Python worker. When it is full it becomes the
#: old one; pieces of the old table that come again move back.
REMEMBERED = 450_000
#: Longest piece (characters) worth remembering.
LONGEST = 64
#: Characters encoded at a time, so that cut texts stay small in memory.
BATCH_CHARS = 2_000_000

_odd_space = re.compile(r"[^\S \t\n\r]")
#: A word of ASCII and Latin-1 letters that may have a blank before it.
_WORD = "^ ?[A-Za-z\xC0-\xD6\xD8-\xF6\xF8-\xFF]+$"
_MARKS = b".,!?;:#*$%&"
#: What a byte of UTF-8 is: white space, an ASCII letter, a mark, or one that odd white space begins with.
_SPACE, _LETTER, _MARK, _ODD = 1, 2, 4, 8
_CLASSES = np.zeros(256, np.uint8)
_CLASSES[list(b" \t\n\r")] = _SPACE
_CLASSES[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_CLASSES[list(_MARKS)] = _MARK
_CLASSES[[0x0B, 0x0C, *range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3]] = _ODD


def byte_letters() -> dict[int, str]:
    """Character that stands for each byte in byte-level vocabularies: itself if printable, else the next from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def _values(column: pa.Array) -> list:
    # by an array of objects, which makes no Arrow scalar of each
    return column.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Ids of texts as little-endian bytes of ``width`` per id."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if sys.byteorder != "little":
            raise RuntimeError("ids are kept as native little-endian arrays")

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        self.letters = {b: letter for b, letter in byte_letters().items() if chr(b) != letter}
        self.drops_space = self.tokenizer.normalizer is not None
        self.width = 2 if self.tokenizer.get_vocab_size(True) <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"  # of native, little-endian arrays
        self.blank = self.letters[0x20]
        self.bytes_of = [i.to_bytes(self.width, "little") for i in range(self.tokenizer.get_vocab_size(True))]
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @property
    def dtype(self) -> str:
        return f"<u{self.width}"

    def _cut(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """Pieces of all texts in a row that may be encoded alone, and the number of pieces up to the end of each text.

        Cuts are at the borders of white space, before the last character of a run of it, which a blank
        leaves to the word behind it, and between letters and marks, which no token holds both of.
        """
        encoded = [t.encode() for t in texts]
        ends = np.cumsum(list(map(len, encoded)))
        data = b"".join(encoded)
        byte = np.frombuffer(data, np.uint8)
        is_a = _CLASSES.take(byte)
        space = (is_a & _SPACE).view(bool)
        # one place for every border of two bytes
        here, there = space[:-1], space[1:]
        latin = (byte[:-2] == 0xC3) & (byte[1:-1] >= 0x80) & (byte[1:-1] != 0x97) & (byte[1:-1] != 0xB7)
        letter = is_a[:-1] == _LETTER
        letter[1:] |= latin
        cut = (letter & (is_a[1:] == _MARK)) | (here != there) & (~here | (byte[:-1] != 0x20))
        # the last of more white space, if a text goes on behind it
        cut[:-1] |= here[:-1] & there[:-1] & ~there[1:]
        cut = np.append(cut, False)
        inner = ends[(ends > 0) & (ends < len(data))] - 1
        # at the end of a text white space stays together
        last = inner[(inner > 0) & space.take(inner)]
        cut[last[space.take(last - 1)] - 1] = False
        cut[inner] = True
        if not self.drops_space:
            for i in np.unique(np.searchsorted(ends, np.flatnonzero(is_a == _ODD), "right")).tolist():
                if _odd_space.search(texts[i]):
                    cut[ends[i] - len(encoded[i]) : ends[i] - 1] = False
        at = np.concatenate(([0], np.flatnonzero(cut) + 1, [len(data)]))
        pieces = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data))
        return pieces, np.searchsorted(at, ends)

    def _ids(self, pieces: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(pieces, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in found]

    def _word_ids(self, word: str) -> bytes:
        """Ids of one word, with or without a blank before, by the tokenizer's model alone."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        elif word[0] == " ":
            word = self.blank + word[1:]
        return b"".join([self.bytes_of[t.id] for t in self.model.tokenize(word)])

    def _bare_ids(self, word: str) -> bytes:
        """Ids of one word, which is encoded once whatever its case and the blank before it if they do not matter."""
        if not self.drops_space:
            return self._word_ids(word)
        word = word.lstrip(" ").lower()
        ids = self.known.get(word) or self.old.get(word)
        if ids is None:
            ids = self._word_ids(word)
            if len(word) <= LONGEST:
                self.known[word] = ids
        return ids

    def _learn(self, new: list[str]) -> list[bytes]:
        """Ids of pieces that are not in the tables."""
        is_word = _values(pc.match_substring_regex(pa.array(new, pa.large_string()), _WORD))
        others = [x for x, word in zip(new, is_word) if not word]
        ids = chain.from_iterable(self._ids(others[start : start + 20_000]) for start in range(0, len(others), 20_000))
        return [self._bare_ids(x) if word else next(ids) for x, word in zip(new, is_word)]

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """One value per text, in order; a null text has no ids."""
        batch, chars = [], 0
        for text in texts:
            batch.append(text or "")
            chars += len(batch[-1])
            if chars >= BATCH_CHARS:
                yield from self._encode(batch)
                batch, chars = [], 0
        yield from self._encode(batch)

    def _encode(self, texts: list[str]) -> list[bytes]:
        if not any(texts):
            return [b""] * len(texts)
        pieces, ends = self._cut(texts)
        kinds = pieces.dictionary_encode()
        names = _values(kinds.dictionary)
        if len(self.known) > REMEMBERED:
            self.known, self.old = {}, self.known
        known, old = self.known, self.old
        ids = list(map(known.get, names))
        missing = [i for i, x in enumerate(ids) if x is None]
        if old:
            for i, x in zip(missing, map(old.get, map(names.__getitem__, missing))):
                if x is not None:
                    ids[i] = known[names[i]] = x
            missing = [i for i in missing if ids[i] is None]
        new = list(map(names.__getitem__, missing))
        found = self._learn(new)
        for i, x in zip(missing, found):
            ids[i] = x
        known.update(zip(new, found) if max(map(len, new), default=0) <= LONGEST else ((x, y) for x, y in zip(new, found) if len(x) <= LONGEST))
        row = pa.array(ids, pa.large_binary()).take(kinds.indices)
        _, at, data = row.buffers()
        at = np.frombuffer(at, np.int64, len(row) + 1).take(ends).tolist()
        data = memoryview(data or b"")
        return [bytes(data[a:b]) for a, b in zip([0, *at], at)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file; later tasks use it again."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
