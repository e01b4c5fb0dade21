"""Ids of whole texts by a public byte-level tokenizer file, with equal words encoded once.

A text is cut into blank-led units (``units``), an unknown unit into words by the split pattern, and only unknown words go to
the tokenizer's model. What is known stays with the Python worker from task to task, up to a number of words; results do not
depend on it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import public_tokenizers
import regex
from tokenizers import Tokenizer

from outagegrid.llm.units import units

MOST_UNITS, MOST_RECENT, MOST_WORDS = 500_000, 50_000, 50_000
LONGEST = 100  # characters; longer words and units are not remembered
MARKS = frozenset(".,;:!?)")
# How byte-level vocabularies write bytes: printable ones as themselves, the others in order from U+0100.
_PLAIN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_LETTERS = {b: 0x100 + k for k, b in enumerate(b for b in range(256) if b not in _PLAIN)}
BLANK = chr(BYTE_LETTERS[0x20])


class Known(dict):
    """What is known of a word, made by ``make`` when it is first asked for. Beyond ``most`` entries new ones are remembered
    for a while only, long ones never."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most = make, most
        self.recent: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        ids = self.recent.get(key)
        if ids is not None:
            return ids
        ids = self.make(key)
        if len(key) > LONGEST:
            return ids
        if len(self) < self.most:
            self[key] = ids
        else:
            if len(self.recent) >= MOST_RECENT:
                self.recent.clear()
            self.recent[key] = ids
        return ids


class Units(Known):
    """Units without their leading blank. Letters before a mark are not kept: the letters are."""

    def __init__(self, encoder: TextEncoder):
        super().__init__(encoder.unit_ids, MOST_UNITS)
        self.words = encoder.words

    def __missing__(self, unit: str) -> bytes:
        if unit[-1:] in MARKS and (letters := unit[:-1]).isalpha():
            return self[letters] + self.words[unit[-1]]
        return super().__missing__(unit)


class TextEncoder:
    """Texts to little-endian id arrays of two bytes each; ``definition`` is the tokenizer file's content."""

    def __init__(self, definition: str, pattern: str = public_tokenizers.PATTERN):
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are then ordinary text
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError(f"{self.tokenizer.get_vocab_size()} ids do not fit two bytes")
        self.split = regex.compile(pattern)
        self.tokenize = self.tokenizer.model.tokenize
        self.bytes_of = [i.to_bytes(2, "little") for i in range(1 << 16)]
        self.words = Known(self.tokenized, MOST_WORDS)
        self.units = Units(self)

    def tokenized(self, word: str) -> bytes:
        """Ids of one match of the split pattern, by the tokenizer's model."""
        written = word.encode().decode("latin-1").translate(BYTE_LETTERS)
        bytes_of = self.bytes_of
        return b"".join([bytes_of[t.id] for t in self.tokenize(written)])

    def unit_ids(self, unit: str) -> bytes:
        """Ids of a unit that is written without its leading blank; letters alone are one word."""
        if not unit.isalpha():
            return b"".join(map(self.word_ids, self.split.findall(" " + unit)))
        if not unit.isascii():
            return self.tokenized(" " + unit)
        bytes_of = self.bytes_of
        return b"".join([bytes_of[t.id] for t in self.tokenize(BLANK + unit)])

    def word_ids(self, word: str) -> bytes:
        """Ids of one match of the split pattern; letters after a blank are a unit."""
        return self.units[word[1:]] if word[:1] == " " and word[1:].isalpha() else self.words[word]

    def first_ids(self, text: str) -> bytes:
        """Ids of a text's first unit, which may be the whole text."""
        return self.words[text] if text.isalpha() else b"".join(map(self.word_ids, self.split.findall(text)))

    def encode(self, texts: list[str]) -> list[bytes]:
        known, out = self.units.__getitem__, []
        for text in texts:
            first, rest = units(text)
            out.append(self.first_ids(first or "") + b"".join(map(known, rest)))
        return out


@lru_cache(maxsize=2)
def shared_encoder(definition: str) -> TextEncoder:
    """One encoder per Python worker."""
    return TextEncoder(definition)


@lru_cache(maxsize=4)
def piece_bytes(definition: str) -> np.ndarray:
    """Length in bytes of every id's piece. In a byte-level vocabulary each character of a piece is one byte."""
    tokenizer = Tokenizer.from_str(definition)
    out = np.zeros(tokenizer.get_vocab_size(), dtype=np.int64)
    for piece, at in tokenizer.get_vocab().items():
        out[at] = len(piece)
    return out


def read_definition(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()
