"""Public tokenizer files on the executors: loaded once in each Python worker."""

from __future__ import annotations

import functools
import re
import unicodedata

from tokenizers import Tokenizer

#: Distinct pieces that a worker remembers at most.
REMEMBERED = 500_000
#: Longer pieces are not remembered by ``Remembered`` ...
LONGEST_REMEMBERED = 64
#: ... which holds about so many bytes at most: rare words come back, and to encode one again takes ten times a look-up.
REMEMBERED_BYTES = 300 << 20
#: Bytes that an entry takes beside four for each character: the objects of key and value, and their places.
ENTRY_BYTES = 150
#: Up to this code point letters and digits are the same in every Unicode version.
LATIN = 0x180


@functools.cache
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@functools.cache
def byte_letters() -> dict[int, str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


@functools.cache
def _byte_table() -> dict[int, str]:
    return {b: c for b, c in byte_letters().items()}


def visible(piece: str) -> str:
    """A text as the characters of its UTF-8 bytes."""
    return piece.encode().decode("latin-1").translate(_byte_table())


@functools.cache
def latin_class(kind: str) -> str:
    """The characters below LATIN of a general category (L or N), for a character class."""
    return "".join(re.escape(chr(c)) for c in range(LATIN) if unicodedata.category(chr(c))[0] == kind)


class Remembered(dict):
    """A bounded cache over a function of a string; what was used lately stays when it is full."""

    def __init__(self, fn):
        super().__init__()
        self.fn, self.earlier, self.held = fn, {}, 0

    def __missing__(self, key):
        value = self.earlier.pop(key, None)
        if value is None:
            value = self.fn(key)
        if len(key) <= LONGEST_REMEMBERED:
            self.held += ENTRY_BYTES + 4 * len(key)
            if self.held > REMEMBERED_BYTES // 2:
                self.earlier, self.held = dict(self), ENTRY_BYTES + 4 * len(key)
                self.clear()
            self[key] = value
        return value
