"""Tokenizer files and caches shared by the operators that work on token ids.

A file is read once by the driver and its content travels with the tasks, so executors need no
copy of it. Its size is bounded by the vocabulary.
"""

from __future__ import annotations

from pathlib import Path

import public_tokenizers

# Entries of each of the two generations of a worker's cache; what has not been asked for during a
# whole generation is forgotten, which costs time, not results.
CACHE_ENTRIES = 400_000


def vocabulary(name: str) -> str:
    """Path of one of the installed vocabulary files."""
    return public_tokenizers.path(name)


def content(path: str) -> str:
    return Path(path).read_text(encoding="utf-8")


def load(json_text: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(json_text)


class Cache(dict):
    """``cache[piece]``: computed on first use by ``make``."""

    def __init__(self, make, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.make, self.entries, self.old = make, entries, {}

    def __missing__(self, piece):
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        value = self.old.get(piece)
        if value is None:
            value = self.make(piece)
        self[piece] = value
        return value


def byte_letters(tokenizer) -> dict[int, str]:
    """How byte-level vocabularies write the first 256 characters, for ``str.translate``."""
    from tokenizers.pre_tokenizers import ByteLevel

    write = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
    return {code: write(chr(code))[0][0] for code in range(256)}
