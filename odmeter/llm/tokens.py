"""Token ids of many texts with a tokenizer of the tokenizers library, inside tasks.

The tokenizer splits texts at white space and treats each word alone, so a text's ids are its words' ids one after
another.  Each Python worker keeps the ids of words it has seen (``KEEP`` spellings and ``KEEP_STEMS`` bare
words at most, then it starts anew), and a text is put together from these.  Words with a special token's string in them, or any
that the shortcuts don't cover, go through ``encode`` whole.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np

KEEP = 350_000
KEEP_STEMS = 450_000
#: ASCII characters after a word that the tokenizer always cuts off from a letter before them
AFTER = ".,;:!?$%&*#|"
_LATIN = re.compile("[a-zß-öø-ɏ]+")
_LETTERS = frozenset(c for c in map(chr, range(0x250)) if _LATIN.fullmatch(c.lower()))


def tokenizer_path() -> str:
    """Place of the tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def vocabulary(path: str | None = None) -> int:
    """How many ids a tokenizer has."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path or tokenizer_path()).get_vocab_size()


class _Words(dict):
    """Ids, as bytes of unsigned 32-bit integers, of words as they stand in texts; made when they are first asked for."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, word: str) -> bytes:
        if len(self) >= KEEP:
            self.clear()
        ids = self[word] = self.make(word)
        return ids


class Encoder:
    """Ids of texts; ``path`` is a tokenizer whose words are independent of each other."""

    def __init__(self, path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path or tokenizer_path())
        self.level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelled: dict[str, str] = {}
        self.stems: dict[str, bytes] = {}
        self.words = _Words(self._word)

    def _stem(self, word: str) -> bytes:
        low = word.lower()
        latin = "<" not in word and _LATIN.fullmatch(low)
        key = low if latin else word
        ids = self.stems.get(key)
        if ids is None:
            if len(self.stems) >= KEEP_STEMS:
                self.stems.clear()
            if latin:
                spell = low if low.isascii() else "".join(self.spelled.get(c) or self._spell(c) for c in low)
                found = [t.id for t in self.tokenizer.model.tokenize(spell)]
            else:
                found = self.tokenizer.encode(word, add_special_tokens=False).ids
            ids = self.stems[key] = array("I", found).tobytes()
        return ids

    def _spell(self, char: str) -> str:
        self.spelled[char] = "".join(piece for piece, _ in self.level.pre_tokenize_str(char))
        return self.spelled[char]

    def _word(self, word: str) -> bytes:
        stem = word.rstrip(AFTER)
        if stem == word or not stem or stem[-1] not in _LETTERS:
            return self._stem(word)
        return self._stem(stem) + self._stem(word[len(stem):])

    def encode(self, text: str | None) -> np.ndarray:
        """All ids of a text as uint32; none for NULL."""
        if not text:
            return np.zeros(0, np.uint32)
        words = text.replace("\n", " ").split(" ")
        return np.frombuffer(b"".join(map(self.words.__getitem__, words)), np.uint32)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """The encoder of this Python worker."""
    key = path or ""
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path)
    return _ENCODERS[key]


def crc(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
