"""Token ids of many texts with a byte-level tokenizer of the tokenizers library, inside tasks.

The tokenizer starts a new piece at a space that stands before a character other than white space, whatever comes before it, and
between a letter and a stop.  So a text is cut there, and its ids are those of the parts one after another.  A worker keeps the ids of
parts of up to ``KEEP_LENGTH`` characters that it has seen, about 100 MB at most, then it starts anew.  Texts that hold a special token's string, and parts that
the shortcuts don't cover, go through ``encode`` whole.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

KEEP = 350_000
KEEP_OTHERS = 100_000
KEEP_LENGTH = 40
#: characters that are surely no white space; a space before one of them begins a part
_VISIBLE = "!-~¡-ɏͰ-࿿ぁ-퟿"
_CUT = re.compile(f"(?= [{_VISIBLE}])")
_BEGINS = re.compile(f"[{_VISIBLE}]")
#: letters, and what may stand after them as a piece of its own: ASCII signs but the apostrophe
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*)")


def tokenizer_path() -> str:
    """Place of the tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _NotCut(Exception):
    """A space of this text stands before white space."""


class _Kept(dict):
    """Ids, as bytes of unsigned 32-bit integers, by part; made when they are first asked for."""

    def __init__(self, make, keep: int):
        self.make, self.keep = make, keep

    def __missing__(self, part: str) -> bytes:
        ids = self.make(part)
        if len(part) <= KEEP_LENGTH:
            if len(self) >= self.keep:
                self.clear()
            self[part] = ids
        return ids


class ByteEncoder:
    """Ids of texts; ``path`` is a byte-level tokenizer that adds no space before a text."""

    def __init__(self, path: str | None = None, keep: int = KEEP):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path or tokenizer_path())
        self.model = self.tokenizer.model
        self.level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # letters of _SIMPLE beyond ASCII, and the space, as the model spells them
        self.spelled, self.space = {c: self._spell(chr(c)) for c in range(0xC0, 0x250)}, self._spell(" ")
        self.words = _Kept(self._word, keep)  # after a space
        self.others = _Kept(self._other, min(keep, KEEP_OTHERS))  # as they stand

    def _spell(self, char: str) -> str:
        return "".join(piece for piece, _ in self.level.pre_tokenize_str(char))

    def _plain(self, part: str) -> bytes:
        return array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()

    def _letters(self, word: str, before: str = "") -> bytes:
        """Of letters; ``before`` is a space as the model spells it, or nothing."""
        spelled = word if word.isascii() else word.translate(self.spelled)
        return array("I", [t.id for t in self.model.tokenize(before + spelled)]).tobytes()

    def _other(self, part: str) -> bytes:
        simple = _SIMPLE.fullmatch(part)
        if not simple:
            return self._plain(part)
        stem, stops = simple.groups()
        return self.others[stem] + self.others[stops] if stops else self._letters(part)

    def _word(self, word: str) -> bytes:
        """Of what stands after a space, up to the next."""
        simple = _SIMPLE.fullmatch(word)
        if simple:
            stem, stops = simple.groups()
            return self.words[stem] + self.others[stops] if stops else self._letters(word, self.space)
        if not _BEGINS.match(word):
            raise _NotCut
        first, *lines = word.split("\n")
        if lines and first[-1] not in " \t\r" and all(_BEGINS.match(x) for x in lines):
            # one new line each between visible characters
            return b"".join([self.words[first], *(self.others["\n"] + self.others[x] for x in lines)])
        return self._plain(" " + word)

    def encode(self, text: str | None) -> np.ndarray:
        """All ids of a text as uint32; none for NULL."""
        if not text:
            return np.zeros(0, np.uint32)
        if any(s in text for s in self.special):
            return np.frombuffer(self._plain(text), np.uint32)
        words = text.split(" ")
        try:
            ids = [self.others[words[0]]] if words[0] else []
            ids += map(self.words.__getitem__, words[1:])
        except _NotCut:
            ids = map(self.others.__getitem__, _CUT.split(text))
        return np.frombuffer(b"".join(ids), np.uint32)


_ENCODERS: dict[str, ByteEncoder] = {}


def encoder(path: str | None = None) -> ByteEncoder:
    """The encoder of this Python worker."""
    key = path or ""
    if key not in _ENCODERS:
        _ENCODERS[key] = ByteEncoder(path)
    return _ENCODERS[key]
