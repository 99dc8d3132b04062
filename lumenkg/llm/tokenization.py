"""Encoding whole texts with the tokenizers library, each distinct unit once per worker.

A text is split into units whose encodings, put one after the other, equal the
encoding of the whole text; units met before come from a bounded cache. A new
unit is cut further where the library always cuts (around a line end, before
closing punctuation); a unit of Latin letters alone is one piece and goes
straight to the library's model. Texts where the split isn't proven (white
space around a space, special tokens, white space beyond ASCII) go to the
library whole.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

#: Entries of each of a worker's two cache generations; a full one becomes the old one.
MAX_UNITS = 600_000
#: Entries kept of units that are made of others.
MAX_JOINED = 400_000

_SPACED = re.compile(rb"[\t-\r ] [\t-\r ]")
#: UTF-8 forms of (or lead bytes shared by) the white space outside ASCII.
_WIDE_SPACE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")


#: A line end between characters other than white space, where the library always cuts on both sides.
_LINE_END = re.compile(rb"(?<=[^ \t-\r])\n(?=[^ \t-\r])")
#: Punctuation that is a piece of its own after a letter, in vocabularies of both kinds.
_CLOSING = b".,;:!?*#$%&"


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


_LETTERS = {b: letter for letter, b in byte_letters().items()}


def vocabulary_path(name: str) -> str:
    """Where a public vocabulary file lies on this machine; absolute paths are taken as they are."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class UnitEncoder:
    """ids of whole texts as little-endian unsigned 32-bit integers.

    ``split`` says where a text may be cut: ``"words"`` at any ASCII white
    space (vocabularies that drop white space), ``"spaced"`` before single
    spaces (byte-level vocabularies whose pieces may start with a space).
    """

    def __init__(self, vocabulary: str, split: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary_path(vocabulary))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [str(t).encode() for t in self._special_strings()]
        self.split = split
        self.model = self.tokenizer.model
        self.units: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.joined: dict[bytes, bytes] = {}

    def _special_strings(self) -> list[str]:
        return [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _whole(self, text: bytes) -> bytes:
        return array("I", self.tokenizer.encode(text.decode("utf-8"), add_special_tokens=False).ids).tobytes()

    def _units(self, text: bytes) -> list[bytes] | None:
        if any(s in text for s in self.specials):
            return None
        if self.split == "words":
            return None if any(s in text.lower() for s in self.specials) else text.lower().split()
        if _SPACED.search(text) or any(s in text for s in _WIDE_SPACE):
            return None
        first, *rest = text.split(b" ")
        return [first, *[b" " + x for x in rest]]

    def _direct(self, word: str, spaced: bool) -> bytes | None:
        """ids of one piece of Latin letters, or None."""
        if not word.isalpha() or max(word) > "\xff":
            return None
        if self.split == "words":
            word = word.lower()  # beyond ASCII
        if not word.isascii():
            word = word.encode("utf-8").decode("latin-1").translate(_LETTERS)
        return array("I", [t.id for t in self.model.tokenize("\u0120" + word if spaced else word)]).tobytes()

    def _unit(self, unit: bytes) -> bytes:
        """ids of a unit; units made of others are put together from theirs."""
        found = self.units.get(unit)
        if found is not None:
            return found
        if b"\n" in unit:
            lines = _LINE_END.split(unit)
            if len(lines) > 1:
                return self._unit(b"\n").join(map(self._unit, lines))
        core = unit.rstrip(_CLOSING)
        if core != unit and core.strip():
            last = core[-1:]
            if last.isalpha() or last >= b"\x80" and core.decode("utf-8")[-1].isalpha():
                return self._unit(core) + self._unit(unit[len(core) :])
        found = self.old.get(unit)
        if found is None:
            word = unit.decode("utf-8")
            spaced = word[:1] == " "
            found = self._direct(word[1:] if spaced else word, spaced)
            if found is None:
                found = self._whole(unit)
        if len(unit) <= 64:
            if len(self.units) >= MAX_UNITS:
                self.old, self.units = self.units, {}
            self.units[unit] = found
        return found

    def encode(self, text: bytes) -> bytes:
        units = self._units(text)
        if units is None:
            return self._whole(text)
        out = list(map(self.units.get, units))
        if None in out:
            joined = self.joined
            for i, found in enumerate(out):
                if found is None:
                    unit = units[i]
                    found = joined.get(unit)
                    if found is None:
                        found = self._unit(unit)
                        if unit not in self.units and len(unit) <= 64:
                            if len(joined) >= MAX_JOINED:
                                joined.clear()
                            joined[unit] = found
                    out[i] = found
        return b"".join(out)


@lru_cache(maxsize=4)
def unit_encoder(vocabulary: str, split: str) -> UnitEncoder:
    """One encoder per worker process."""
    return UnitEncoder(vocabulary, split)


def release_encoders() -> None:
    """Give back this worker's cached ids; called where a task of another operator begins."""
    unit_encoder.cache_clear()


@lru_cache(maxsize=4)
def inner_pairs(vocabulary: str) -> frozenset[tuple[int, int]]:
    """Pairs of neighbouring bytes inside any token: a merge never joins others, so between two letters whose bytes make
    no such pair the tokens of a text are those of its two parts."""
    from tokenizers import Tokenizer

    byte_of = byte_letters()
    tokens = [[byte_of.get(c, -1) for c in t] for t in Tokenizer.from_file(vocabulary_path(vocabulary)).get_vocab(with_added_tokens=False)]
    return frozenset(p for t in tokens for p in zip(t, t[1:]))


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8")
