"""Whole texts to token ids with a public tokenizer, word by word.

Both vocabularies cut a text at their added tokens, at white space and between
letters, digits and marks before any merge, so the ids of a text are the ids of its
units in order.  Units of plain characters are cut here as the file cuts them and go
straight to the library's merges; others are cut at white space only and go through
the whole library.  A unit is encoded once per Python worker and then looked up; the
memo is emptied when it is full, which costs time but never changes an id.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice

from .common import SPACES, sole_use

#: Vocabularies that this module knows how to cut, and their unit patterns.
#: ``byte``: a space belongs to the word after it, other white space stands
#: alone; ``word``: white space is dropped.
CUTS = {
    "byte": f" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+",
    "word": f"[^{SPACES}]+",
}

#: Plain characters: up to U+017F, but for two white spaces and one capital whose
#: lower case is two characters.  Their classes are old and they compose with nothing.
PLAIN = "[\x00-\x84\x86-\x9f\xa1-\u012f\u0131-\u017f]*"
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f"
DIGITS = "0-9\xb2\xb3\xb9\xbc-\xbe"
SUFFIX = "'(?:s|t|re|ve|m|ll|d)"
#: The files' own cuts of text in plain characters.
FINE = {
    "byte": f"{SUFFIX}| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^{SPACES}{LETTERS}{DIGITS}]+"
    f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+",
    "word": f"{SUFFIX}|[{LETTERS}]+|[{DIGITS}]|[^{SPACES}{LETTERS}{DIGITS}]+",
}


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_plain = re.compile(PLAIN).fullmatch


def _finder(cut: str) -> Callable[[str], list[str]]:
    """Text to its units: plain ones as the file cuts them, others up to white space."""
    coarse, split = re.compile(CUTS[cut]).findall, re.compile(FINE[cut]).findall
    fine = (lambda text: split(text.lower())) if cut == "word" else split

    def units(text: str) -> list[str]:
        if _plain(text):
            return fine(text)
        return [u for c in coarse(text) for u in (fine(c) if _plain(c) else (c,))]

    return units


def _byte_signs() -> dict[int, str]:
    """Plain code point to the signs that the vocabularies write for its bytes."""
    from tokenizers.pre_tokenizers import ByteLevel

    level = ByteLevel(add_prefix_space=False, use_regex=False)
    return {c: "".join(p for p, _ in level.pre_tokenize_str(chr(c))) for c in range(0x180)}


def _between(tokens: Iterable, find: Callable[[str], list[str]]) -> Callable[[str], list[str]]:
    """``find`` on the pieces between the added ``tokens``, each of which is a unit."""
    tokens = list(tokens)
    for t in tokens:
        if t.normalized or t.lstrip or t.rstrip or t.single_word:
            raise ValueError(f"added token {t.content!r} is not matched as it stands")
    names = sorted((t.content for t in tokens), key=len, reverse=True)
    if not names:
        return find
    split = re.compile("(" + "|".join(map(re.escape, names)) + ")").split

    def units(text: str) -> list[str]:
        if not any(name in text for name in names):
            return find(text)
        pieces = split(text)  # every second one is a token
        return [u for i, p in enumerate(pieces) for u in ((p,) if i % 2 else find(p))]

    return units


class Encoder:
    """Encodes texts with one vocabulary file; ``room`` bounds the memo, in units.

    ``cut`` names the unit pattern that fits the file's own pre-tokenizer.
    ``added``: the file's added tokens in a text get their own ids, as the library
    gives them by default, and the texts between them are cut into units; without
    it their strings are ordinary text.
    """

    _known: dict[tuple, "Encoder"] = {}

    #: Units that a memo holds, about 200 bytes each.
    ROOM = 900_000

    def __init__(self, path: str, cut: str, room: int | None = None, added: bool = False):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = not added
        self.tokenizer = tokenizer
        self.merge, self.signs = tokenizer.model.tokenize, _byte_signs()
        self.find, self.names = _finder(cut), frozenset()
        if added:
            tokens = list(tokenizer.get_added_tokens_decoder().values())
            self.find = _between(tokens, self.find)
            self.names = frozenset(t.content for t in tokens)
        self.room = room or self.ROOM
        self.memo: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str, cut: str) -> "Encoder":
        """One encoder per worker process, kept between tasks; ids as the library's."""
        sole_use(cls.__name__, cls._known.clear)
        if (path, cut) not in cls._known:
            cls._known[path, cut] = cls(path, cut, added=True)
        return cls._known[path, cut]

    def encoded(self, unit: str) -> bytes:
        """Ids of one unit."""
        if unit in self.names or not _plain(unit):
            [one] = self.tokenizer.encode_batch_fast([unit], add_special_tokens=False)
            ids = one.ids
        else:
            ids = [token.id for token in self.merge(unit.translate(self.signs))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, texts: Iterable[str], step: int = 64) -> Iterator[bytes]:
        """Per text all ids as little-endian unsigned 32-bit integers."""
        texts = iter(texts)
        while units := [self.find(text) for text in islice(texts, step)]:
            known = set(chain.from_iterable(units))
            new = list(known.difference(self.memo))
            if len(self.memo) + len(new) > self.room:
                self.memo.clear()
                new = list(known)
            for unit in new:
                self.memo[unit] = self.encoded(unit)
            for some in units:
                yield b"".join(map(self.memo.__getitem__, some))
