"""Token ids of public tokenizers inside tasks, with a bounded cache of words.

The texts are cut where the tokenizer itself always cuts (in front of a single space between two other characters,
or at white space for tokenizers that drop it), so equal pieces have equal ids and most come from the cache. Texts
with other white space around such a cut, or with a special token's string, are encoded whole.
"""

from __future__ import annotations

import gc
import os
import re
from array import array

import numpy as np

CACHE = 160 << 20  # bytes of pieces and words, all together, that an encoder keeps in a Python worker
ENTRY = 160  # bytes of an entry besides its characters and ids

# Characters whose class and lower case all Unicode versions agree on; pieces of them are split here as the
# tokenizer's own pattern splits them, and only their words go to its model.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = re.compile(rf"[ \n0-9!-/:-@\[-`{{-~{LETTERS}]+")

SIMPLE = re.compile(rf"( ?[{LETTERS}]+)([!-/:-@]*)")


def byte_alphabet() -> dict[int, str]:
    """Byte-level vocabularies write a byte as itself if it prints, else as the next character from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(others)}


def path(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Uneven(Exception):
    """A piece with white space at an end: its text has to be encoded whole."""


class Encoder(dict):
    """Ids as little-endian unsigned 16-bit (vocabularies below 65,536 only), without special tokens.

    The dictionary maps a piece to its ids and codes new pieces when they are asked for.
    """

    _made: dict = {}
    words_of: re.Pattern

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are parallel already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        if self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError("ids need more than 16 bits")
        self.model = self.tokenizer.model
        self.words: dict = {}
        self.before: tuple[dict, dict] = {}, {}
        self.size = 0
        self.bytes = byte_alphabet()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    @classmethod
    def of(cls, file: str):
        """One encoder per file and worker."""
        if (cls, file) not in cls._made:
            cls._made[cls, file] = cls(file)
        return cls._made[cls, file]

    def keep(self, into: dict, key, ids: bytes) -> bytes:
        into[key] = ids
        self.size += len(key) + len(ids) + ENTRY
        return ids

    def model_ids(self, word: str) -> bytes:
        plain = word.isascii() and word.isprintable()
        coded = word.replace(" ", "Ġ") if plain else word.encode().decode("latin-1").translate(self.bytes)
        return array("H", [t.id for t in self.model.tokenize(coded)]).tobytes()

    def word(self, word: str) -> bytes:
        if (ids := self.words.get(word)) is None:
            if (ids := self.before[1].get(word)) is None:
                ids = self.model_ids(word)
            self.keep(self.words, word, ids)
        return ids

    def letters(self, word: str) -> bytes:
        """Ids of a word of letters, which is a piece itself where it can be."""
        return self.word(word)

    def part(self, word: str) -> bytes:
        return self.letters(word) if word[-1].isalpha() and (word[0] == " " or word[0].isalpha()) else self.word(word)

    def code(self, text: str) -> bytes:
        if simple := SIMPLE.fullmatch(text):
            return self.letters(simple[1]) + self.word(simple[2]) if simple[2] else self.model_ids(simple[1])
        if PLAIN.fullmatch(text):
            return b"".join(map(self.part, self.words_of.findall(text)))
        return self.whole(text)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a text, as bytes."""
        if self.size > CACHE // 2:  # what is met again comes back from the half before
            self.before, self.words, self.size = (self.copy(), self.words), {}, 0
            self.clear()
        if not any(s in text for s in self.special):
            try:
                return self.by_pieces(text)
            except Uneven:
                pass
        return self.whole(text)

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, null as the empty one. The collector rests meanwhile: nothing here has cycles, and it
        would walk through the cache again and again."""
        gc.disable()
        try:
            return [self.encode(t or "") for t in texts]
        finally:
            gc.enable()


class SpacedEncoder(Encoder):
    """For tokenizers that keep a space as the start of the next word (byte-level pieces)."""

    words_of = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")

    def __missing__(self, piece: str) -> bytes:  # of the text behind a space
        if (ids := self.before[0].get(piece)) is None:
            if piece.isalpha() and piece.isascii():
                ids = array("H", [t.id for t in self.model.tokenize("Ġ" + piece)]).tobytes()
            elif simple := SIMPLE.fullmatch(piece):
                ids = self[simple[1]] + self.word(simple[2]) if simple[2] else self.model_ids(" " + piece)
            elif not piece or piece[0].isspace() or piece[-1].isspace():
                raise Uneven
            else:
                ids = self.code(" " + piece)
        self[piece] = ids
        self.size += len(piece) + len(ids) + ENTRY
        return ids

    def letters(self, word: str) -> bytes:
        return self[word[1:]] if word[0] == " " else self.word(word)

    def by_pieces(self, text: str) -> bytes:
        first, *more = text.split(" ")
        if first[-1:].isspace() or not first and more:
            raise Uneven
        return self.code(first) + b"".join(map(self.__getitem__, more))


class WordEncoder(Encoder):
    """For tokenizers that lower-case and drop white space."""

    words_of = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+")

    def __missing__(self, piece: bytes) -> bytes:
        if (ids := self.before[0].get(piece)) is None:
            text = piece.decode()
            if not text.isascii() and PLAIN.fullmatch(text):
                text = text.lower()
            ids = self.code(text)
        return self.keep(self, piece, ids)

    def letters(self, word: str) -> bytes:
        return self[word.encode()]

    def by_pieces(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.encode().lower().split()))
