"""Token ids of words for a word-level BPE file, with a table of words that are one token.

The vocabulary's normaliser, pre-tokeniser and merges never look across white space, so a text's
ids are those of its white-space separated words in a row. Words come again and again: each worker
keeps a bounded memo of them. A word that is not in the memo is split into pre-tokens; those that
are proven to encode alone as one token are looked up, only the rest goes through the merges.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

from pyspark import Broadcast

from medallion.llm.common import slices

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

MEMO_WORDS = 200_000
MEMO_CHARS = 64
#: str.split() also splits at these, the tokenizer does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_ASCII_BLANKS = re.compile("[ \t\n\r\x0b\x0c]+")


@lru_cache(maxsize=4)
def load(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def prove_whole_tokens(path: str) -> dict[str, int]:
    """Pre-tokens (in the byte alphabet of the vocabulary) that encode alone as one token.

    A vocabulary string need not be reachable by the merges, so each candidate is put through
    them once. Bounded by the vocabulary; done once, before any text is read.
    """
    tokenizer = load(path)
    end = tokenizer.model.end_of_word_suffix or ""
    whole = {}
    for entry, number in tokenizer.get_vocab(with_added_tokens=False).items():
        if entry.endswith(end):
            word = entry[: len(entry) - len(end)] if end else entry
            if word:
                found = tokenizer.model.tokenize(word)
                if len(found) == 1 and found[0].id == number:
                    whole[word] = number
    return whole


class _Memo(dict):
    """Words already encoded; emptied when full, so a worker's memory stays bounded."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word):
        value = self.make(word)
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = value
        return value


_BEYOND_LATIN = re.compile("[^\x00-\xff]")
#: Letters of one case mapping and one composition in every Unicode version, then at most one mark.
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,]?)")


def _byte_letters() -> dict[int, int]:
    """Byte value to letter of the byte-level alphabet: printable bytes stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + n for n, b in enumerate(others)}


class WordEncoder:
    """Ids or counts of texts; equal to the tokenizer's own, special strings included."""

    def __init__(self, path: str, whole: dict[str, int]):
        self.tokenizer, self.whole = load(path), whole
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.counts, self.packed = _Memo(self._count), _Memo(self._packed)
        self.piece_counts, self.piece_ids = _Memo(self._piece_count), _Memo(self._piece_ids)

    def _pre_tokens(self, word: str) -> list[str]:
        plain = _PLAIN.fullmatch(word)
        if plain:
            letters, mark = plain.groups()
            letters = letters.lower()
            if not letters.isascii():
                letters = letters.encode().decode("latin-1").translate(self.letters)
            return [letters, mark] if mark else [letters]
        word = self.tokenizer.normalizer.normalize_str(word)
        return [piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(word)]

    def _special_ids(self, word: str) -> list[int] | None:
        if "<" in word and any(s in word for s in self.special):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        return None

    def _piece_count(self, piece: str) -> int:
        return 1 if piece in self.whole else len(self.tokenizer.model.tokenize(piece))

    def _piece_ids(self, piece: str) -> bytes:
        number = self.whole.get(piece)
        ids = [number] if number is not None else [
            t.id for t in self.tokenizer.model.tokenize(piece)]
        return array("I", ids).tobytes()

    def _count(self, word: str) -> int:
        if word.isascii() and word.isalpha():
            return self.piece_counts[word.lower()]
        special = self._special_ids(word)
        if special is not None:
            return len(special)
        return sum(map(self.piece_counts.__getitem__, self._pre_tokens(word)))

    def _packed(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self.piece_ids[word.lower()]
        special = self._special_ids(word)
        if special is not None:
            return array("I", special).tobytes()
        return b"".join(map(self.piece_ids.__getitem__, self._pre_tokens(word)))

    def count(self, text: str) -> int:
        return sum(sum(map(self.counts.__getitem__, words)) for words in self._words(text))

    def encode(self, text: str) -> bytes:
        """Ids as native (little-endian) unsigned 32-bit integers."""
        return b"".join(b"".join(map(self.packed.__getitem__, words))
                        for words in self._words(text))

    @staticmethod
    def _words(text: str) -> Iterator[list[str]]:
        if "<|" not in text and (text.isascii() or not _BEYOND_LATIN.search(text)):
            text = text.lower()  # as the normaliser would; fewer words for the memo
        for part in slices(text):
            if _SEPARATORS.search(part):
                yield [word for word in _ASCII_BLANKS.split(part) if word]
            else:
                yield part.split()


_ENCODERS: dict[str, WordEncoder] = {}


def encoder_for(path: str, whole: Broadcast) -> WordEncoder:
    """The worker's encoder; a Python worker that is reused keeps its memo between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path, whole.value)
    return _ENCODERS[path]
