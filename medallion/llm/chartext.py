"""Letter n-grams of texts as numpy arrays, for the models that read characters."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

#: Characters handled at once. A longer text is read whole, in stretches of this length; n-grams
#: do not reach across their borders.
STRETCH = 1 << 18
#: Letters beyond the first 65,536 code points share the numbers of those, modulo 65,536; one that
#: would be a blank or nothing takes the number behind it.
BITS, MOST = 16, 4
SPACE = 32


@lru_cache(maxsize=1)
def _numbers() -> np.ndarray:
    """Number of every code point: itself for a letter, else that of a space."""
    numbers = np.full(0x110000, SPACE, np.uint64)
    for point in range(0x110000):
        if chr(point).isalpha():
            number = point & 0xFFFF
            numbers[point] = number if number not in (0, SPACE) else number + 1
    return numbers


def letters(text: str) -> np.ndarray:
    """Lower-cased letters; everything else is one space between them, and one at either end."""
    points = np.frombuffer(f" {text} ".lower().encode("utf-32-le", "surrogatepass"), "<u4")
    numbers = _numbers()[points]
    keep = np.ones(len(numbers), bool)
    keep[1:] = (numbers[1:] != SPACE) | (numbers[:-1] != SPACE)
    return numbers[keep]


def stretches(texts: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``owner, codes, ends``: letters of several texts in a row, up to about STRETCH of them.

    ``owner`` is the place of each part's text in ``texts``, ``ends`` where the part ends in
    ``codes``. Parts without letters are left out.
    """
    owner, parts, size = [], [], 0
    for number, text in enumerate(texts):
        for at in range(0, len(text), STRETCH):
            part = letters(text[at:at + STRETCH])
            if len(part) > 1:
                owner.append(number)
                parts.append(part)
                size += len(part)
            if size >= STRETCH:
                yield np.array(owner), np.concatenate(parts), np.cumsum([len(p) for p in parts])
                owner, parts, size = [], [], 0
    if parts:
        yield np.array(owner), np.concatenate(parts), np.cumsum([len(p) for p in parts])


def grams(codes: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``keys, part``: the n-grams (n at most MOST) within each part, 16 bits per letter."""
    count = len(codes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    keys = codes[:count].copy()
    for i in range(1, n):
        keys <<= np.uint64(BITS)
        keys |= codes[i:i + count]
    valid = np.ones(count, bool)
    for back in range(1, n):
        border = ends - back
        valid[border[(border >= 0) & (border < count)]] = False
    lengths = np.diff(np.concatenate([[0], ends]))
    part = np.repeat(np.arange(len(ends)), lengths)[:count]
    return keys[valid], part[valid]


def last_letters(keys: np.ndarray, n: int) -> np.ndarray:
    return keys & np.uint64((1 << (BITS * n)) - 1)


def first_letters(keys: np.ndarray) -> np.ndarray:
    """Everything but the last letter."""
    return keys >> np.uint64(BITS)


class Lookup:
    """Values by key; a table of twice the keys' number in slots, probed linearly."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.zeros(1 << bits, np.uint64)  # no n-gram is 0
        self.values = np.zeros(1 << bits)
        self.probes = 1
        slot, left = self._slots(keys), np.arange(len(keys))
        for probe in range(1 << bits):
            if not len(left):
                break
            at = (slot[left] + probe) & self.mask
            free = self.keys[at] == 0
            first = np.zeros(len(left), bool)
            first[np.unique(at, return_index=True)[1]] = True
            take = free & first
            self.keys[at[take]], self.values[at[take]] = keys[left[take]], values[left[take]]
            left, self.probes = left[~take], probe + 1

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``values, found``; the value of a key that is not there is 0."""
        slot = self._slots(keys)
        found = self.keys[slot] == keys
        values = np.where(found, self.values[slot], 0.0)
        left = np.flatnonzero(~found & (self.keys[slot] != 0))
        for probe in range(1, self.probes):
            if not len(left):
                break
            at = (slot[left] + probe) & self.mask
            hit = self.keys[at] == keys[left]
            found[left[hit]] = True
            values[left[hit]] = self.values[at[hit]]
            left = left[~hit & (self.keys[at] != 0)]
        return values, found
