"""Words of many texts at a time: runs of bytes in one buffer, found and hashed by numpy without an object for each word."""

from __future__ import annotations

import numpy as np

SPACE, LETTER, DIGIT, MARK, ODD = range(5)
#: Blanks round a buffer, so that 16 bytes from any word on can be read.
_PAD = b"\n" * 24
_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: ASCII only; bytes from 128 on and controls are odd.
CLASS = np.full(256, ODD, dtype=np.uint8)
CLASS[33:127] = MARK
CLASS[[*range(48, 58)]] = DIGIT
CLASS[[*range(65, 91), *range(97, 123)]] = LETTER
CLASS[[32, *range(9, 14)]] = SPACE
#: The lowest n bytes of a 64-bit number.
_LOWEST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts, each behind a line end, with blanks round them; where each text begins, and where a next one would."""
    data = [t.encode("utf-8", "replace") for t in texts]
    buffer = np.frombuffer(b"".join((_PAD, b"\n".join(data), _PAD)), dtype=np.uint8)
    return buffer, len(_PAD) + np.concatenate([[0], np.cumsum([len(x) + 1 for x in data], dtype=np.int64)])


def eight(buffer: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place of a buffer on, as a little-endian number."""
    return np.ndarray((len(buffer) - 7,), dtype="<u8", buffer=buffer, strides=(1,))


def scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def keys(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of 16 bytes at most as two numbers."""
    at = eight(buffer)
    return at[starts] & _LOWEST[np.minimum(lengths, 8)], at[starts + 8] & _LOWEST[np.clip(lengths - 8, 0, 8)]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words between ASCII white space, A-Z lower-cased, and the number of words before each text and in all."""
    raw, text_starts = joined(texts)
    buffer = LOWER[raw]
    blank = CLASS[buffer] == SPACE
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, ends = edge[::2], edge[1::2]
    at, left = eight(buffer), ends - starts
    h = left.astype(np.uint64) * _MIX
    which, where = slice(None), starts
    while len(where):  # eight bytes of every word that isn't at its end
        h[which] = scramble((h[which] ^ (at[where] & _LOWEST[np.minimum(left, 8)])) * _MIX)
        more = np.flatnonzero(left > 8)
        which = more if isinstance(which, slice) else which[more]
        where, left = where[more] + 8, left[more] - 8
    return h, np.searchsorted(starts, text_starts)


class WordTable:
    """Numbers of words of 16 bytes at most, by open addressing; words are exact keys, so none is taken for another."""

    def __init__(self, bits: int = 16):
        self.size, self.bits = 0, bits
        self.first, self.second = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        self.number = np.full(1 << bits, -1, np.int32)

    def _slots(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return (scramble(first * _MIX ^ scramble(second)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Each word's number, -1 if it has none."""
        slot = self._slots(first, second)
        out = self.number[slot]
        wrong = np.flatnonzero((out >= 0) & ((self.first[slot] != first) | (self.second[slot] != second)))
        slot, first, second = slot[wrong], first[wrong], second[wrong]
        while len(wrong):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            found = self.number[slot]
            out[wrong] = found
            on = np.flatnonzero((found >= 0) & ((self.first[slot] != first) | (self.second[slot] != second)))
            wrong, slot, first, second = wrong[on], slot[on], first[on], second[on]
        return out

    def add(self, first: np.ndarray, second: np.ndarray, number: np.ndarray) -> None:
        """Words that the table lacks, each once."""
        if 2 * (self.size + len(first)) > 1 << self.bits:
            old = self.number >= 0
            first, second, number = np.append(self.first[old], first), np.append(self.second[old], second), np.append(self.number[old], number)
            self.__init__(max(self.bits + 1, int(2 * len(first)).bit_length()))
        self.size += len(first)
        slot = self._slots(first, second)
        left = np.arange(len(first))
        while len(left):
            free = left[self.number[slot[left]] < 0]
            self.number[slot[free]] = number[free]  # of several words for a slot one stays
            held = free[self.number[slot[free]] == number[free]]
            self.first[slot[held]], self.second[slot[held]] = first[held], second[held]
            done = np.zeros(len(first), bool)
            done[held] = True
            left = left[~done[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
