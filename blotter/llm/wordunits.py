"""Word sequences of texts as arrays, for the operators that compare lines or
documents by their words.

Texts are lower-cased, letters and digits are kept, everything else separates
words.  A word becomes a 64-bit hash, a unit (a line or a text) the sequence of
its word hashes, and its name two independent 64-bit hashes of that sequence.
For alignment each word is one character, so an edit distance of two such
strings is one of words (two different words share a character once in
CODES pairs)."""

from __future__ import annotations

import numpy as np

LINE, SPACE = 10, 32
FIRST_CODE, CODES = 0x800, 0xD800 - 0x800
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_FOLD: np.ndarray | None = None
_MIXED: np.ndarray | None = None
_POWERS = np.ones(1, dtype=np.uint64)
_INVERSES = np.ones(1, dtype=np.uint64)


def _fold_char(c: int) -> int:
    low = chr(c).lower()
    return (ord(low) if len(low) == 1 else c) if chr(c).isalnum() else SPACE


def word_fold() -> np.ndarray:
    """Code point -> its lower case if a letter or digit, else a space (basic plane)."""
    global _FOLD
    if _FOLD is None:
        _FOLD = np.array([SPACE if 0xD800 <= c < 0xE000 else _fold_char(c) for c in range(0x10000)], dtype=np.uint32)
        _FOLD[LINE] = LINE
    return _FOLD


def mixed(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit hash of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mixed_chars(codes: np.ndarray) -> np.ndarray:
    """:func:`mixed` of code points, by a table of the basic plane."""
    global _MIXED
    if _MIXED is None:
        _MIXED = mixed(np.arange(0x10000, dtype=np.uint64))
    out = _MIXED[np.minimum(codes, 0xFFFF)]
    far = np.flatnonzero(codes > 0xFFFF)
    out[far] = mixed(codes[far].astype(np.uint64))
    return out


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd multiplier modulo 2**64 and their inverses, kept."""
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        step = pow(int(MULTIPLIER), -1, 1 << 64)
        _POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, MULTIPLIER)]), dtype=np.uint64)
        _INVERSES = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, np.uint64(step))]), dtype=np.uint64)
    return _POWERS, _INVERSES


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run ``values[start:end]`` (its length and order count)."""
    power, inverse = _powers(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * power[:len(values)], out=total[1:])
    return mixed((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Units:
    """The units of a list of texts: ``words`` (hashes), the words of unit i are
    ``words[offsets[i]:offsets[i + 1]]``; ``text`` and ``line`` say where it is."""

    def __init__(self, texts: list[str], by_line: bool):
        raw = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        codes = word_fold()[np.minimum(raw, 0xFFFF)]
        for c in np.unique(raw[raw > 0xFFFF]):
            codes[raw == c] = _fold_char(int(c))
        inside = codes > SPACE
        edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.words = run_hashes(mixed_chars(codes), starts, ends)
        text_starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])[:-1].astype(np.int64)
        if by_line:
            unit_starts = np.concatenate([[0], np.flatnonzero(codes == LINE) + 1])
        else:
            unit_starts = text_starts
        self.offsets = np.concatenate([np.searchsorted(starts, unit_starts), [len(starts)]])
        self.text = np.searchsorted(text_starts, unit_starts, side="right") - 1
        self.line = np.arange(len(unit_starts)) - np.searchsorted(unit_starts, text_starts)[self.text]
        if not texts:
            self.offsets, self.text, self.line = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def first_names(self) -> np.ndarray:
        """The first of :meth:`names`."""
        return run_hashes(self.words, self.offsets[:-1], self.offsets[1:]).view(np.int64)

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of each unit's word sequence."""
        s, e = self.offsets[:-1], self.offsets[1:]
        return (self.first_names(),
                run_hashes(mixed(self.words ^ np.uint64(0x5851F42D4C957F2D)), s, e).view(np.int64))

    def strings(self, wanted: np.ndarray) -> list[str]:
        """One character a word, for the units numbered in ``wanted``."""
        codes = (FIRST_CODE + (self.words % np.uint64(CODES)).astype(np.uint32)).astype("<u4")
        return [codes[self.offsets[i]:self.offsets[i + 1]].tobytes().decode("utf-32-le") for i in wanted]
