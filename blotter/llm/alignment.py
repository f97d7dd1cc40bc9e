"""Banded edit distance of two strings (one character a word)."""

from __future__ import annotations


def lacking(a: str, b: str) -> int:
    """A lower bound of the edit distance: the distinct characters that one string
    lacks of the other, or the difference in length, whichever is most.  It is
    a metric, as each of the three numbers' larger one is."""
    x, y = set(a), set(b)
    return max(len(x - y), len(y - x), abs(len(a) - len(b)))


def banded_distance(a: str, b: str, limit: int) -> int:
    """Edit distance of ``a`` and ``b``, or -1 if it is more than ``limit``.

    The dynamic programme is done column by column on the 2 * limit + 1 diagonals
    around the main one.  A column is held as bit vectors of its vertical
    differences (+1 and -1), bit t for row column - limit + t, and advanced with
    integer operations on all rows at once; the distance is followed along
    the diagonal that ends in the last cell.  Rows above the first have no
    vertical difference, so that each column of them is one more than the last."""
    if len(a) < len(b):
        a, b = b, a
    gap = len(a) - len(b)
    if gap > limit:
        return -1
    start = 0
    while start < len(b) and a[start] == b[start]:
        start += 1
    end = 0
    while end < len(b) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start:len(a) - end], b[start:len(b) - end]
    if not b:
        return len(a)
    limit = min(limit, len(a))
    rows: dict[str, int] = {}
    for i, c in enumerate(a):
        rows[c] = rows.get(c, 0) | 1 << i
    width = 2 * limit + 1
    full = (1 << width) - 1
    up, down = full ^ ((1 << limit) - 1), 0  # column 0: rows from 1 on grow by one
    score, watched = gap, 1 << (limit + gap)
    for j, c in enumerate(b):
        equal = rows.get(c, 0)
        if equal:
            shift = j - limit  # bit t stands for row j + 1 - limit + t, which is a[j - limit + t]
            equal = (equal >> shift if shift >= 0 else equal << -shift) & full
        same = ((((equal & up) + up) ^ up) | equal | down) & full  # diagonal step is free
        if not same & watched:
            score += 1
            if score > limit:
                return -1
        right_up = down | (full ^ (same | up))
        right_down = same & up
        same >>= 1
        up = right_down | (full ^ (right_up | same))
        down = right_up & same
    return score
