"""Simple-8b: whole numbers packed in 64-bit words, in blocks that are found and decoded on their own.

A word's highest four bits are its selector, which tells how many numbers of how many bits the other 60 hold. A
number of more than 60 bits stands in full behind the block's packed words; an escape word tells its place there.
So the packed words of a block can be told apart without reading them one after the other, and a block is
decoded by array operations. Every block starts with a word boundary and is listed with its offset.
"""

from __future__ import annotations

import numpy as np

# Fixed values of the format: numbers a word of each selector holds, and their bits. Selector 0 is a run of 240
# zeros, selector 15 an escape.
COUNTS = np.array([240, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1])
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60])
ESCAPE = 15
_SHIFT = np.uint64(60)
_REST = np.uint64(2**60 - 1)
_MASKS = ((np.uint64(1) << WIDTHS.astype(np.uint64)) - np.uint64(1)).astype(np.uint64)


def _selectors(numbers: np.ndarray) -> np.ndarray:
    """For each place, the selector of the word that would start there: the one that holds the most numbers.

    The last word of a block may be short of numbers; the missing ones are zeros.
    """
    n = len(numbers)
    need = np.searchsorted(_MASKS[:ESCAPE], numbers).astype(np.int8)  # the narrowest selector of each number alone
    out = need.copy()  # a word of one number: selector 14, or an escape
    out[need < ESCAPE] = ESCAPE - 1
    padded = np.concatenate((need, np.zeros(COUNTS[0], np.int8)))
    widest, reach = padded, 1  # the widest of so many numbers from each place on
    for selector in range(ESCAPE - 2, -1, -1):  # ever more numbers of ever fewer bits
        count = COUNTS[selector]
        while reach < count:
            step = min(reach, count - reach)
            widest = np.maximum(widest[:len(widest) - step], widest[step:])
            reach += step
        fits = widest[:n] <= selector
        out[fits] = selector
        if not fits[:max(n - count + 1, 0)].any() and count < n:
            break  # no more numbers fit anywhere, but for the last ones of the block
    return out


def pack(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed words, numbers written in full) of a block."""
    numbers = np.ascontiguousarray(numbers, dtype=np.uint64)
    n = len(numbers)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    selectors = _selectors(numbers)
    follow, at, starts = (np.arange(n) + COUNTS[selectors]).tolist(), 0, []
    while at < n:
        starts.append(at)
        at = follow[at]
    starts = np.array(starts, np.int64)
    chosen = selectors[starts]
    words = chosen.astype(np.uint64) << _SHIFT
    padded = np.concatenate((numbers, np.zeros(COUNTS[0], np.uint64)))
    for selector in np.flatnonzero(np.bincount(chosen, minlength=len(COUNTS))).tolist():
        mine = np.flatnonzero(chosen == selector)
        if selector == ESCAPE:
            words[mine] |= np.arange(len(mine), dtype=np.uint64)
        elif WIDTHS[selector]:
            first, packed = starts[mine], words[mine]
            for place in range(COUNTS[selector]):
                packed |= padded[first + place] << np.uint64(place * WIDTHS[selector])
            words[mine] = packed
    return words, numbers[starts[chosen == ESCAPE]]


def unpack(words: np.ndarray, full: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` numbers of a block."""
    selectors = (words >> _SHIFT).astype(np.int64)
    counts = COUNTS[selectors]
    starts = np.cumsum(counts) - counts
    of = np.repeat(np.arange(len(words)), counts)
    place = np.arange(len(of)) - starts[of]
    selector = selectors[of]
    out = ((words[of] & _REST) >> (place * WIDTHS[selector]).astype(np.uint64)) & _MASKS[selector]
    escaped = selectors == ESCAPE
    if escaped.any():
        out[starts[escaped]] = full[(words[escaped] & _REST).astype(np.int64)]
    if len(out) < n:
        raise ValueError("a block is too short")
    return out[:n]
