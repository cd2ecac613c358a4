"""Simple-8b: as many whole numbers as fit in a 64-bit word, whose highest four bits say how many and how wide they are.

A block of numbers begins a word of its own, so that it can be read from its offset alone; what its last word has room for beyond the
block is zeros. A number of more than 60 bits leaves a zero in its place and is kept apart, as an escape. Words have no state in
common: a decoder looks up the counts of all words, sums them up to places and takes the numbers out of all words of one kind at once.
"""

from __future__ import annotations

import numpy as np

# Fixed values of the coding: how many numbers a word holds, and their bits, by selector.
COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)

BLOCK = 4096
WIDEST = 60
_COUNTS = np.array(COUNTS, np.int64)


def _selectors(widths: np.ndarray, block: int) -> np.ndarray:
    """For each place the selector of a word that begins there: the one with most numbers. ``widths``: a row for each padded block.

    Where no word of a kind can begin none with more, narrower numbers can, so kinds are tried up to the first that is nowhere possible.
    """
    widest, k = widths, 1
    chosen = np.empty((len(widths), block), np.uint8)
    for selector in reversed(range(len(COUNTS))):
        count = COUNTS[selector]
        while 2 * k <= count:
            widest = np.maximum(widest[:, :-k], widest[:, k:])
            k *= 2
        largest = np.maximum(widest[:, :block], widest[:, count - k : count - k + block])
        possible = largest <= BITS[selector]
        if not possible.any():
            break
        np.copyto(chosen, selector, where=possible)
    return chosen


def encode(numbers: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words, the word at which each block begins (and the number of words), and the places of the escapes."""
    blocks = -(-len(numbers) // block)
    # Behind each block zeros for its last word.
    width = block + max(COUNTS)
    padded = np.zeros((blocks, width), np.uint64)
    padded[:, :block].flat[: len(numbers)] = numbers
    # Exact up to 53 bits, and beyond never too small.
    widths = np.frexp(padded.astype(np.float64))[1].astype(np.uint8)
    escapes = widths > WIDEST
    padded[escapes], widths[escapes] = 0, 0
    selectors = _selectors(widths, block)

    begin, offsets = [], [0]
    for i in range(blocks):
        row, at, base, size = selectors[i].tobytes(), 0, i * width, min(block, len(numbers) - i * block)
        while at < size:
            begin.append(base + at)
            at += COUNTS[row[at]]
        offsets.append(len(begin))
    begin = np.array(begin, np.int64)
    kinds = selectors[begin // width, begin % width]
    words, flat = kinds.astype(np.uint64) << np.uint64(60), padded.ravel()
    for selector in np.unique(kinds).tolist():
        (mine,) = np.nonzero(kinds == selector)
        word, first = words[mine], begin[mine]
        for i in range(COUNTS[selector] if BITS[selector] else 0):
            word |= flat[first + i] << np.uint64(i * BITS[selector])
        words[mine] = word
    return words, np.array(offsets, np.uint64), np.flatnonzero(escapes[:, :block])


def decode(words: np.ndarray, offsets: np.ndarray, size: int, block: int = BLOCK) -> np.ndarray:
    """The numbers of consecutive blocks, ``size`` of them together; zeros where there are escapes.

    ``offsets`` are those of the blocks within ``words``; all blocks but the last are full.
    """
    kinds = (words >> np.uint64(60)).astype(np.uint8)
    counts = _COUNTS[kinds]
    places = np.cumsum(counts) - counts
    roomy = np.zeros(int(counts.sum()), np.uint64)
    for selector in np.unique(kinds).tolist():
        count, bits = COUNTS[selector], BITS[selector]
        (mine,) = np.nonzero(kinds == selector)
        mask = np.uint64((1 << bits) - 1)
        for i in range(count if bits else 0):
            roomy[places[mine] + i] = (words[mine] >> np.uint64(i * bits)) & mask
    firsts = np.append(places, len(roomy))[offsets[:-1].astype(np.int64)]
    numbers = np.arange(size)
    return roomy[firsts[numbers // block] + numbers % block]
