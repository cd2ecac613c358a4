"""Words and shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers whose results look random (multiply, shift and add up)."""
    with np.errstate(over="ignore"):
        x = x + _U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def _byte_values(lower: bool) -> np.ndarray:
    points = np.arange(256, dtype=np.uint64)
    if lower:
        points[65:91] += _U(32)
    return mix(points, 1)


_BASE = _U(0x2545F4914F6CDD1D)
_PLAIN, _LOWER = _byte_values(False), _byte_values(True)
# Fixed values of the contract: white space that separates words.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def text_bytes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row and where each text starts, with the end of the last; missing texts are empty."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.empty(0, np.uint8)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    if texts.null_count:
        sizes = np.diff(offsets) * texts.is_valid().to_numpy(zero_copy_only=False)
        if sizes.sum() != len(data):
            return text_bytes(texts.fill_null(b"").cast(pa.large_binary()))
    return data, offsets


def hashed_words(
    data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE, lower: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, and how many words come before each text, with their number at the end.

    ``space`` says which bytes separate words. Letters A-Z count as small ones if ``lower``.
    """
    word = ~space[data]
    starts_word = word.copy()
    starts_word[1:] &= ~word[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    starts_word[inner] = word[inner]
    starts = np.flatnonzero(starts_word)
    before = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.empty(0, np.uint64), before
    reach = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, reach)
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.append(_U(1), np.full(reach.max() - 1, _BASE)))
        values = (_LOWER if lower else _PLAIN)[data[starts[0] :]] * powers[place]
        values[~word[starts[0] :]] = 0
        hashes = np.add.reduceat(values, starts - starts[0])
    return mix(hashes, 2), before


def shingle_sets(texts: pa.StringArray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, ascending, and where each text's begin, with their number at the end.

    A text with fewer words is one shingle as a whole; one without words has none.
    """
    hashes, before = hashed_words(*text_bytes(texts))
    counts = np.diff(before)
    sizes = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    first = np.repeat(before[:-1] - starts, sizes) + np.arange(sizes.sum())
    length = np.repeat(np.minimum(counts, words), sizes)
    with np.errstate(over="ignore"):
        shingles = np.zeros(len(first), np.uint64)
        for i in range(words):
            inside = length > i
            taken = hashes[np.minimum(first + i, max(len(hashes) - 1, 0))] if len(hashes) else shingles
            shingles = np.where(inside, mix(shingles + taken, 3 + i), shingles)
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        shingles[start:end].sort()
    new = np.ones(len(shingles), bool)
    new[1:] = shingles[1:] != shingles[:-1]
    new[starts[sizes > 0]] = True
    return shingles[new], np.append(0, np.cumsum(new))[np.append(starts, ends[-1:] if len(ends) else 0)]
