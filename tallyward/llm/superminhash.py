"""SuperMinHash signatures: each element gives the components the ranks 0, 1, 2, ... of a random permutation, plus a fraction.

A component keeps its least value. Since an element gives each rank once, the components are negatively correlated and the estimate
of a similarity has less variance than with independent hashes. Ranks are dealt in steps for all elements of many sets at
once; a set is finished as soon as no component can get a smaller value from the next rank.
"""

from __future__ import annotations

import numpy as np

from tallyward.llm.shingles import mix

_U = np.uint64
FRACTION = _U(32)
SLICE = 1 << 16


def signatures(elements: np.ndarray, offsets: np.ndarray, components: int) -> np.ndarray:
    """A row of ``components`` numbers for each set; ``offsets`` bound the sets. An empty set has the largest numbers."""
    sets = len(offsets) - 1
    out = np.full((sets, components), np.iinfo(np.uint64).max, np.uint64)
    start = 0
    while start < sets:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + SLICE, "right")) - 1)
        _sign(elements[offsets[start] : offsets[stop]], np.diff(offsets[start : stop + 1]), out[start:stop])
        start = stop
    return out


def _sign(elements: np.ndarray, sizes: np.ndarray, out: np.ndarray) -> None:
    components = out.shape[1]
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = None
    for step in range(components):
        random = mix(elements, 100 + step)
        # A place among those left over, and a fraction, from the two halves of a random number.
        chosen = (((random >> FRACTION) * _U(components - step)) >> FRACTION).astype(np.int64) + step
        value = (_U(step) << FRACTION) | (random & _U(0xFFFFFFFF))
        if step == 0:
            component, first = chosen, chosen
        else:
            if order is None:
                order = np.tile(np.arange(components, dtype=np.int16), (len(elements), 1))
                order[np.arange(len(elements)), first] = 0
                order[:, 0] = first
            rows = np.arange(len(elements))
            component = order[rows, chosen].astype(np.int64)
            order[rows, chosen] = order[:, step]
            order[:, step] = component
        np.minimum.at(flat, owner * components + component, value)
        open_sets = out.max(axis=1) >= (_U(step + 1) << FRACTION)
        left = open_sets[owner]
        if not left.any():
            return
        if not left.all():
            elements, owner = elements[left], owner[left]
            first = first[left]
            order = None if order is None else order[left]


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """A hash of each band of the signatures, different for each place of the band."""
    sets, components = signature.shape
    parts = signature.reshape(sets, bands, components // bands)
    with np.errstate(over="ignore"):
        keys = np.arange(bands, dtype=np.uint64)[None, :].repeat(sets, axis=0)
        for i in range(components // bands):
            keys = mix(keys + parts[:, :, i], 7)
    return keys.view(np.int64)


def lanes(signature: np.ndarray) -> np.ndarray:
    """A byte of each component, enough to estimate how many agree."""
    return (mix(signature, 8) & _U(0xFF)).astype(np.uint8)
