"""Word shingles of texts as hashed sets, and sketches of many sets at once."""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words of a text.

    A-Z are lower-cased; words are what the blanks 0x20 and 0x09 to 0x0D part.  A
    shorter text is one shingle, one without words has none.
    """
    # Bytes are lower-cased and split by exactly these rules.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    k = min(width, len(words))
    runs = np.full(len(words) - k + 1, np.uint64(k), dtype=np.uint64)
    for i in range(k):
        runs = runs * _FACTOR + h[i : len(h) - k + 1 + i]
    return np.unique(mix(runs))


def similarity_sketches(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of ``coordinates`` values per non-empty set, by rounds of bin placement.

    In round i every element falls into one bin, at random in the first
    ``coordinates`` rounds and into bin i - ``coordinates`` afterwards, with a value
    that grows with the round.  A bin keeps its least value.  Sets with empty bins go
    on to the next round, so every bin is filled after twice ``coordinates`` rounds,
    for most sets after very few, and each bin agrees between two sets with
    probability equal to their Jaccard similarity.
    """
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    sizes = np.array([len(s) for s in sets])
    if not len(sizes):
        return np.empty((0, coordinates), dtype=np.uint64)
    items, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    sketch = np.full(len(sets) * coordinates, empty, dtype=np.uint64)
    low = np.uint64((1 << 40) - 1)
    for i in range(2 * coordinates):
        v = mix(items + np.uint64((i + 1) * int(_FACTOR) % (1 << 64)))
        if i < coordinates:
            place = ((v >> np.uint64(40)) * np.uint64(coordinates)) >> np.uint64(24)
        else:
            place = np.full(len(v), i - coordinates, dtype=np.uint64)
        value = (np.uint64(i) << np.uint64(40)) | (v & low)
        np.minimum.at(sketch, row * coordinates + place.astype(np.int64), value)
        open_rows = (sketch.reshape(-1, coordinates) == empty).any(axis=1)
        if not open_rows.any():
            break
        on = open_rows[row]
        items, row = items[on], row[on]
    return sketch.reshape(-1, coordinates)


def band_keys(sketches: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band of each sketch."""
    width = sketches.shape[1] // bands
    keys = np.zeros((len(sketches), bands), dtype=np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    parts = sketches[:, : bands * width].reshape(len(sketches), bands, width)
    for i in range(width):
        keys = mix(keys * _FACTOR + parts[:, :, i])
    return keys.view(np.int64)
