"""Word shingles of documents and their fast similarity sketches, as numpy code for one task.

Words are runs of bytes other than the six ASCII white-space characters, A-Z lowered.  A shingle is
``size`` words in a row; a text with fewer words has its whole sequence as the only shingle, a text
without words has none.  Shingles are held as 64-bit hashes.
"""

from __future__ import annotations

import numpy as np

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(31)
MOST_BINS = 512
_ONE = np.uint64(0xBF58476D1CE4E5B9)
_TWO = np.uint64(0x94D049BB133111EB)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(30))) * _ONE
    values = (values ^ (values >> np.uint64(27))) * _TWO
    return values ^ (values >> _SHIFT)


_LETTER = mix(np.arange(1, 257, dtype=np.uint64))


_ROUNDS = mix(np.arange(1_000, 1_000 + 4 * MOST_BINS, dtype=np.uint64)) | np.uint64(1)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE | np.uint64(1), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The distinct shingles of ``text``, sorted."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(_LOWER), dtype=np.uint8)
    if not raw.size:
        return np.empty(0, dtype=np.uint64)
    gap = _SPACE[raw]
    walled = np.concatenate(([True], gap, [True]))
    edges = np.flatnonzero(walled[1:] != walled[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not starts.size:
        return np.empty(0, dtype=np.uint64)
    lengths = ends - starts
    letters = _LETTER[raw[~gap]]
    first = np.cumsum(lengths) - lengths
    place = np.arange(letters.size) - np.repeat(first, lengths)
    powers = _powers(int(lengths.max()))
    words = mix(np.add.reduceat(letters * powers[place], first) + lengths.astype(np.uint64))
    wide = min(size, words.size)
    out = words[: words.size - wide + 1].copy()
    for step in range(1, wide):
        out = out * _BASE + words[step : words.size - wide + 1 + step]
    out = np.sort(mix(out + np.uint64(wide)))
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def sketch(elements: np.ndarray, bins: int) -> np.ndarray:
    """Fast similarity sketch: ``bins`` coordinates, each the least ``round + value`` placed in a bin.

    Round i < bins throws every element into one bin by hash; round bins + j puts every element into
    bin j, so after 2 * bins rounds no coordinate is empty.  Rounds end once all bins are filled.
    Two sets agree in a coordinate with a probability equal to their resemblance, and the number of
    agreeing coordinates is concentrated as that of independent ones.  ``bins`` is a power of two.
    """
    out = np.zeros(bins, dtype=np.uint32)
    if not elements.size:
        return out
    shift = np.uint64(64 - bins.bit_length() + 1)
    mask = (np.uint64(1) << shift) - np.uint64(1)
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    best, found = np.full(bins, none), np.zeros(bins, dtype=np.uint64)
    for at in range(2 * bins):  # elements are hashes already: multiply-shift gives each round its own order
        thrown = (elements ^ _ROUNDS[2 * at]) * _ROUNDS[2 * at + 1]
        if at < bins:
            here = np.full(bins, none)
            np.minimum.at(here, (thrown >> shift).astype(np.intp), thrown & mask)
            new = (best == none) & (here != none)
            best[new], found[new] = here[new], at
        elif best[at - bins] == none:
            best[at - bins], found[at - bins] = thrown.min() & (none >> np.uint64(1)), at
        if not (best == none).any():
            break
    return (mix(best + mix(found)) >> np.uint64(32)).astype(np.uint32)
