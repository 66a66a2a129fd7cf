"""Word shingles of whole texts as sets of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Arrays of about fifty bytes stand for each byte of a slice.
SLICE_BYTES = 1_000_000
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_WEIGHTS = np.random.default_rng(5).integers(1, 2**63, 4096, dtype=np.uint64) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and where each begins; null is empty."""
    filled = pc.fill_null(texts, "").cast(pa.large_string())
    ends = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = np.frombuffer(filled.buffers()[2] or b"", np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Slices of about ``size`` bytes; a longer text is a slice of its own."""
    if len(texts):
        total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + size, "right")))
            yield texts.slice(at, to - at)
            at = to


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z in lower case, and the number of words before each text and at the end."""
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = bounds[1:-1][bounds[1:-1] < len(data)]
    begins[edges] |= inside[edges]
    first = np.flatnonzero(begins)
    counts = np.searchsorted(first, bounds)
    if not len(first):
        return np.zeros(0, np.uint64), counts
    place = np.arange(len(data)) - np.repeat(np.append(0, first), np.diff(np.concatenate([[0], first, [len(data)]])))
    weight = _WEIGHTS[place & 4095] * (2 * (place >> 12) + 1).astype(np.uint64)
    weight[~inside] = 0
    values = (_LOWER[data].astype(np.uint64) + np.uint64(1)) * weight
    return mix(np.add.reduceat(values, first)), counts


def shingle_sets(texts: pa.Array, width: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of ``width``-word shingles of all texts in a row, and each text's bounds.

    A text with fewer words has its whole sequence as one shingle; one without words has none.
    """
    words, counts = word_hashes(*text_bytes(texts))
    n = np.diff(counts)
    made = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(n)), made)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(made) - made, made) + counts[:-1][owner]
    total = np.zeros(len(owner), np.uint64)
    size = np.minimum(n, width)[owner]
    for k in range(width):
        odd = np.uint64((0x9E3779B97F4A7C15 * (2 * k + 3)) & (2**64 - 1)) | np.uint64(1)
        total += np.where(k < size, words[np.minimum(at + k, max(0, len(words) - 1))] * odd, np.uint64(0)) if len(words) else np.uint64(0)
    total = mix(total + size.astype(np.uint64))
    order = np.lexsort((total, owner))
    total, owner = total[order], owner[order]
    keep = np.append(True, (total[1:] != total[:-1]) | (owner[1:] != owner[:-1])) if len(total) else np.zeros(0, bool)
    total, owner = total[keep], owner[keep]
    return total, np.searchsorted(owner, np.arange(len(n) + 1))
