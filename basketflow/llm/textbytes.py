"""Words and hashes of many texts at once, on the UTF-8 bytes of an Arrow column.

A word is a run of bytes other than ``\\x20 \\x09-\\x0D``. Words are known by 64-bit hashes: a
polynomial over random byte values, finished by a mixing function, so that two different words of
a corpus of 10**9 words collide with a chance of about 3 in 100 altogether.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[int, np.ndarray] = {}


class Words(NamedTuple):
    hashes: np.ndarray
    starts: np.ndarray  # first byte of every word
    first: np.ndarray  # first word of every text, and the number of words


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_EXACT = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_LOWER = _EXACT.copy()
_LOWER[65:91] = _EXACT[97:123]


def _powers(base: int, size: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < size:
        steps = np.full(max(size, SLICE_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if len(known) <= 2 * SLICE_BYTES:
            _POWERS[base] = known
    return known[:size]


def text_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of about SLICE_BYTES: (first row, end row, bytes, offsets of the texts).

    A null text is empty. A longer text is a slice of its own, never cut.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        low, high = offsets[row], offsets[end]
        yield row, end, data[low:high], offsets[row : end + 1] - low
        row = end


def runs(inside: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First positions of the runs of True; a run ends with its text."""
    before = np.zeros(len(inside), dtype=bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(inside)]] = False
    return np.flatnonzero(inside & ~before)


def run_hashes(
    data: np.ndarray, inside: np.ndarray, starts: np.ndarray, values: np.ndarray
) -> np.ndarray:
    """A 64-bit hash of the bytes of every run."""
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint64)
    terms = values[data]
    terms *= _powers(_BASE, len(data))
    terms[~inside] = 0
    return mix(np.add.reduceat(terms, starts) * _powers(_INVERSE, len(data))[starts])


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Words:
    """All words of a slice, with A-Z taken as a-z if ``lower``."""
    inside = ~_SEPARATOR[data]
    starts = runs(inside, offsets)
    hashes = run_hashes(data, inside, starts, _LOWER if lower else _EXACT)
    return Words(hashes, starts, np.searchsorted(starts, offsets))


def hash_word(word: str, lower: bool = True) -> int:
    """The hash of a single word, as a signed number."""
    data = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(words(data, np.array([0, len(data)]), lower).hashes.view(np.int64)[0])
