"""Statistics of whole texts, computed on the bytes of a batch at once."""

import numpy as np
import pyarrow as pa

from basketflow.llm.spans import members
from basketflow.llm.textbytes import _EXACT, _SEPARATOR, mix, run_hashes, runs, text_slices, words

WINDOW = 3
_SYMBOLS = members("#*$%&|<>")
_UPPER = members("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = members("0123456789")
_STOP = members(".!?")

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_distinct", "n_upper", "n_digits", "n_stops", "n_odd_words")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets])


def _repeats(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a key met in another row of their text, and which in an earlier one."""
    order = np.lexsort((keys, owner))
    same = np.zeros(len(keys), dtype=bool)
    if len(keys):
        k, o = keys[order], owner[order]
        same[1:] = (k[1:] == k[:-1]) & (o[1:] == o[:-1])
    later, member = np.zeros(len(keys), bool), same.copy()
    member[:-1] |= same[1:]
    later[order] = same
    shared = np.zeros(len(keys), bool)
    shared[order] = member
    return shared, later


def slice_stats(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    found = words(data, offsets, lower=False)
    count = np.diff(found.first)
    owner = np.repeat(np.arange(len(count)), count)
    inside = ~_SEPARATOR[data]
    stats = {
        "n_words": count,
        "word_chars": _per_text(inside & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_text(_SYMBOLS[data], offsets),
        "n_upper": _per_text(_UPPER[data], offsets),
        "n_digits": _per_text(_DIGIT[data], offsets),
        "n_stops": _per_text(_STOP[data], offsets),
    }
    lines = data != 10
    starts = runs(lines, offsets)
    hashes = run_hashes(data, lines, starts, _EXACT)
    line_owner = np.searchsorted(offsets, starts, side="right") - 1
    first = np.searchsorted(found.starts, starts)
    after = np.searchsorted(found.starts, np.append(starts[1:], len(data)))
    filled = after > first
    _, later = _repeats(hashes[filled], line_owner[filled])
    stats["n_dup_lines"] = np.bincount(
        line_owner[filled][later], minlength=len(count)
    )
    stats["n_lines"] = np.bincount(line_owner[filled], minlength=len(count))
    _, later = _repeats(found.hashes, owner)
    stats["n_distinct"] = count - np.bincount(owner[later], minlength=len(count))
    covered = np.zeros(len(owner), bool)
    windows = len(owner) - WINDOW + 1
    if windows > 0:
        keys = np.zeros(windows, np.uint64)
        for i, factor in enumerate(mix(np.arange(1, WINDOW + 1, dtype=np.uint64)) | np.uint64(1)):
            keys += found.hashes[i : i + windows] * factor
        whole = np.flatnonzero(owner[:windows] == owner[WINDOW - 1 :])
        shared, _ = _repeats(mix(keys)[whole], owner[whole])
        for i in range(WINDOW):
            covered[whole[shared] + i] = True
    stats["n_repeat_words"] = np.bincount(owner[covered], minlength=len(count))
    ends = np.append(found.starts[1:], len(data))
    marks = np.concatenate(([0], np.cumsum(_SYMBOLS[data] | (data == 33))))
    odd = marks[ends] > marks[found.starts]
    stats["n_odd_words"] = np.bincount(owner[odd], minlength=len(count))
    return stats


def text_stats(column: pa.Array) -> list[pa.Array]:
    """COUNTS and MORE of every text; a null text has none of anything."""
    names = COUNTS + MORE
    parts = {name: [] for name in names}
    for _, _, data, offsets in text_slices(column):
        if len(data) == 0:
            found = {name: np.zeros(len(offsets) - 1, np.int64) for name in names}
        else:
            found = slice_stats(data, offsets)
        for name in names:
            parts[name].append(found[name])
    return [
        pa.array(np.concatenate(parts[n]).astype(np.int64) if parts[n] else [], pa.int64())
        for n in names
    ]
