"""Spans of findings in texts: runs of bytes, code point places, digests."""

import hashlib
from bisect import bisect_left, bisect_right
from itertools import accumulate
from typing import NamedTuple

import numpy as np


class Span(NamedTuple):
    kind: str
    start: int  # code points, end exclusive
    end: int


def joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def digest(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()


def disjoint(found: list[Span], taken: list[Span]) -> list[Span]:
    """The spans of ``found`` that overlap none of ``taken`` nor an earlier one of their own."""
    kept: list[Span] = []
    busy = sorted((s.start, s.end) for s in taken)
    at = 0
    for span in sorted(found, key=lambda s: (s.start, s.end)):
        while at < len(busy) and busy[at][1] <= span.start:
            at += 1
        if at < len(busy) and busy[at][0] < span.end:
            continue
        if kept and kept[-1].end > span.start:
            continue
        kept.append(span)
    return kept


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in square brackets; overlaps count as one."""
    parts, at = [], 0
    for span in sorted(spans, key=lambda s: (s.start, -s.end)):
        if span.start >= at:
            parts += [text[at : span.start], f"[{span.kind}]"]
        at = max(at, span.end)
    return "".join(parts) + text[at:] if parts else text


def byte_runs(data: np.ndarray, member: np.ndarray, offsets: np.ndarray):
    """(starts, ends) of the runs of bytes that are members; runs end with their text."""
    inside = member[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    stop[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(begin), np.flatnonzero(stop) + 1


def members(chars: str) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[ord(c) for c in chars]] = True
    return table


def code_points(data: np.ndarray, offsets: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Code point place, within its text, of every byte place (ends of runs included)."""
    leads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    text = np.searchsorted(offsets, places, side="right") - 1
    text = np.minimum(text, len(offsets) - 2)
    return leads[places] - leads[offsets[text]]


def near(spans: list[Span]):
    """A function of (start, end) that gives the spans which may reach into it, in their order."""
    order = sorted(range(len(spans)), key=lambda i: spans[i].start)
    starts = [spans[i].start for i in order]
    reach = list(accumulate((spans[i].end for i in order), max))

    def within(start: int, end: int) -> list[Span]:
        low, high = bisect_right(reach, start), bisect_left(starts, end)
        return [spans[i] for i in sorted(order[low:high])]

    return within
