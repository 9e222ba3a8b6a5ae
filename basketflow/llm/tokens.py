"""Token ids of whole texts with a public tokenizer whose tokens never cross white space.

Such a tokenizer gives a text the ids of its white-space separated words in order. Arrow splits a
slice of texts and numbers its distinct words; every distinct word is encoded once per process, and
texts are put together from the known words by array indexing.
"""

import os
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from basketflow.llm.textbytes import text_slices

KNOWN_WORDS = 600_000
_TOGETHER = 500
_ENCODERS: dict = {}


class Ids(NamedTuple):
    first: int  # first row
    ids: np.ndarray  # of all texts of the slice, one after the other
    ends: np.ndarray  # where the ids of every text begin, and the last ones end


class WordEncoder:
    """Encodes by word; keeps at most about KNOWN_WORDS words beyond those of one slice."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self._tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._ids = np.zeros(0, np.uint32)
        self._ends = np.zeros(1, np.int64)

    def _learn(self, unknown: list[str]) -> None:
        """Many words in one text, a space between them; a token belongs to the word it begins in."""
        groups = [unknown[i : i + _TOGETHER] for i in range(0, len(unknown), _TOGETHER)]
        found = self._tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)
        ids, sizes = [self._ids], []
        for words, encoded in zip(groups, found):
            ends = np.cumsum([len(word) + 1 for word in words])
            begins = np.fromiter(chain.from_iterable(encoded.offsets), np.int64)[::2]
            sizes.append(np.bincount(np.searchsorted(ends, begins, side="right"), minlength=len(words)))
            ids.append(np.array(encoded.ids, np.uint32))
        self._known.update(zip(unknown, range(len(self._known), len(self._known) + len(unknown))))
        self._ids = np.concatenate(ids)
        self._ends = np.concatenate((self._ends, np.cumsum(np.concatenate(sizes)) + self._ends[-1]))

    def slices(self, column: pa.Array) -> Iterator[Ids]:
        """The ids of the texts of a column, in slices of consecutive rows; none for a null text."""
        for first, end, data, offsets in text_slices(column):
            if len(self._known) > KNOWN_WORDS:
                self._forget()
            buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
            split = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.large_string(), end - first, buffers))
            coded = split.values.dictionary_encode()
            distinct = coded.dictionary.to_numpy(zero_copy_only=False)
            numbers = np.array([self._known.get(word, -1) for word in distinct], np.int64)
            new = np.flatnonzero(numbers < 0)
            if len(new):
                numbers[new] = len(self._known) + np.arange(len(new))
                self._learn(distinct[new].tolist())
            numbers = numbers[coded.indices.to_numpy()]
            sizes = self._ends[numbers + 1] - self._ends[numbers]
            before = np.concatenate(([0], np.cumsum(sizes)))
            at = np.repeat(self._ends[numbers] - before[:-1], sizes)
            at += np.arange(len(at))
            yield Ids(first, self._ids[at], before[split.offsets.to_numpy()])

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text of a column, one text after the other."""
        for part in self.slices(column):
            for low, high in zip(part.ends.tolist(), part.ends[1:].tolist()):
                yield part.ids[low:high]


def encoder(path: str) -> WordEncoder:
    """The encoder of this Python process, which tasks that follow each other share."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
