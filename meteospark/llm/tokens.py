"""Words of many texts at once: where they lie, a 64-bit hash of each, dense numbers for hashes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from meteospark.llm.hashing import mixed

_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACE, _BREAK = 32, 10


def byte_map(space: bytes, breaks: bytes = b"") -> bytes:
    """A table for bytes.translate: A-Z to lower case, `space` to a blank, `breaks` to a line end."""
    table = bytearray(range(256))
    table[65:91] = range(97, 123)
    for b in space:
        table[b] = _SPACE
    for b in breaks:
        table[b] = _BREAK
    return bytes(table)


class Words:
    """The words of texts that `byte_map` has prepared, in order.

    `starts` and `ends` are places in `data`, `counts` the words of each text, `piece` a number that
    rises by one or more at each break and each text, `hashes` one 64-bit hash a word.
    """

    def __init__(self, texts: Sequence[bytes], seed: int):
        self.data = b"\n".join(texts) + b"\n" * 9
        raw = np.frombuffer(self.data, np.uint8)
        inside = (raw != _SPACE) & (raw != _BREAK)
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edges = np.concatenate([[0], edges])
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.piece = np.searchsorted(np.flatnonzero(raw == _BREAK), self.starts)
        bounds = np.cumsum([len(t) + 1 for t in texts])
        self.counts = np.diff(np.searchsorted(self.starts, bounds), prepend=0)
        self.hashes = self._hashes(seed)

    def _hashes(self, seed: int) -> np.ndarray:
        """Eight bytes of every word are taken in at a time."""
        lengths = self.ends - self.starts
        eight = np.ndarray((len(self.data) - 7,), "<u8", self.data, strides=(1,))
        first = eight[self.starts] & _KEEP[np.minimum(lengths, 8)]
        hashes = mixed((first ^ np.uint64(seed)) + lengths.astype(np.uint64) * _STEP)
        at, left = 8, np.flatnonzero(lengths > 8)
        while len(left):
            more = eight[self.starts[left] + at] & _KEEP[np.minimum(lengths[left] - at, 8)]
            hashes[left] = mixed(hashes[left] * _STEP + more)
            at += 8
            left = left[lengths[left] > at]
        return hashes


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values and, for each value, its number among them."""
    if not len(values):
        return values, np.zeros(0, np.int64)
    order = np.argsort(values)
    ranked = values[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    number = np.empty(len(values), np.int64)
    number[order] = np.cumsum(first) - 1
    return ranked[first], number
