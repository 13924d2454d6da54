"""Hashes of words and of runs of words, and compact lists of sorted numbers, with NumPy on whole batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
_SHIFT = np.uint64(29)
#: Odd multipliers of the hashes.
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
#: Texts that are hashed at once, in bytes about.
SLICE_BYTES = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _SHIFT)) * _B
    return (x ^ (x >> _SHIFT)) * _C


def slices(texts: Sequence[bytes]) -> Iterator[tuple[int, int]]:
    """(first, after) of runs of texts of about SLICE_BYTES."""
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= SLICE_BYTES:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def word_hashes(texts: Sequence[bytes], seeds: Sequence[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each seed the hashes of all words of the texts in order, and the number of words of each text.

    Eight bytes of all words are taken in at a time, so the work follows words, not bytes.
    """
    data = b" ".join(texts) + b" " * 9
    raw = np.frombuffer(data, np.uint8)
    white = _WHITE[raw]
    edge = np.flatnonzero(white[1:] != white[:-1]) + 1
    if not white[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    starts = starts[: len(ends)]
    lengths = ends - starts
    eight = np.ndarray((len(raw) - 7,), "<u8", data, strides=(1,))
    first = eight[starts] & _KEEP[np.minimum(lengths, 8)]
    hashes = [mixed((first ^ np.uint64(s)) + lengths.astype(np.uint64) * _A) for s in seeds]
    at, left = 8, np.flatnonzero(lengths > 8)
    while len(left):
        more = eight[starts[left] + at] & _KEEP[np.minimum(lengths[left] - at, 8)]
        for h in hashes:
            h[left] = mixed(h[left] * _A + more)
        at += 8
        left = left[lengths[left] > at]
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, bounds), prepend=0)


def runs_of(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of the n words from each place on (places too near the end hold nothing of use)."""
    result, covered = None, 0
    part, width, power = words, 1, np.array([_A])  # an array, as its products wrap around
    left = n
    while left:
        if left & 1:
            if result is None:
                result = part
            else:
                result = result * power + _shifted(part, covered)
            covered += width
        left >>= 1
        if left:
            part = part * power + _shifted(part, width)
            power = power * power
            width *= 2
    return mixed(result)


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros(len(x), np.uint64)
    if by < len(x):
        out[: len(x) - by] = x[by:]
    return out


def word_windows(texts: Sequence[bytes], n: int, seeds: Sequence[int]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes (one array a seed) of all n-word windows, the text of each window, and words per text.

    Windows are in the order of their texts and places.
    """
    hashes: list[list[np.ndarray]] = [[] for _ in seeds]
    owners, counts = [], []
    for lo, hi in slices(texts):
        words, number = word_hashes(texts[lo:hi], seeds)
        counts.append(number)
        ends = np.cumsum(number)
        windows = np.maximum(number - n + 1, 0)
        owner = np.repeat(np.arange(hi - lo), windows)
        firsts = np.cumsum(windows) - windows
        place = np.arange(len(owner)) - firsts[owner] + (ends - number)[owner]
        owners.append((owner + lo).astype(np.int32))
        for out, w in zip(hashes, words):
            out.append(runs_of(w, n)[place] if len(place) else np.zeros(0, np.uint64))
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return [join(h, np.uint64) for h in hashes], join(owners, np.int32), join(counts, np.int64)


_FULL = 0xFFFF


def encode_sorted(values: np.ndarray) -> bytes:
    """Strictly rising numbers as 16-bit steps; a full step stands for 65,535 more to go."""
    steps = np.diff(values.astype(np.int64), prepend=-1)
    full, rest = np.divmod(steps, _FULL)
    out = np.full(len(steps) + int(full.sum()), _FULL, np.uint16)
    out[np.cumsum(full + 1) - 1] = rest
    return out.tobytes()


def decode_sorted(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint16)
    return np.cumsum(steps, dtype=np.int64)[steps != _FULL] - 1


def members(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array `among`; a small table turns most of the others away first."""
    if not len(among) or not len(values):
        return np.zeros(len(values), bool)
    bits = min(24, max(10, int(len(among)).bit_length() + 4))
    low = np.uint64((1 << bits) - 1)
    table = np.zeros(1 << bits, bool)
    table[(among & low).astype(np.int64)] = True
    found = table[(values & low).astype(np.int64)]
    at = np.flatnonzero(found)
    place = np.minimum(np.searchsorted(among, values[at]), len(among) - 1)
    found[at] = among[place] == values[at]
    return found
