"""A run-length index over many small groups of strings, and matching statistics against it.

The groups' strings lie one after the other, each ended by a byte UTF-8 never has. Suffixes are sorted
within their group, so one Burrows-Wheeler transform holds the transforms of all groups side by side. It
is kept as runs of equal bytes, with the text places of the suffixes at both ends of each run. Queries
run over all strings at once: one NumPy step takes the next byte of every string.
"""

from __future__ import annotations

import numpy as np

END = 0xFF
#: Bits of a text place in a sort key.
_BITS = 21
#: Bytes that one index may hold.
MOST = (1 << _BITS) - 1


def _dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order and ranks (equal keys, equal rank) of numbers below 2^42."""
    packed = np.sort((keys << np.uint64(_BITS)) | np.arange(len(keys), dtype=np.uint64))
    order = (packed & np.uint64(MOST)).astype(np.int64)
    keys = packed >> np.uint64(_BITS)
    rank = np.empty(len(keys), np.uint64)
    rank[order] = np.cumsum(np.concatenate([[False], keys[1:] != keys[:-1]])).astype(np.uint64)
    return order, rank


class RunIndex:
    """strings sorted by group; groups: 0, 1, ... of each string."""

    def __init__(self, strings: list[bytes], groups: np.ndarray):
        text = b"\xff".join(strings) + b"\xff"
        padded = text + b"\xff" * 16
        self.text = np.frombuffer(padded, np.uint8)
        self.eight = np.ndarray((len(text) + 8,), "<u8", padded, strides=(1,))
        n = len(text)
        lengths = np.array([len(s) + 1 for s in strings])
        ends = np.cumsum(lengths)
        left = np.repeat(ends, lengths) - np.arange(n)  # bytes up to and with the string's end
        group = np.repeat(groups, lengths)
        places = self._suffixes(left, group, int(lengths.max()))
        before = np.where(places > 0, self.text[places - 1], END)
        before[np.isin(places, ends - lengths)] = END
        group_of = group[places]
        new = np.ones(n, bool)
        new[1:] = (before[1:] != before[:-1]) | (group_of[1:] != group_of[:-1])
        self.starts = np.flatnonzero(new)
        size = np.diff(self.starts, append=n)
        self.heads = before[self.starts].astype(np.int64)
        self.first, self.last = places[self.starts], places[self.starts + size - 1]
        self.sizes = size
        # runs by group, byte and place: the order in which their bytes begin suffixes
        run_group = group_of[self.starts].astype(np.int64)
        self.count = len(self.starts)
        self.keys = (run_group * 256 + self.heads) * self.count + np.arange(self.count)
        self.order = np.argsort(self.keys, kind="stable")
        self.keys = self.keys[self.order]
        self.step = np.empty(self.count, np.int64)
        sizes = size[self.order]
        self.step[self.order] = np.cumsum(sizes) - sizes
        self.group_start = np.searchsorted(group_of, np.arange(int(groups[-1]) + 1))
        self.group_place = places[self.group_start]

    def _suffixes(self, left: np.ndarray, group: np.ndarray, longest: int) -> np.ndarray:
        """Text places in the order of group, suffix (up to its string's end) and place."""
        n = len(left)
        word = np.ndarray((n,), ">u4", self.text.tobytes(), strides=(1,)).astype(np.uint64)
        drop = (8 * np.maximum(4 - left, 0)).astype(np.uint64)
        order, rank = _dense((word >> drop) << drop)
        width = 4
        while width < longest and int(rank.max()) < n - 1:
            nearby = np.zeros(n, np.uint64)
            inside = np.flatnonzero(left > width)
            nearby[inside] = rank[inside + width] + np.uint64(1)
            order, rank = _dense((rank << np.uint64(_BITS)) | nearby)
            width *= 2
        return _dense((group.astype(np.uint64) << np.uint64(_BITS)) | rank)[0]

    def _common(self, one: np.ndarray, two: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of the suffixes at two places each, up to `most`."""
        common = np.zeros(len(one), np.int64)
        live = np.flatnonzero(most > 0)
        while len(live):  # eight bytes at a time
            at = common[live]
            differ = self.eight[one[live] + at] ^ self.eight[two[live] + at]
            lowest = (differ & (~differ + np.uint64(1))).astype(np.float64)  # a power of two, or 0
            same = np.where(lowest == 0, 8, (np.frexp(lowest)[1] - 1) >> 3)
            common[live] += same
            live = live[(same == 8) & (common[live] < most[live])]
        return np.minimum(common, most)

    def matching_statistics(self, strings: list[bytes], groups: np.ndarray) -> np.ndarray:
        """For each string (row) and place the length of the longest match in the string's group.

        Each string is read backwards. While the byte read is the one before the current suffix, the
        match grows; else it goes on from the end of the last such run before it or the start of the
        next one, whichever shares more with the current suffix by the sampled places.
        """
        lengths = np.array([len(s) for s in strings])
        width = int(lengths.max())
        padded = np.frombuffer(b"".join(s.rjust(width, b"\xff") for s in strings), np.uint8).reshape(-1, width)
        found = np.zeros(padded.shape, np.int16)
        row = self.group_start[groups].copy()
        place = self.group_place[groups].copy()
        length = np.zeros(len(strings), np.int64)
        live = np.arange(len(strings))
        for at in range(width - 1, -1, -1):
            live = live[lengths[live] >= width - at]
            byte = padded[live, at].astype(np.int64)
            run = np.searchsorted(self.starts, row[live], "right") - 1
            same = self.heads[run] == byte
            hit = live[same]
            row[hit] = self.step[run[same]] + row[hit] - self.starts[run[same]]
            place[hit] -= 1
            length[hit] += 1
            miss = live[~same]
            if len(miss):
                self._jump(miss, byte[~same], run[~same], groups, row, place, length)
            found[live, at] = length[live]
        return found

    def _jump(self, miss, byte, run, groups, row, place, length) -> None:
        prefix = groups[miss].astype(np.int64) * 256 + byte
        at = np.searchsorted(self.keys, prefix * self.count + run)
        after, before = np.minimum(at, self.count - 1), np.maximum(at - 1, 0)
        has_after = (at < self.count) & (self.keys[after] // self.count == prefix)
        has_before = (at > 0) & (self.keys[before] // self.count == prefix)
        after, before = self.order[after], self.order[before]
        now, most = place[miss], length[miss]
        down = self._common(now, self.last[before], np.where(has_before, most, 0))
        up = self._common(now, self.first[after], np.where(has_after, most, 0))
        use_up = has_after & (~has_before | (up >= down))
        any_run = has_after | has_before
        kept = np.where(use_up, up, down)
        row[miss] = np.where(
            any_run,
            np.where(use_up, self.step[after], self.step[before] + self.sizes[before] - 1),
            self.group_start[groups[miss]],
        )
        place[miss] = np.where(
            any_run, np.where(use_up, self.first[after], self.last[before]) - 1, self.group_place[groups[miss]]
        )
        length[miss] = np.where(any_run, kept + 1, 0)
