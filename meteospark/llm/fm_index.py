"""An FM-index over the words of a shard: suffix order, wavelet matrix, sampled places."""

from __future__ import annotations

import numpy as np

from meteospark.llm.tokens import numbered

#: Every so many words one place is kept; a walk to the next kept place takes that many steps at most.
SAMPLE = 16


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order. Zeros end a document and rank by their place.

    The first three words rank all suffixes; ranks then double their reach, and only suffixes that
    still tie are sorted again, so long repeats cost sorts of their own words alone.
    """
    n = len(text)
    ends = text == 0
    symbols = np.where(ends, np.cumsum(ends) - 1, text + np.int64(ends.sum()))
    size = int(symbols.max()) + 2 if n else 1
    rank, reach = symbols, 1
    while reach < 3 and size ** (reach + 1) < 1 << 62:
        later = np.zeros(n, np.int64)
        later[: n - reach] = symbols[reach:] + 1
        rank = rank * size + later
        reach += 1
    order = np.argsort(rank)
    sorted_rank = rank[order]
    first = np.concatenate([[True], sorted_rank[1:] != sorted_rank[:-1]])
    start_of = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = start_of
    tied = np.flatnonzero(~(first & np.append(first[1:], True)))
    while len(tied):
        suffixes = order[tied]
        # a tie never reaches past its document's end, which ranks by place
        later = rank[np.minimum(suffixes + reach, n - 1)]
        again = np.lexsort((later, rank[suffixes]))
        suffixes, later = suffixes[again], later[again]
        old = rank[suffixes]
        order[tied] = suffixes
        first = np.concatenate([[True], (old[1:] != old[:-1]) | (later[1:] != later[:-1])])
        new = tied[np.maximum.accumulate(np.where(first, np.arange(len(tied)), 0))]
        rank[suffixes] = new
        tied = tied[~(first & np.append(first[1:], True))]
        reach *= 2
    return order


class Bits:
    """A row of bits with counts of the ones before any place."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @staticmethod
    def packed(bits: np.ndarray) -> np.ndarray:
        data = np.packbits(bits, bitorder="little")
        return np.concatenate([data, np.zeros(8 - len(data) % 8, np.uint8)]).view(np.uint64)

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class Index:
    """Counts and places of word sequences in a text of word hashes, where 0 ends each document."""

    def __init__(self, words: np.ndarray, size: int, levels: list[np.ndarray], marks: np.ndarray, places: np.ndarray):
        self.words, self.size, self.places = words, size, places
        self.levels = [Bits(x) for x in levels]
        self.zeros = [size - int(b.before[-1]) for b in self.levels]
        self.marks = Bits(marks)
        symbols = np.arange(len(words) + 2)  # the last has the text's length
        self.first = self._starts(symbols)

    @classmethod
    def of(cls, hashes: np.ndarray, ends: np.ndarray) -> Index:
        """hashes: a word or, where `ends`, a document's end each."""
        words, number = numbered(hashes[~ends])
        text = np.zeros(len(hashes), np.int64)
        text[~ends] = number + 1
        order = suffix_order(text)
        before = text[order - 1]  # the suffix at 0 has the last end before it
        levels, left = [], before
        for level in reversed(range(int(len(words)).bit_length())):
            bit = (left >> level) & 1 == 1
            levels.append(Bits.packed(bit))
            left = np.concatenate([left[~bit], left[bit]])
        starts = np.concatenate([[True], ends[:-1]])
        kept = ((np.arange(len(text)) % SAMPLE == 0) | starts)[order]
        return cls(words, len(text), levels, Bits.packed(kept), order[kept].astype(np.int32))

    def _starts(self, symbols: np.ndarray) -> np.ndarray:
        """How many of the text's symbols are smaller than each of these."""
        low, high = np.zeros(len(symbols), np.int64), np.full(len(symbols), self.size)
        smaller = np.zeros(len(symbols), np.int64)
        for level, bits, zeros in self._from_top():
            one = (symbols >> level) & 1 == 1
            a, b = bits.ones(low), bits.ones(high)
            smaller += np.where(one, (high - b) - (low - a), 0)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return np.where(symbols >> len(self.levels) > 0, self.size, smaller)

    def _from_top(self):
        return zip(reversed(range(len(self.levels))), self.levels, self.zeros)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often the symbol comes before the word `at` places into the transform."""
        low, high = np.zeros(len(at), np.int64), at
        for level, bits, zeros in self._from_top():
            one = (symbol >> level) & 1 == 1
            a, b = bits.ones(low), bits.ones(high)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return high - low

    def step(self, rows: np.ndarray) -> np.ndarray:
        """The row of the suffix that begins one word earlier."""
        symbol, at = np.zeros(len(rows), np.int64), rows
        for level, bits, zeros in self._from_top():
            one = bits.get(at)
            symbol += one.astype(np.int64) << level
            a = bits.ones(at)
            at = np.where(one, zeros + a, at - a)
        # after the last level the symbol's occurrences lie side by side
        return self.first[symbol] + at - self._block(symbol)

    def _block(self, symbol: np.ndarray) -> np.ndarray:
        """Where the wavelet matrix has a symbol's occurrences at its end."""
        low = np.zeros(len(symbol), np.int64)
        for level, bits, zeros in self._from_top():
            one = (symbol >> level) & 1 == 1
            a = bits.ones(low)
            low = np.where(one, zeros + a, low - a)
        return low

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of all phrases at once.

        phrases: a row of hashes each, right-aligned. Returns the phrases that occur and the first and
        last rows (exclusive) of their suffixes.
        """
        width = phrases.shape[1]
        alive = np.arange(len(phrases))
        low, high = np.zeros(len(alive), np.int64), np.full(len(alive), self.size)
        for back in range(1, width + 1):
            on = lengths[alive] >= back
            hashes = phrases[alive, width - back]
            place = np.minimum(np.searchsorted(self.words, hashes), max(len(self.words) - 1, 0))
            known = (self.words[place] == hashes) if len(self.words) else np.zeros(len(alive), bool)
            keep = known | ~on
            alive, low, high, on, symbol = alive[keep], low[keep], high[keep], on[keep], place[keep] + 1
            if not len(alive):
                break
            base = self.first[symbol]
            low = np.where(on, base + self.rank(symbol, low), low)
            high = np.where(on, base + self.rank(symbol, high), high)
            keep = high > low
            alive, low, high = alive[keep], low[keep], high[keep]
        return alive, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The places of suffixes by their rows: steps back to the next kept place."""
        found = np.empty(len(rows), np.int64)
        steps, left = 0, np.arange(len(rows))
        while len(left):
            kept = self.marks.get(rows)
            at = self.marks.ones(rows[kept])
            found[left[kept]] = self.places[at] + steps
            rows, left = rows[~kept], left[~kept]
            if len(rows):
                rows = self.step(rows)
                steps += 1
        return found

    def to_bytes(self) -> bytes:
        head = np.array([self.size, len(self.words), len(self.levels), len(self.places)], np.int64)
        parts = [head, self.words, *[b.words for b in self.levels], self.marks.words, self.places]
        return b"".join(p.tobytes() for p in parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> Index:
        size, vocabulary, depth, kept = np.frombuffer(data, np.int64, 4).tolist()
        at, row = 32, (size + 7) // 8
        row = (row + 8 - row % 8) // 8  # as Bits.packed pads
        take = lambda kind, n: np.frombuffer(data, kind, n, at)
        words = take(np.uint64, vocabulary)
        at += 8 * vocabulary
        levels = []
        for _ in range(depth):
            levels.append(take(np.uint64, row))
            at += 8 * row
        marks = take(np.uint64, row)
        at += 8 * row
        return cls(words, size, levels, marks, take(np.int32, kept))
