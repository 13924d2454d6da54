"""Spelling variants: words one edit apart, found by pivotal grams.

Bigrams are ordered by how few words hold them. A word's prefix is its three rarest bigrams (and what ties
with the third); its pivots are two disjoint ones of the prefix, of the least summed frequency. One edit
spoils at most one of two disjoint bigrams, so of two near words the one whose prefix ends earlier in the
order has a pivot that the other holds in its prefix, at the same place from the left or from the right.
Then all that the edit can have changed lies on one side of that bigram. Words therefore meet by (bigram's
place, one side of it with at most one character left out): a key for each character of the side, not a
list of all words with the bigram, so what meets is nearly always near and no common bigram is hot.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteospark.llm.common import stored
from meteospark.llm.hashing import mixed

#: The alphabet: ASCII letters, and U+00C0 to U+00FF, which are one byte in Latin-1.
_MAP = bytearray(b" " * 256)
_MAP[65:91] = _MAP[97:123] = range(97, 123)
_MAP[0xC0:] = range(0xC0, 0x100)
_MAP = bytes(_MAP)
#: Words longer than this meet by all their characters but one; the bytes a task counts or spreads at once.
LONG, HELD_BYTES, SLICE_BYTES = 64, 32 << 20, 1 << 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_LENGTH, _LEFT, _RIGHT, _WHOLE = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))
#: A mixed value for each byte.
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * _LENGTH)


def counted_words(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_length: int = 7,
    least_count: int = 2,
    drop_every: int | None = None,
) -> DataFrame:
    """word, n: runs of letters, A-Z in lower case, with at least so many code points and occurrences.

    drop_every: where this number divides the CRC-32 h of `<id>:<word>`, the word loses its code point
    h % length (a made misspelling; rows without an id lose none). Null texts have no words. Counts are
    added up in a task before anything is sent, up to HELD_BYTES of words.
    """

    def rows(counts: dict[bytes, int]) -> pa.RecordBatch:
        names = [w.decode("latin-1") for w in counts]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        held = 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = (text or "").encode("latin-1", "replace").translate(_MAP).split()
                begin = None if key is None or not drop_every else crc32(f"{key}:".encode())
                for w, k in Counter([w for w in found if len(w) >= least_length]).items():
                    if begin is not None:
                        h = crc32(w if w.isascii() else w.decode("latin-1").encode(), begin)
                        if h % drop_every == 0:
                            at = h % len(w)
                            w = w[:at] + w[at + 1 :]
                            if len(w) < least_length:
                                continue
                    if w in counts:
                        counts[w] += k
                    else:
                        counts[w] = k
                        held += len(w) + 64
                if held > HELD_BYTES:
                    yield rows(counts)
                    counts, held = {}, 0
        if counts:
            yield rows(counts)

    slim = docs.select(F.col(id_column).cast("string"), F.col(text_column).cast("string"))
    sums = slim.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return sums.where(F.col("n") >= least_count)


def _flat(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes (Latin-1) of the words behind one another, where each begins, and lengths."""
    raw = [w.encode("latin-1") for w in words.to_pylist()]
    lengths = np.array([len(w) for w in raw], np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum(lengths) - lengths, lengths


def gram_frequencies(words: DataFrame) -> np.ndarray:
    """In how many places of distinct words each bigram is; at most 90 x 90 numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            flat, begin, _ = _flat(batch.column(0))
            grams = flat[:-1].astype(np.int64) * 256 + flat[1:]
            inside = np.ones(len(grams), bool)
            inside[begin[1:] - 1] = False
            total += np.bincount(grams[inside], minlength=1 << 16)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])

    rows = words.select("word").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << 16, np.int64)
    for r in rows.collect():
        out[r.gram] = r.n
    return out


def pivots(places: list[int], weights: list[int], wanted: int = 2) -> list[int]:
    """The `wanted` disjoint bigrams (places two or more apart) of the least summed weight.

    Dynamic programming over rising places: the best choice among the first i, with or without the i-th.
    """
    best: list[list[tuple[float, tuple[int, ...]]]] = [[(0, ())] * (len(places) + 1)]
    for count in range(1, wanted + 1):
        row: list[tuple[float, tuple[int, ...]]] = [(math.inf, ())]
        before = 0  # places that end before the i-th begins
        for i, (p, w) in enumerate(zip(places, weights)):
            while places[before] <= p - 2:
                before += 1
            cost, chosen = best[count - 1][before]
            row.append(min(row[-1], (cost + w, (*chosen, p))))
        best.append(row)
    return list(best[wanted][-1][1])


def prefix_grams(ranks: list[int], weights: list[int]) -> tuple[list[int], set[int]]:
    """Places of a word's prefix, rising, and which of them are pivots."""
    last = sorted(ranks)[2]
    prefix = [p for p, r in enumerate(ranks) if r <= last]
    return prefix, set(pivots(prefix, [weights[p] for p in prefix]))


def _left_out(flat: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, and for each of its characters a hash of the word without it."""
    top = int(lengths.max(initial=0))
    powers = np.full(top + 1, _BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    place = np.arange(len(flat)) - np.repeat(begin, lengths)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[flat] * powers[place], dtype=np.uint64)])
    first, whole = sums[begin], sums[begin + lengths]
    before, after = sums[:-1] - np.repeat(first, lengths), np.repeat(whole, lengths) - sums[1:]
    size = lengths.astype(np.uint64)
    return mixed((whole - first) ^ size * _LENGTH), mixed((before + after * _INVERSE) ^ np.repeat(size - np.uint64(1), lengths) * _LENGTH)


def _spread(begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers begin .. begin + length - 1 of every range, and the range of each."""
    of = np.repeat(np.arange(len(length)), length)
    return np.arange(len(of)) + np.repeat(begin - (np.cumsum(length) - length), length), of


def _keys(words: pa.Array, rank: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """key, word number, whether a pivot made it: all that words can meet by."""
    flat, begin, lengths = _flat(words)
    whole, without = _left_out(flat, begin, lengths)
    same = np.zeros(len(flat), bool)  # as its left neighbour: leaving either out gives the same
    same[1:] = flat[1:] == flat[:-1]
    grams = flat[:-1].astype(np.int64) * 256 + flat[1:]
    ranks, weights = rank[grams].tolist(), weight[grams].tolist()
    word, place, pivot = [], [], []
    for w, (a, n) in enumerate(zip(begin.tolist(), lengths.tolist())):
        if n <= LONG:
            prefix, chosen = prefix_grams(ranks[a : a + n - 1], weights[a : a + n - 1])
            word += [w] * len(prefix)
            place += prefix
            pivot += [p in chosen for p in prefix]
    word, place, pivot = np.array(word, np.int64), np.array(place, np.int64), np.array(pivot, bool)
    # nothing changed: the place from the left, and from the right
    tail = lengths[word] - place
    from_left, from_right = place.astype(np.uint64) * _RIGHT, tail.astype(np.uint64) * _LEFT
    keys = [mixed(whole[word] + from_left), mixed(whole[word] ^ from_right)]
    owners, flags = [word, word], [pivot, pivot]
    # a character behind the bigram is left out, then one before it
    at, of = _spread(begin[word] + place + 2, tail - 2)
    once = ~same[at] | (at == (begin[word] + place + 2)[of])
    at, of = at[once], of[once]
    keys.append(mixed(without[at] + from_left[of]))
    owners.append(word[of])
    flags.append(pivot[of])
    at, of = _spread(begin[word], place)
    once = ~same[at] | (at == begin[word][of])
    at, of = at[once], of[once]
    keys.append(mixed(without[at] ^ from_right[of]))
    owners.append(word[of])
    flags.append(pivot[of])
    # long words, and those that may be near one
    far = np.flatnonzero(lengths >= LONG)
    at, of = _spread(begin[far], lengths[far])
    once = ~same[at] | (at == begin[far][of])
    at, of = at[once], of[once]
    keys += [mixed(whole[far] ^ _WHOLE), mixed(without[at] ^ _WHOLE)]
    owners += [far, far[of]]
    flags += [np.ones(len(far), bool), np.ones(len(at), bool)]
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(flags)


def meeting_keys(words: DataFrame, frequencies: np.ndarray) -> DataFrame:
    """key, name, n, pivot: the rows by which words (word, name, n) meet."""
    rank = np.empty(1 << 16, np.int64)
    rank[np.lexsort((np.arange(1 << 16), frequencies))] = np.arange(1 << 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(np.maximum(pc.utf8_length(batch.column("word")).to_numpy(), 1))
            lo = 0
            while lo < len(batch):  # slices of so many characters, one word at least
                limit = (ends[lo - 1] if lo else 0) + SLICE_BYTES
                hi = max(lo + 1, int(np.searchsorted(ends, limit, "right")))
                part = batch.slice(lo, hi - lo)
                keys, owner, pivot = _keys(part.column("word"), rank, frequencies)
                owner = pa.array(owner)
                columns = [pa.array(keys.view(np.int64)), part.column("name").take(owner), part.column("n").take(owner), pa.array(pivot)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "name", "n", "pivot"])
                lo = hi

    return words.select("word", "name", "n").mapInArrow(run, "key long, name string, n long, pivot boolean")


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of different names among neighbours of one key, a pivot on one side; batches come sorted by key."""
    names = ["a", "b", "n_a", "n_b"]
    left = None
    for batch in _with_end(batches):
        parts = ([] if left is None else [left]) + ([] if batch is None else [pa.Table.from_batches([batch])])
        if not parts:
            return
        table = pa.concat_tables(parts)
        keys = table["key"].to_numpy()
        if batch is None:
            done = len(keys)
        else:  # the last key may go on in the next batch
            done = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            left = table.slice(done)
        keys, pivot = keys[:done], table["pivot"].to_numpy()[:done]
        step = 1
        at = np.flatnonzero(keys[1:] == keys[:-1]) if done else np.zeros(0, np.int64)
        while len(at):
            pair = at[pivot[at] | pivot[at + step]]
            if len(pair):
                one, two = table.take(pair), table.take(pair + step)
                a, b = one["name"].to_numpy(), two["name"].to_numpy()
                n, m = one["n"].to_numpy(), two["n"].to_numpy()
                swap, other = a > b, a != b
                columns = [np.where(swap, b, a)[other], np.where(swap, a, b)[other], np.where(swap, m, n)[other], np.where(swap, n, m)[other]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
            step += 1
            at = at[at + step < done]
            at = at[keys[at] == keys[at + step]]


def _with_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def near_words(words: DataFrame) -> DataFrame:
    """word, other, other_n: all pairs of words (word, n; words distinct) that are one edit apart, both ways.

    Words have three bigrams or more (four code points), in the alphabet of `counted_words`; empty tables
    have no pairs. A word of more than LONG code points goes by a name of fixed size until the end.
    """
    long = F.length("word") > LONG
    named = stored(words.withColumn("name", F.when(long, F.concat(F.lit("#"), F.sha2("word", 256))).otherwise(F.col("word"))), "words")
    keys = meeting_keys(named, gram_frequencies(named))
    met = keys.repartition("key").sortWithinPartitions("key").mapInArrow(_met, "a string, b string, n_a long, n_b long")
    pairs = stored(met.distinct(), "met")
    short = ~F.col("a").startswith("#") & ~F.col("b").startswith("#")
    spelled = named.where(F.length("word") >= LONG).select("name", "word")
    full = pairs.where(~short)
    for c in ("a", "b"):
        full = full.join(spelled.withColumnsRenamed({"name": c, "word": f"_{c}"}), c).drop(c).withColumnRenamed(f"_{c}", c)
    near = pairs.where(short).unionByName(full).where(F.levenshtein("a", "b", 1) == 1)
    side = lambda w, o, n: F.struct(F.col(w).alias("word"), F.col(o).alias("other"), F.col(n).alias("other_n"))
    return near.select(F.explode(F.array(side("a", "b", "n_b"), side("b", "a", "n_a"))).alias("p")).select("p.*")


def _roots(forms: DataFrame, rounds: int) -> DataFrame:
    """word, root: each round doubles the steps that `root` is away."""
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots_0")
    for k in range(rounds):
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = roots.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"))
        roots = stored(step, f"roots_{k + 1}")
    return roots


def spelling_groups(words: DataFrame, factor: int = 10) -> DataFrame:
    """word, n, n_near, form, form_n, root of a table of distinct words and their counts.

    form: the near word (one edit away) of largest n, ties by code points, if its n is at least `factor`
    times the word's; root: where forms lead in the end, the word itself without one. Counts rise by
    `factor` with each form, so chains are short and known in length.
    """
    words = stored(words.select("word", "n"), "counted")
    near = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min_by(F.struct("other", "other_n"), F.struct(-F.col("other_n"), F.col("other"))).alias("_best")
    )
    takes: Column = F.col("_best.other_n") >= factor * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.col("_best.other")).alias("form"),
        F.when(takes, F.col("_best.other_n")).alias("form_n"),
    )
    judged = stored(judged, "forms")
    least, most = judged.agg(F.min("n"), F.max("n")).first()
    steps = int(math.log(most / max(least, 1), factor)) + 1 if most else 0
    roots = _roots(judged.where(F.col("form").isNotNull()), math.ceil(math.log2(steps + 1)))
    return judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
