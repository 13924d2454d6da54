"""Best-fit decreasing packing of token pieces, over classes of equal length and equal room."""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meteospark.llm.common import cumulated, seeded, stored

#: Strings in a young table that a worker process remembers, and their longest length.
_REMEMBERED, _LONGEST = 1 << 16, 64
#: Bytes of text whose words are learnt at once.
_AT_ONCE = 1 << 22
#: What the splitting rule of a tokenizer file must be for words to be cut here, and the same rule for
#: printable ASCII and Latin-1 letters, whose lower case and normal form are the same everywhere.
_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = "^[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*$"
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
_PARTS = f"('s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^ 0-9{_LETTERS}]+)"
#: The character that stands for a byte in a tokenizer's model, where it isn't the byte's own.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARACTERS = {b: 256 + n for n, b in enumerate(sorted({*range(256)}.difference(_SHOWN)))}


class _WordIds:
    """Ids of space-free strings as little-endian unsigned 32-bit bytes.

    Where the tokenizer's rule allows, words are cut into parts here, by Arrow for all words of some texts at
    once. A part is then a word of the tokenizer's model and needs no normalising or splitting; other words go
    to the tokenizer as they are. Ids of both are remembered: a full table becomes the old one, of which
    strings that come again are taken back, and the one before it goes. So common ones stay, and memory holds
    two tables of short strings.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.cut = self._plain_words()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _plain_words(self) -> bool:
        """Whether plain words may be cut here: lower case, the known rule and bytes as characters."""
        t = self.tokenizer
        normal, split = ({} if step is None else json.loads(step.__getstate__()) for step in (t.normalizer, t.pre_tokenizer))
        rules = split.get("pretokenizers", [])
        return (
            bool(getattr(t.model, "end_of_word_suffix", None))
            and [s["type"] for s in normal.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and normal["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
            and [r["type"] for r in rules] == ["Split", "ByteLevel"]
            and (rules[0]["pattern"], rules[0]["behavior"], rules[0]["invert"]) == ({"Regex": _RULE}, "Removed", True)
            and not (rules[1]["add_prefix_space"] or rules[1]["use_regex"])
            and all("<|" in added.content for added in t.get_added_tokens_decoder().values())
        )

    def joined(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, whose words lie between spaces and line feeds."""
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        ends, found = words.offsets.to_numpy(), words.flatten().dictionary_encode()
        ids_of, numbers = self.of(found.dictionary).__getitem__, found.indices.to_numpy()
        for lo, hi in pairwise(ends - ends[0]):
            yield b"".join(map(ids_of, numbers[lo:hi].tolist()))

    def of(self, words: pa.Array) -> list[bytes]:
        """The ids of each of these words, which are distinct."""
        plain = pc.match_substring_regex(words, _PLAIN) if self.cut else pa.repeat(False, len(words))
        plain = pc.and_not(plain, pc.match_substring(words, "<|"))
        cut = pc.replace_substring_regex(pc.utf8_lower(words.filter(plain)), _PARTS, r"\1 ")
        parts = pc.split_pattern(cut, " ")
        flat = parts.flatten().dictionary_encode()
        ids_of = self._looked_up(flat.dictionary, self._part).__getitem__
        of_flat = list(map(ids_of, flat.indices.to_numpy().tolist()))
        joined = [b"".join(of_flat[lo:hi]) for lo, hi in pairwise(parts.offsets.to_numpy().tolist())]
        others = np.flatnonzero(~plain.to_numpy(zero_copy_only=False)).tolist()
        if not others:
            return joined
        of_others = self._looked_up(words.take(pa.array(others, pa.int64())), self._whole)
        rest, known = iter(joined), dict(zip(others, of_others, strict=True))
        return [known[i] if i in known else next(rest) for i in range(len(words))]

    def _looked_up(self, strings: pa.Array, find: Callable[[str], bytes]) -> list[bytes]:
        young, old, out = self.young, self.old, []
        for s in strings.to_numpy(zero_copy_only=False).tolist():
            ids = young.get(s)
            if ids is None:
                ids = old.get(s)
                if ids is None:
                    ids = find(s)
                if len(s) <= _LONGEST:
                    young[s] = ids
                    if len(young) >= _REMEMBERED:
                        young, old = {}, young
            out.append(ids)
        self.young, self.old = young, old
        return out

    def _part(self, part: str) -> bytes:
        """A part of a plain word: the model sees a character for each byte of UTF-8."""
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(_BYTE_CHARACTERS)
        ids = [t.id for t in self.tokenizer.model.tokenize(part)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def rest(self) -> None:
        """To be called when a task is done: the process may do other work next and needs its memory."""
        self.young, self.old = {}, {}
        pa.default_memory_pool().release_unused()


@lru_cache(maxsize=2)
def _known_words(path: str) -> _WordIds:
    """One table for all tasks of a worker process."""
    return _WordIds(path)


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows lo .. hi - 1 with about _AT_ONCE bytes of text, one row at least."""
    upto, lo = np.cumsum(pc.binary_length(texts).to_numpy()), 0
    while lo < len(texts):
        before = upto[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(upto, before + _AT_ONCE, "right")))
        yield lo, hi
        lo = hi


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 1,
    with_ids: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): each document's ids, then end_id, cut at capacity.

    The tokenizer's file must drop white space and split at it, so ids are joined from those of the
    parts between spaces and line feeds; each is looked up once for about 4 MB of text. A null text is empty; of a very long one all pieces come from one row. Null and repeated
    ids are passed on, empty tables give no rows, other columns aren't read.
    """
    end = end_id.to_bytes(4, "little")
    fields = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    id_type = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known_words(tokenizer_path)
        for batch in batches:
            docs_of, pieces, starts, lengths, sums, ids = [], [], [], [], [], []
            texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            for lo, hi in _slices(texts):
                for row, found in enumerate(known.joined(texts.slice(lo, hi - lo)), lo):
                    data = found + end
                    for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[at : at + 4 * capacity]
                        docs_of.append(row)
                        pieces.append(piece)
                        starts.append(at // 4)
                        lengths.append(len(part) // 4)
                        sums.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(np.frombuffer(part, "<u4").astype("i4"))
            columns = [
                batch.column(0).take(pa.array(docs_of, pa.int64())),
                pa.array(pieces, pa.int32()),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(sums, pa.int64()),
            ]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, fields)
        known.rest()

    shape = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(id_column, text_column).mapInArrow(run, shape)


class RoomTree:
    """A segment tree over rooms 0 .. capacity that finds the least room with an open bin in log time."""

    def __init__(self, capacity: int):
        self.base = 1 << capacity.bit_length()
        self.open = bytearray(2 * self.base)

    def put(self, room: int, is_open: bool) -> None:
        node = room + self.base
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, room: int) -> int | None:
        """The least open room that is `room` or more."""
        node = room + self.base
        if self.open[node]:
            return room
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.base:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.base
            node //= 2
        return None


def best_fit_decreasing(lengths: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Places `lengths` (length -> count) as best-fit decreasing would, one document after another.

    Documents of one length are alike, and so are open bins of one room: where the tightest bin takes k
    documents of a length, so do all bins of that room, one after the other. One step places the
    documents that a whole row of such bins takes; the number of steps depends on the number of
    different lengths, not on the number of documents.

    Returns steps (length, first, after, per_bin, bin, offset): the documents of that length with ranks
    first .. after - 1 go to bins bin, bin + 1, ..., per_bin in each, from `offset` on.
    """
    tree, rooms, steps, bins = RoomTree(capacity), {}, [], 0

    def put(room: int, start: int, count: int) -> None:
        if room:
            rooms.setdefault(room, []).append((start, count))
            tree.put(room, True)

    for length in sorted(lengths, reverse=True):
        done, count = 0, lengths[length]
        while done < count:
            room = tree.tightest(length)
            if room is None:
                need = -(-(count - done) // (capacity // length))
                put(capacity, bins, need)
                bins, room = bins + need, capacity
            start, n = rooms[room].pop()
            if not rooms[room]:
                tree.put(room, False)
            k = room // length
            full = min(n, (count - done) // k)
            if full:
                steps.append((length, done, done + full * k, k, start, capacity - room))
                put(room - k * length, start, full)
                done, start, n = done + full * k, start + full, n - full
            if n and done < count:
                rest = min(k, count - done)
                steps.append((length, done, done + rest, rest, start, capacity - room))
                put(room - rest * length, start, 1)
                done, start, n = done + rest, start + 1, n - 1
            if n:
                put(room, start, n)
    return steps


def packed(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, length, ...), `length` at most `capacity`.

    Only the count of each length reaches the driver, `capacity` numbers at most; the steps that come
    back are joined to the pieces by length and rank. Ranks are cut into slices, so that a length shared
    by a third of all pieces is spread. Null and repeated ids are pieces like others. Empty input gives
    no rows.
    """
    spark = pieces.sparkSession
    counts = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
    steps = best_fit_decreasing(counts, capacity)
    shape = "_length long, _first long, _after long, _per_bin long, _bin long, _offset long"
    plan = spark.createDataFrame(steps, shape)
    totals = spark.createDataFrame(list(counts.items()), "length long, _rows long")
    rows = pieces.withColumn("_order", seeded(5, "doc_id", "piece")).join(F.broadcast(totals), "length")
    position = F.col("_order") / float(1 << 52)
    order = ["_order", "doc_id", "piece"]
    ranked = cumulated(rows, ["length"], position, order, F.col("_rows"), out="_rank")
    rank = F.col("_rank") - 1
    inside = rank - F.col("_first")
    here = (F.col("length") == F.col("_length")) & (rank >= F.col("_first")) & (rank < F.col("_after"))
    # totals and steps are bounded by the number of lengths, not by the data
    return (
        ranked.join(F.broadcast(plan), here)
        .withColumn("sequence_id", F.col("_bin") + F.floor(inside / F.col("_per_bin")))
        .withColumn("offset", F.col("_offset") + (inside % F.col("_per_bin")) * F.col("length"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def packed_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Pieces of all documents with their places; the table of pieces (without ids) is written once."""
    return packed(stored(token_pieces(docs, tokenizer_path, capacity, end_id), "pieces"), capacity)
