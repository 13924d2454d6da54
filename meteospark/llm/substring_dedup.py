"""Removal of repeated word windows behind a count-min prefilter.

Documents are dealt into chunks, which every round meets again. A round sends messages from chunks to
blocks of a hash space and answers from the blocks back to the chunks that asked, so no task holds more
than a chunk or a block and nothing is broadcast:

1. each chunk counts its windows into a sparse count-min sketch and sends each block of cells its part;
   a block adds the parts up and answers, for the cells a chunk touched, which ones reach two;
2. windows whose every cell reaches two may be repeated; only they are grouped exactly, by 96 bits of
   hash, to find the smallest document they start in; a chunk learns which of its windows lose;
3. each chunk removes the words those windows cover.

Sketches never count too low, so no repeated window is lost; what they let through by mistake falls out
of the second round.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteospark.llm.common import stored
from meteospark.llm.hashing import decode_sorted, encode_sorted, members, word_windows

#: Bytes of text in a chunk, about, and cells of a sketch block, both for up to a terabyte; bytes of text a block of exact counts serves.
CHUNK_BYTES, BLOCK_BITS, EXACT_BYTES = 8 << 20, 24, 16 << 20
#: What a row counts for besides its text, and the most kinds of equal rows that are folded.
ROW_BYTES, LARGE_ROWS = 64, 1 << 16
_SEEDS = (0x51ED270B, 0xC2B2AE3D)
#: One odd multiplier for each row of the sketch.
_ROWS = tuple(np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
_MESSAGE = "chunk long, block long, payload binary"
_LAST = np.iinfo(np.int64).max
_SPACES = bytes.maketrans(b"\t\n\r\x0b\x0c", b"     ")


def _raw(table: pa.Table) -> tuple[list[bytes], np.ndarray]:
    """Texts as bytes and ids, where a null id comes after all others."""
    texts = [t or b"" for t in table["text"].cast(pa.binary()).to_pylist()]
    ids = table["id"].fill_null(_LAST).to_numpy()
    return texts, ids


def _messages(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    chunk, block, payload = zip(*rows) if rows else ((), (), ())
    return pa.table(
        [pa.array(chunk, pa.int64()), pa.array(block, pa.int64()), pa.array(payload, pa.binary())],
        names=["chunk", "block", "payload"],
    )


def _cells(windows: np.ndarray, owners: np.ndarray, row: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A chunk's cells of one sketch row, sorted, each with whether two of its documents touch it.

    Cell and document are sorted as one number where both fit into 64 bits, else by two keys.
    """
    cell = (windows * _ROWS[row]) >> np.uint64(64 - bits)
    if not len(cell):
        return cell, np.zeros(0, bool)
    width = int(owners.max()).bit_length()
    if bits + width <= 64:
        shift = np.uint64(width)
        pairs = np.sort((cell << shift) | owners.astype(np.uint64))
        cells, new = pairs >> shift, pairs[1:] != pairs[:-1]
    else:
        order = np.lexsort((owners, cell))
        cells, docs = cell[order], owners[order]
        new = (cells[1:] != cells[:-1]) | (docs[1:] != docs[:-1])
    cells = cells[np.concatenate([[True], new])]
    at = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
    return cells[at], np.diff(at, append=len(cells)) > 1


def _runs(blocks: np.ndarray) -> list[tuple[int, slice]]:
    """The blocks in sorted numbers of blocks, and where each lies; blocks that aren't there cost nothing."""
    if not len(blocks):
        return []
    at = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]]))
    ends = [*at[1:].tolist(), len(blocks)]
    return [(b, slice(lo, hi)) for b, lo, hi in zip(blocks[at].tolist(), at.tolist(), ends)]


def _blocks(cells: np.ndarray, block_bits: int = BLOCK_BITS) -> list[tuple[int, slice]]:
    """The blocks that sorted cells fall into, and where."""
    return _runs(cells >> np.uint64(block_bits))


def _send_sketch(window: int, bits: int, block_bits: int):
    per_row = (1 << bits) >> block_bits

    def run(table: pa.Table) -> pa.Table:
        texts, _ = _raw(table)
        (hashes,), owners, _ = word_windows(texts, window, _SEEDS[:1])
        rows, chunk = [], table["chunk"][0].as_py()
        for row in range(len(_ROWS)):
            cells, several = _cells(hashes, owners, row, bits)
            inside = (cells & np.uint64((1 << block_bits) - 1)).astype(np.int64)
            for block, part in _blocks(cells, block_bits):
                rows.append((chunk, row * per_row + block, encode_sorted(2 * inside[part] + several[part])))
        return _messages(rows)

    return run


def _merge_sketch(block_bits: int):
    """Adds up the parts of one block (counts stop at two) and answers each chunk."""

    def run(table: pa.Table) -> pa.Table:
        counts = np.zeros(1 << block_bits, np.uint8)
        payloads = table["payload"]
        for p in payloads:
            coded = decode_sorted(p.as_py())
            cells = coded >> 1
            counts[cells] = np.minimum(counts[cells] + 1 + (coded & 1), 2)
        block = table["block"][0].as_py()
        rows = []
        for chunk, p in zip(table["chunk"].to_pylist(), payloads):
            reached = counts[decode_sorted(p.as_py()) >> 1] >= 2
            if reached.any():
                rows.append((chunk, block, np.packbits(reached).tobytes()))
        return _messages(rows)

    return run


def _send_candidates(window: int, bits: int, exact_bits: int, block_bits: int):
    per_row = (1 << bits) >> block_bits

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(docs) or not len(answers):
            return _messages([])
        texts, ids = _raw(docs)
        (one, two), owners, _ = word_windows(texts, window, _SEEDS)
        masks = dict(zip(answers["block"].to_pylist(), answers["payload"].to_pylist()))
        maybe = np.ones(len(one), bool)
        for row in range(len(_ROWS)):
            cells, _ = _cells(one, owners, row, bits)
            reached = []
            for block, part in _blocks(cells, block_bits):
                mask = masks.get(row * per_row + block)
                if mask:
                    found = cells[part]
                    reached.append(found[np.unpackbits(np.frombuffer(mask, np.uint8), count=len(found)).astype(bool)])
            reached = np.concatenate(reached) if reached else np.zeros(0, np.uint64)
            maybe &= members((one * _ROWS[row]) >> np.uint64(64 - bits), reached)
        one, two, docs_of = one[maybe], (two[maybe] >> np.uint64(32)).astype(np.uint32), ids[owners[maybe]]
        order = np.lexsort((docs_of, two, one))
        one, two, docs_of = one[order], two[order], docs_of[order]
        first = np.ones(len(one), bool)
        first[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        at = np.flatnonzero(first)
        least = docs_of[at]
        most = docs_of[np.concatenate([at[1:], [len(one)]]) - 1] if len(at) else least
        rows, chunk = [], docs["chunk"][0].as_py()
        one, two, several = one[at], two[at], most > least
        block_of = (one >> np.uint64(64 - exact_bits)).astype(np.int64) if exact_bits else np.zeros(len(one), np.int64)
        for block, part in _runs(block_of):
            rows.append((chunk, block, _pack(one[part], two[part], least[part], several[part])))
        return _messages(rows)

    return run


def _pack(one, two, least, several) -> bytes:
    kinds, place = np.unique(least, return_inverse=True)
    place = place.astype(np.uint16 if len(kinds) < 1 << 16 else np.uint32)
    head = np.array([len(one), len(kinds)], np.int64)
    return b"".join(x.tobytes() for x in (head, one, kinds, two, place, np.packbits(several)))


def _unpack(data: bytes):
    n, k = np.frombuffer(data, np.int64, 2)
    at = 16
    one = np.frombuffer(data, np.uint64, n, at)
    at += 8 * n
    kinds = np.frombuffer(data, np.int64, k, at)
    at += 8 * k
    two = np.frombuffer(data, np.uint32, n, at)
    at += 4 * n
    kind = np.uint16 if k < 1 << 16 else np.uint32
    place = np.frombuffer(data, kind, n, at)
    at += place.itemsize * n
    several = np.unpackbits(np.frombuffer(data, np.uint8, -1, at), count=n).astype(bool)
    return one, two, kinds[place], several


def _group_exactly(table: pa.Table) -> pa.Table:
    """Finds each window's smallest document and answers a chunk with the windows that lose there.

    Windows whose smallest document lies in another chunk lose everywhere in the chunk; for those that
    start in several of the chunk's documents and nowhere earlier, the smallest goes along.
    """
    parts = [_unpack(p.as_py()) for p in table["payload"]]
    sizes = [len(p[0]) for p in parts]
    one, two, least, several = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((two, one))
    first = np.ones(len(one), bool)
    first[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    at = np.flatnonzero(first)
    smallest = np.empty(len(one), np.int64)
    smallest[order] = np.repeat(np.minimum.reduceat(least[order], at), np.diff(at, append=len(one)))
    lost = smallest < least
    rows, lo = [], 0
    block = table["block"][0].as_py()
    for chunk, n in zip(table["chunk"].to_pylist(), sizes):
        part = slice(lo, lo + n)
        lo += n
        gone, some = one[part][lost[part]], several[part] & ~lost[part]
        if len(gone) or some.any():
            head = np.array([len(gone)], np.int64)
            payload = b"".join(x.tobytes() for x in (head, gone, one[part][some], least[part][some]))
            rows.append((chunk, block, payload))
    return _messages(rows)


def _remove(window: int, with_text: bool, fields: pa.Schema):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(docs):
            return fields.empty_table()
        texts, ids = _raw(docs)
        (hashes,), owners, counts = word_windows(texts, window, _SEEDS[:1])
        gone, some, least = [], [], []
        for p in answers["payload"]:
            data = p.as_py()
            n = int(np.frombuffer(data, np.int64, 1)[0])
            gone.append(np.frombuffer(data, np.uint64, n, 8))
            rest = np.frombuffer(data, np.uint64, -1, 8 + 8 * n)
            some.append(rest[: len(rest) // 2])
            least.append(rest[len(rest) // 2 :].view(np.int64))
        lost = np.zeros(len(hashes), bool)
        if gone:
            lost = members(hashes, np.sort(np.concatenate(gone)))
            some, least = np.concatenate(some), np.concatenate(least)
            order = np.argsort(some)
            some, least = some[order], least[order]
            at = np.flatnonzero(members(hashes, some))
            if len(at):
                lost[at] |= ids[owners[at]] > least[np.searchsorted(some, hashes[at])]
        windows = np.maximum(counts - window + 1, 0)
        begin = np.cumsum(windows) - windows
        hit = np.zeros(len(texts), bool)
        hit[owners[lost]] = True
        removed, digests, kept_texts = [], [], []
        for i, text in enumerate(texts):
            if hit[i]:
                words = text.split()
                starts = np.flatnonzero(lost[begin[i] : begin[i] + windows[i]])
                edges = np.zeros(len(words) + 1, np.int32)
                np.add.at(edges, starts, 1)
                np.add.at(edges, starts + window, -1)
                keep = np.cumsum(edges[:-1]) == 0
                removed.append(len(words) - int(keep.sum()))
                kept = b" ".join(compress(words, keep.tolist()))
            else:
                removed.append(0)
                kept = text.translate(_SPACES).strip()
                if b"  " in kept:
                    kept = b" ".join(kept.split())
            digests.append(hashlib.sha256(kept).hexdigest())
            if with_text:
                kept_texts.append(kept.decode())
        columns = [docs["id"].combine_chunks(), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests)]
        columns += [pa.array(kept_texts)] * with_text + [docs["copies"].combine_chunks()]
        return pa.Table.from_arrays(columns, schema=fields)

    return run


def sized_chunks(size: int) -> tuple[int, int]:
    """(bytes of a chunk, bits of a sketch block) for a corpus of `size` bytes.

    Both grow with the corpus, eightfold at most, so that a message from a chunk to a block carries cells
    enough to be worth its row: at 100 TB a task holds 64 MB of text, or 128 MB of counts.
    """
    grown = min(3, max(0, int(size).bit_length() - 40))
    return CHUNK_BYTES << grown, BLOCK_BITS + grown


def dealt_chunks(docs: DataFrame, id_column: str, text_column: str, chunk_bytes: int | None) -> tuple[DataFrame, int]:
    """chunk, id, text, copies: documents dealt into chunks of about chunk_bytes; and the bytes of all texts.

    Equal rows (of one id and text, null or not) go into one chunk, whatever their number, so those that
    would fill a part of it are folded into one row with their number; `expanded` unfolds them. Only
    64-bit hashes of rows are shuffled to find them, and there are few: each has a quarter of a chunk, or
    1 / LARGE_ROWS of the corpus.
    """
    slim = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    weight = F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES
    size, rows = slim.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    size = size or 0
    held = size + ROW_BYTES * rows
    chunk_bytes = chunk_bytes or sized_chunks(size)[0]
    key = F.xxhash64("id", "text")
    sums = slim.groupBy(key.alias("key")).agg(F.sum(weight).alias("held"), F.count("*").alias("rows"))
    large = sums.where((F.col("rows") > 1) & (F.col("held") > max(chunk_bytes // 4, held // LARGE_ROWS))).select("key")
    large = stored(large, "large_rows")
    rest = slim.withColumn("copies", F.lit(1).cast("long"))
    if large.limit(1).count():
        keyed, few = slim.withColumn("key", key), F.broadcast(large)
        folded = keyed.join(few, "key", "left_semi").groupBy("id", "text").agg(F.count("*").alias("copies"))
        rest = keyed.join(few, "key", "left_anti").select("id", "text", F.lit(1).cast("long").alias("copies")).unionAll(folded)
    chunk = F.pmod(F.xxhash64("id", "text"), F.lit(-(-held // chunk_bytes) + 1)).alias("chunk")
    return rest.select(chunk, "id", "text", "copies"), size


def expanded(result: DataFrame) -> DataFrame:
    """As many rows as there were documents."""
    names = [c for c in result.columns if c != "copies"]
    return result.select(*names, F.explode(F.expr("array_repeat(0, int(copies))")).alias("copies")).drop("copies")


def remove_repeated_windows(
    docs: DataFrame,
    window: int = 50,
    with_text: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk_bytes: int | None = None,
) -> DataFrame:
    """Removes each word covered by a window that also starts in a document with a smaller id.

    Windows are judged on the input. Returns doc_id, n_words, n_removed, kept_sha256 (of the kept words
    joined by one space) and, if asked for, text (those words).

    A null text has no words; texts shorter than a window lose nothing. A null id counts as larger than
    all others, and rows of one id never remove words of each other. Empty tables give no rows; other
    columns aren't read. A very long text is one row of one chunk. Sizes of chunks and blocks follow from
    the corpus; chunk_bytes sets that of chunks instead, never the result.
    """
    chunked, size = dealt_chunks(docs, id_column, text_column, chunk_bytes)
    block_bits = sized_chunks(size)[1]
    bits = max(block_bits, int(max(size, 1)).bit_length())  # six cells or more for each window
    exact_bits = int(max(size // EXACT_BYTES, 1)).bit_length() - 1
    by_chunk = chunked.groupBy("chunk")
    sent = by_chunk.applyInArrow(_send_sketch(window, bits, block_bits), _MESSAGE)
    reached = sent.groupBy("block").applyInArrow(_merge_sketch(block_bits), _MESSAGE)
    asked = by_chunk.cogroup(reached.groupBy("chunk")).applyInArrow(
        _send_candidates(window, bits, exact_bits, block_bits), _MESSAGE
    )
    lost = asked.groupBy("block").applyInArrow(_group_exactly, _MESSAGE)
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["text"] * with_text + ["copies"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.string()] * with_text + [pa.int64()]
    fields = pa.schema(list(zip(names, kinds)))
    shape = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", text string" * with_text + ", copies long"
    return expanded(by_chunk.cogroup(lost.groupBy("chunk")).applyInArrow(_remove(window, with_text, fields), shape))
