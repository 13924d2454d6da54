"""Removal of repeated byte strings by matching statistics against run-length indexes.

Every window (100 bytes) has an anchor: the gram with the smallest hash inside it. Equal windows have
equal anchors at equal offsets, so neighbouring windows with one anchor travel together as a segment,
and only segments of one anchor need be compared. Documents are dealt into chunks; a round sends
messages from chunks to blocks of a hash space and answers back, so a task holds a chunk or a block:

1. chunks count their anchors into a sparse count-min sketch; a block of cells adds the parts up and
   answers which anchors may occur twice, and which are hot. A hot anchor's segments are cut once more,
   a few window places at a time, and go by a hash of the bytes those windows share, so that no block
   has to hold all that lies around a common passage;
2. each distinct segment of such anchors goes to the block of its anchor, where segments of one anchor
   form a class in the order of their first places. In rounds over the bits of that order the earlier
   halves are put into a run-length index and the later ones streamed against it; a window whose
   matching statistic is a whole window starts earlier. The chunks learn the windows that lose;
3. each chunk removes the bytes those windows cover.
"""

from __future__ import annotations

import hashlib
import zlib
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from meteospark.llm.hashing import decode_sorted, encode_sorted, members
from meteospark.llm.run_index import MOST, RunIndex
from meteospark.llm.substring_dedup import (
    _MESSAGE,
    BLOCK_BITS,
    CHUNK_BYTES,
    EXACT_BYTES,
    _blocks,
    _messages,
    _raw,
    _runs,
    dealt_chunks,
    expanded,
)

#: Bytes of a gram, texts hashed at once, bytes of one index.
GRAM, SLICE, INDEX_BYTES = 32, 1 << 18, 1 << 18
#: Occurrences (counted once for each chunk and place) that make an anchor hot; places a cut keeps together.
HOT, HOT_PLACES = 4_096, 4
_A, _B, _C, _D = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))
_ROWS = (_C, _D)
_HIGH = np.uint64(0xFFFFFFFF00000000)


def _grams(data: bytes, n: int) -> np.ndarray:
    """64-bit hashes of the GRAM bytes from each of n places; data goes on for 64 bytes at least."""
    eight = np.ndarray((n + GRAM - 8,), "<u8", data, strides=(1,)) * _A
    eight ^= eight >> np.uint64(29)
    h = eight[:n] * _B
    h += eight[8 : n + 8] * _C
    h += eight[16 : n + 16] * _D
    h += eight[24 : n + 24] * _A + _D
    h ^= h >> np.uint64(32)
    h *= _B
    h ^= h >> np.uint64(29)
    return h | np.uint64(1)  # never 0, which stands for none


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def segments(texts: list[bytes], window: int):
    """Segments of all texts: text, first byte, number of windows, anchor's byte (in the text), anchor hash."""
    parts = []
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= SLICE or i + 1 == len(texts):
            parts.append(_slice_segments(texts[first : i + 1], first, window))
            first, size = i + 1, 0
    if not parts:
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)]
    return [np.concatenate(p) for p in zip(*parts)]


def _slice_segments(texts: list[bytes], shift: int, window: int):
    data = b"".join(texts) + b"\xff" * (window + 64)
    n = len(data) - window - 64
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    edge = np.zeros(n + 1, np.int32)
    long = sizes >= window
    np.add.at(edge, starts[long], 1)
    np.add.at(edge, ends[long] - window + 1, -1)
    places = np.flatnonzero(np.cumsum(edge[:n]) > 0)
    if not len(places):
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)]
    hashes = _grams(data, n + window)
    keyed = (hashes & _HIGH) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (_least(keyed, window - GRAM + 1)[places] & ~_HIGH).astype(np.int64)
    new = np.ones(len(places), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (places[1:] != places[:-1] + 1)
    at = np.flatnonzero(new)
    first, anchor = places[at], anchor[at]
    owner = np.searchsorted(ends, first, "right")
    # places[at] may follow an empty text of the same end; searchsorted from the right skips those
    return [owner + shift, first - starts[owner], np.diff(at, append=len(places)), anchor - starts[owner], hashes[anchor]]


def _cells(anchors: np.ndarray, row: int, bits: int):
    """Sorted cells of one sketch row and how often each is touched."""
    cells = np.sort((anchors * _ROWS[row]) >> np.uint64(64 - bits))
    at = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if len(cells) else np.zeros(0, np.int64)
    return cells[at], np.diff(at, append=len(cells))


def _send_sketch(window: int, bits: int):
    per_row = (1 << bits) >> BLOCK_BITS

    def run(table: pa.Table) -> pa.Table:
        anchors = segments(_raw(table)[0], window)[4]
        rows, chunk = [], table["chunk"][0].as_py()
        for row in range(len(_ROWS)):
            cells, counts = _cells(anchors, row, bits)
            for block, part in _blocks(cells):
                inside = (cells[part] & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
                several = counts[part] > 1
                more = np.minimum(counts[part][several], 0xFFFF).astype(np.uint16)
                payload = np.int64(len(more)).tobytes() + more.tobytes() + encode_sorted(2 * inside + several)
                rows.append((chunk, row * per_row + block, payload))
        return _messages(rows)

    return run


def _read_cells(payload: bytes):
    n = int(np.frombuffer(payload, np.int64, 1)[0])
    coded = decode_sorted(payload[8 + 2 * n :])
    counts = np.ones(len(coded), np.int64)
    counts[(coded & 1).astype(bool)] = np.frombuffer(payload, np.uint16, n, 8)
    return coded >> 1, counts


def _merge_sketch(table: pa.Table, hot: int) -> pa.Table:
    """Adds up the parts of one block; answers for each chunk's cells: two or more, and hot."""
    total = np.zeros(1 << BLOCK_BITS, np.uint16)
    payloads = [p.as_py() for p in table["payload"]]
    for p in payloads:
        cells, counts = _read_cells(p)
        total[cells] = np.minimum(total[cells] + counts, hot)
    block, rows = table["block"][0].as_py(), []
    for chunk, p in zip(table["chunk"].to_pylist(), payloads):
        found = total[_read_cells(p)[0]]
        if (found > 1).any():
            rows.append((chunk, block, np.packbits([found > 1, found >= hot]).tobytes()))
    return _messages(rows)


def _marked(anchors: np.ndarray, masks: dict[int, bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Which anchors may occur twice, and which are hot, by every row of the sketch."""
    per_row = (1 << bits) >> BLOCK_BITS
    twice, hot = np.ones(len(anchors), bool), np.ones(len(anchors), bool)
    for row in range(len(_ROWS)):
        cells, _ = _cells(anchors, row, bits)
        reached, heated = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for block, part in _blocks(cells):
            mask = masks.get(row * per_row + block)
            if mask:
                found = cells[part]
                two, many = np.unpackbits(np.frombuffer(mask, np.uint8), count=2 * len(found)).astype(bool).reshape(2, -1)
                reached.append(found[two])
                heated.append(found[many])
        cell = (anchors * _ROWS[row]) >> np.uint64(64 - bits)
        twice &= members(cell, np.concatenate(reached))
        hot &= members(cell, np.concatenate(heated))
    return twice, hot


def _name(item: bytes) -> int:
    return int.from_bytes(blake2b(item, digest_size=8).digest(), "little")


def _items(text: bytes, first: int, windows: int, anchor: int, key: int, hot: bool, window: int):
    """(class key, bytes, first byte, windows) of what a segment is compared by.

    A hot segment is cut into groups of HOT_PLACES offsets of the anchor in the window; all windows of a
    group hold the same bytes around the anchor, whose hash is their class.
    """
    if not hot:
        yield key, text[first : first + windows + window - 1], first, windows
        return
    place = first
    while place < first + windows:
        group = (anchor - place) // HOT_PLACES
        after = min(first + windows, anchor - group * HOT_PLACES + 1)
        core = text[anchor - group * HOT_PLACES : anchor - group * HOT_PLACES + window - HOT_PLACES + 1]
        yield _name(b"\xff%d\xff" % group + core), text[place : after + window - 1], place, after - place
        place = after


def _send_segments(window: int, bits: int, exact_bits: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(docs) or not len(answers):
            return _messages([])
        texts, ids = _raw(docs)
        owner, first, windows, anchor, hashes = segments(texts, window)
        masks = dict(zip(answers["block"].to_pylist(), answers["payload"].to_pylist()))
        twice, hot = _marked(hashes, masks, bits)
        at = np.flatnonzero(twice)
        chosen: dict[tuple[int, bytes], list] = {}
        columns = (owner[at], first[at], windows[at], anchor[at], hashes[at], hot[at])
        for o, f, w, a, h, is_hot in zip(*(c.tolist() for c in columns)):
            doc = int(ids[o])
            for key, item, place, n in _items(texts[o], f, w, a, h, is_hot, window):
                known = chosen.get((key, item))
                if known is None:
                    chosen[key, item] = [doc, a, a - place, n, False, h if is_hot else 0]
                else:
                    known[4] = True
                    if (doc, a) < (known[0], known[1]):
                        known[0], known[1] = doc, a
        if not chosen:
            return _messages([])
        keys = np.array([k for k, _ in chosen], np.uint64)
        items = [s for _, s in chosen]
        rest = list(chosen.values())
        # anchors are the smallest hashes around, so their high bits are mixed first
        block_of = ((keys * _B) >> np.uint64(64 - exact_bits)).astype(np.int64)
        order = np.argsort(block_of, kind="stable")
        rows, chunk = [], docs["chunk"][0].as_py()
        for block, part in _runs(block_of[order]):
            pick = order[part].tolist()
            rows.append((chunk, block, _pack(keys[order[part]], [items[i] for i in pick], [rest[i] for i in pick])))
        return _messages(rows)

    return run


def _pack(keys: np.ndarray, items: list[bytes], rest: list[list]) -> bytes:
    column = lambda i, kind: np.array([r[i] for r in rest], kind).tobytes()
    body = b"".join(
        [
            keys.tobytes(),
            column(0, np.int64),
            column(1, np.int64),
            column(5, np.uint64),
            np.array([len(s) for s in items], np.int32).tobytes(),
            column(2, np.int32),
            column(3, np.int32),
            column(4, np.uint8),
            b"".join(items),
        ]
    )
    return np.int64(len(items)).tobytes() + zlib.compress(body, 1)


def _unpack(payload: bytes):
    n = int(np.frombuffer(payload, np.int64, 1)[0])
    body, at, out = zlib.decompress(payload[8:]), 0, []
    for kind in (np.uint64, np.int64, np.int64, np.uint64, np.int32, np.int32, np.int32, np.uint8):
        out.append(np.frombuffer(body, kind, n, at))
        at += n * out[-1].itemsize
    ends = (np.cumsum(out[4]) + at).tolist()
    items = [body[b:e] for b, e in zip([at, *ends[:-1]], ends)]
    return items, out


def _compare(table: pa.Table, window: int) -> pa.Table:
    """Finds in each class the windows that start earlier and answers the chunks."""
    entries: dict[tuple[int, bytes], int] = {}
    doc, place, offset, windows = [], [], [], []
    sent = []
    for chunk, p in zip(table["chunk"].to_pylist(), table["payload"]):
        items, (keys, docs, places, anchors, _, offsets, counts, several) = _unpack(p.as_py())
        found = []
        for key, item, d, a, o, n in zip(keys.tolist(), items, docs.tolist(), places.tolist(), offsets.tolist(), counts.tolist()):
            e = entries.setdefault((key, item), len(entries))
            if e == len(doc):
                doc.append(d)
                place.append(a)
                offset.append(o)
                windows.append(n)
            elif (d, a) < (doc[e], place[e]):
                doc[e], place[e] = d, a
            found.append(e)
        sent.append((chunk, np.array(found), keys, docs, places, anchors, several.astype(bool)))
    doc, place = np.array(doc), np.array(place)
    lost = _lost_windows(list(entries), doc, place, np.array(windows), window)
    some = lost.any(axis=1)
    rows, block = [], table["block"][0].as_py()
    names = np.fromiter((_name(b"%d" % key + item) for key, item in entries), np.uint64, len(entries))
    packed = np.packbits(lost, axis=1)
    for chunk, found, keys, docs, places, anchors, several in sent:
        later = (docs > doc[found]) | ((docs == doc[found]) & (places > place[found]))
        own = ~later & (several | some[found])
        if later.any() or own.any():
            hot = anchors[(later | own) & (anchors != 0)]
            plain = np.unique(np.concatenate([keys[(later | own) & (anchors == 0)], hot]))
            e = found[own]
            parts = [plain, np.unique(hot), names[found[later]], names[e], doc[e], place[e], packed[e]]
            head = np.array([len(x) for x in parts] + [packed.shape[1]], np.int64)
            rows.append((chunk, block, zlib.compress(b"".join(x.tobytes() for x in (head, *parts)), 1)))
    return _messages(rows)


def _lost_windows(entries, doc, place, windows, window: int) -> np.ndarray:
    """For every entry (key, bytes) which of its windows occur in an entry of its class that comes earlier."""
    lost = np.zeros((len(entries), max(8, int(windows.max()))), bool)
    keys = np.array([k for k, _ in entries], np.uint64)
    order = np.lexsort((place, doc, keys))
    keys, doc, place = keys[order], doc[order], place[order]
    new_class = np.ones(len(keys), bool)
    new_class[1:] = keys[1:] != keys[:-1]
    new_place = new_class.copy()
    new_place[1:] |= (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])
    class_of = np.cumsum(new_class) - 1
    step = np.cumsum(new_place)
    rank = step - step[np.flatnonzero(new_class)][class_of]  # entries of one place have one rank
    for bit in range(int(rank.max()).bit_length()):
        later = (rank >> bit) & 1 == 1
        group = class_of * (int(rank.max()) + 1) + (rank >> (bit + 1))
        both = np.intersect1d(group[later], group[~later])
        mine = np.flatnonzero(np.isin(group, both))
        for queried, indexed in _batches(mine, group, later, order, entries):
            _stream(queried, indexed, group, order, entries, lost, windows, window)
    return lost


def _batches(mine, group, later, order, entries):
    """Lists of (streamed, indexed) entries; an index has INDEX_BYTES at most, or one string."""
    queried, indexed, size = [], [], 0
    cuts = np.flatnonzero(np.concatenate([[True], group[mine][1:] != group[mine][:-1]])) if len(mine) else []
    # entries of a group lie together, as they are sorted by class and rank
    for a, b in zip(cuts, [*cuts[1:], len(mine)]):
        members_of = mine[a:b]
        stream, waiting = members_of[later[members_of]].tolist(), True
        for i in members_of[~later[members_of]].tolist():
            length = len(entries[order[i]][1]) + 1
            if size + length > min(INDEX_BYTES, MOST) and indexed:
                yield queried, indexed
                queried, indexed, size, waiting = [], [], 0, True
            if waiting:  # a group's strings are streamed against each index that holds some of it
                queried.extend(stream)
                waiting = False
            indexed.append(i)
            size += length
    if indexed:
        yield queried, indexed


def _stream(queried, indexed, group, order, entries, lost, windows, window) -> None:
    names, dense = np.unique(group[indexed], return_inverse=True)
    index = RunIndex([entries[order[i]][1] for i in indexed], dense)
    at = np.searchsorted(names, group[queried])
    for lo in range(0, len(queried), 1 << 14):
        part = queried[lo : lo + (1 << 14)]
        strings = [entries[order[i]][1] for i in part]
        lengths = index.matching_statistics(strings, at[lo : lo + (1 << 14)])
        full, width = lengths >= window, lengths.shape[1]
        for row, i in enumerate(part):
            e = order[i]
            n, begin = windows[e], width - len(strings[row])
            lost[e, :n] |= full[row, begin : begin + n]


def _remove(window: int, with_bytes: bool, fields: pa.Schema):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(docs):
            return fields.empty_table()
        texts, ids = _raw(docs)
        sizes = np.array([len(t) for t in texts])
        starts = np.cumsum(sizes) - sizes
        edge = np.zeros(int(sizes.sum()) + 1, np.int32)
        for o, place, n, mask in _losers(texts, ids, answers, window):
            begin = starts[o] + place
            if mask is None:
                edge[begin] += 1
                edge[begin + n + window - 1] -= 1
            else:
                at = begin + np.flatnonzero(mask[:n])
                np.add.at(edge, at, 1)
                np.add.at(edge, at + window, -1)
        gone = np.cumsum(edge[:-1]) > 0
        removed, spans, digests, kept = [], [], [], []
        for text, at, size in zip(texts, starts.tolist(), sizes.tolist()):
            mask = gone[at : at + size]
            n = int(mask.sum())
            if n:
                spans.append(int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()))
                text = np.frombuffer(text, np.uint8)[~mask].tobytes()
            else:
                spans.append(0)
            removed.append(n)
            digests.append(hashlib.sha256(text).hexdigest())
            if with_bytes:
                kept.append(text)
        columns = [docs["id"].combine_chunks()] + [pa.array(x, pa.int64()) for x in (sizes, removed, spans)] + [pa.array(digests)]
        columns += [pa.array(kept, pa.binary())] * with_bytes + [docs["copies"].combine_chunks()]
        return pa.Table.from_arrays(columns, schema=fields)

    return run


def _losers(texts, ids, answers: pa.Table, window: int):
    """(text, first byte, windows, mask) of what loses windows; mask None: all of them."""
    plain, hots, all_lost, some = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], set(), {}
    for p in answers["payload"]:
        body = zlib.decompress(p.as_py())
        *lengths, width = np.frombuffer(body, np.int64, 8).tolist()
        at, parts = 64, []
        for length, kind in zip(lengths, (np.uint64,) * 4 + (np.int64,) * 2):
            parts.append(np.frombuffer(body, kind, length, at))
            at += 8 * length
        masks = np.unpackbits(np.frombuffer(body, np.uint8, lengths[6] * width, at).reshape(-1, max(width, 1)), axis=1)
        plain.append(parts[0])
        hots.append(parts[1])
        all_lost.update(parts[2].tolist())
        for name, d, a, mask in zip(parts[3].tolist(), parts[4].tolist(), parts[5].tolist(), masks):
            some[name] = (d, a, mask)
    if not all_lost and not some:
        return
    owner, first, windows, anchor, hashes = segments(texts, window)
    at = np.flatnonzero(members(hashes, np.unique(np.concatenate(plain))))
    hot = members(hashes[at], np.unique(np.concatenate(hots)))
    columns = (owner[at], first[at], windows[at], anchor[at], hashes[at], hot)
    for o, f, w, a, h, is_hot in zip(*(c.tolist() for c in columns)):
        for key, item, place, n in _items(texts[o], f, w, a, h, is_hot, window):
            name = _name(b"%d" % key + item)
            if name in all_lost:
                yield o, place, n, None
            elif name in some:
                d, first_place, mask = some[name]
                yield o, place, n, None if (int(ids[o]), a) > (d, first_place) else mask


def remove_repeated_bytes(
    docs: DataFrame,
    window: int = 100,
    with_bytes: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    hot: int = HOT,
) -> DataFrame:
    """Removes each byte covered by a `window`-byte string that also starts earlier.

    Earlier is a smaller id, or a smaller place in the same document; strings may overlap, never cross
    documents, and are judged on the input. Returns doc_id, n_bytes, n_removed, n_spans (maximal removed
    runs), kept_sha256 and, if asked for, kept (the remaining bytes, which need not be valid text).

    A null text is empty; texts shorter than a window lose nothing. A null id counts as larger than all
    others; rows of one id are ordered by place alone, and equal places don't remove each other. Empty
    tables give no rows; other columns aren't read. A very long text is one row of one chunk.
    chunk_bytes and hot (at most 65,535) set sizes, not results.
    """
    if window < GRAM + 2 * HOT_PLACES:
        raise ValueError(f"a window has {GRAM + 2 * HOT_PLACES} bytes or more")
    chunked, size = dealt_chunks(docs, id_column, text_column, chunk_bytes)
    bits = max(BLOCK_BITS, int(max(size, 1)).bit_length() - 2)  # eight cells or so for each anchor
    exact_bits = int(max(size // EXACT_BYTES, 1)).bit_length()  # 1 or more
    by_chunk = chunked.groupBy("chunk")
    sent = by_chunk.applyInArrow(_send_sketch(window, bits), _MESSAGE)
    reached = sent.groupBy("block").applyInArrow(lambda table: _merge_sketch(table, hot), _MESSAGE)
    asked = by_chunk.cogroup(reached.groupBy("chunk")).applyInArrow(
        _send_segments(window, bits, exact_bits), _MESSAGE
    )
    lost = asked.groupBy("block").applyInArrow(lambda table: _compare(table, window), _MESSAGE)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_bytes + ["copies"]
    kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * with_bytes + [pa.int64()]
    fields = pa.schema(list(zip(names, kinds)))
    shape = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes + ", copies long"
    return expanded(by_chunk.cogroup(lost.groupBy("chunk")).applyInArrow(_remove(window, with_bytes, fields), shape))
