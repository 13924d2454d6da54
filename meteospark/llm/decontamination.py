"""Benchmark phrases in training text, found by an FM-index per shard.

`shard_indexes` builds one index for each shard of about SHARD_BYTES of whole documents, in the scan and
without a shuffle; a stored table of them answers any later test set. `find_phrases` walks the windows
of the test set backwards through every shard's index, locates what occurs and merges the spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteospark.llm.common import stored
from meteospark.llm.fm_index import Index
from meteospark.llm.tokens import Words, byte_map

#: Bytes of text in a shard, about; windows of the test set that one pass takes along.
SHARD_BYTES, PASS_WINDOWS = 8 << 20, 1 << 17
_SEED = 0x2545F491
#: Everything in ASCII but digits and letters parts words.
_MAP = byte_map(bytes(b for b in range(128) if not chr(b).isalnum()))
_INDEX = "shard string, ids array<long>, keys array<long>, text array<int>, n_words array<int>, index binary"
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_HITS = "shard string, at int, spans array<struct<start: long, end: long>>, items array<string>"


def _bytes(column: pa.Array) -> list[bytes]:
    return [(t or b"").translate(_MAP) for t in column.cast(pa.binary()).to_pylist()]


def _shard(name: str, ids: list, keys: list, texts: list[bytes]) -> pa.RecordBatch:
    """One index over the distinct texts; documents say which one is theirs."""
    number: dict[bytes, int] = {}
    text = [number.setdefault(t, len(number)) for t in texts]
    words = Words(list(number), _SEED)
    ends = np.cumsum(words.counts + 1) - 1
    is_end = np.zeros(len(words.hashes) + len(words.counts), bool)
    is_end[ends] = True
    hashes = np.zeros(len(is_end), np.uint64)
    hashes[~is_end] = words.hashes
    row = [[name], [ids], [keys], [text], [words.counts.tolist()], [Index.of(hashes, is_end).to_bytes()]]
    kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 2, pa.binary()]
    names = ["shard", "ids", "keys", "text", "n_words", "index"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], names)


def shard_indexes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """One row a shard: its documents (ids, 64-bit text keys, text numbers), words a text, and the index.

    Every text is in one shard as a whole; a text longer than a shard is a shard of its own. Equal texts
    of a shard are indexed once. Null texts count as empty, empty tables give no rows, other columns
    aren't read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, keys, texts, size, done = [], [], [], 0, 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            for i, k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _bytes(batch.column(2))):
                if texts and size + len(t) > shard_bytes:
                    yield _shard(f"{part}-{done}", ids, keys, texts)
                    ids, keys, texts, size, done = [], [], [], 0, done + 1
                ids.append(i)
                keys.append(k)
                texts.append(t)
                size += len(t)
        if texts:
            yield _shard(f"{part}-{done}", ids, keys, texts)

    slim = docs.select(F.col(id_column).cast("long"), F.xxhash64(text_column), F.col(text_column).cast("string"))
    return slim.mapInArrow(run, _INDEX)


def item_windows(items: DataFrame, size: int, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """item, window: the distinct windows of `size` words of each item, as hashes; shorter items are one window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(_bytes(batch.column(1)), _SEED)
            names, out, at = [], [], 0
            for item, n in zip(batch.column(0).to_pylist(), words.counts.tolist()):
                hashes = words.hashes[at : at + n].tobytes()
                at += n
                wide = 8 * min(size, n)
                found = {hashes[8 * k : 8 * k + wide] for k in range(n - min(size, n) + 1)} if n else ()
                names += [item] * len(found)
                out += found
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(out, pa.binary())], ["item", "window"])

    slim = items.select(F.col(id_column).cast("string"), F.col(text_column).cast("string"))
    return slim.mapInArrow(run, "item string, window binary").distinct()


class _Phrases:
    """Distinct windows of one pass as right-aligned rows of hashes, and the items of each."""

    def __init__(self, rows: list[tuple[str | None, bytes]], size: int):
        number: dict[bytes, int] = {}
        pairs = [(number.setdefault(bytes(w), len(number)), item) for item, w in rows]
        self.lengths = np.array([len(w) // 8 for w in number], np.int64)
        self.hashes = np.zeros((len(number), size), np.uint64)
        for row, w in zip(self.hashes, number):
            row[size - len(w) // 8 :] = np.frombuffer(w, np.uint64)
        self.items: list[list[str]] = [[] for _ in number]
        for k, item in pairs:
            if item is not None:
                self.items[k].append(item)


def _search(phrases: _Phrases, row: dict) -> pa.RecordBatch:
    """Spans and items of the documents of one shard in which a phrase occurs."""
    index, counts = Index.from_bytes(row["index"]), np.array(row["n_words"], np.int64)
    begin = np.cumsum(counts + 1) - counts - 1
    alive, low, high = index.search(phrases.hashes, phrases.lengths)
    times = high - low
    which = np.repeat(alive, times)
    rows = np.arange(len(which)) + np.repeat(low - (np.cumsum(times) - times), times)
    places = index.locate(rows)
    of = np.searchsorted(begin, places, "right") - 1
    spans: dict[int, list] = {}
    items: dict[int, list] = {}
    if len(places):
        order = np.argsort(places, kind="stable")
        start, end = places[order], (places + phrases.lengths[which])[order]
        reach = np.maximum.accumulate(end)
        first = np.concatenate([[True], (start[1:] > reach[:-1]) | (of[order][1:] != of[order][:-1])])
        at = np.flatnonzero(first)
        last = np.concatenate([at[1:], [len(start)]]) - 1
        text = of[order][at]
        for t, a, b in zip(text.tolist(), (start[at] - begin[text]).tolist(), (reach[last] - begin[text]).tolist()):
            spans.setdefault(t, []).append({"start": a, "end": b})
        for t, k in np.unique(np.stack([of, which], 1), axis=0).tolist():
            items.setdefault(t, []).extend(phrases.items[k])
    found = {t: sorted(set(items[t])) for t in spans}
    hit = [(at, t) for at, t in enumerate(row["text"]) if t in spans]
    columns = [
        pa.array([row["shard"]] * len(hit), pa.string()),
        pa.array([at for at, _ in hit], pa.int32()),
        pa.array([spans[t] for _, t in hit], pa.list_(_SPAN)),
        pa.array([found[t] for _, t in hit], pa.list_(pa.string())),
    ]
    return pa.RecordBatch.from_arrays(columns, ["shard", "at", "spans", "items"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unites overlapping and touching spans of a document that several passes have found."""
    for batch in batches:
        out = []
        for spans in batch.column("spans").to_pylist():
            union: list = []
            for s in sorted(spans, key=lambda s: s["start"]):
                if union and s["start"] <= union[-1]["end"]:
                    union[-1]["end"] = max(union[-1]["end"], s["end"])
                else:
                    union.append(s)
            out.append(union)
        columns = [batch.column("shard"), batch.column("at"), pa.array(out, pa.list_(_SPAN)), batch.column("items")]
        yield pa.RecordBatch.from_arrays(columns, ["shard", "at", "spans", "items"])


def find_phrases(
    indexes: DataFrame,
    items: DataFrame,
    size: int = 10,
    id_column: str = "item_id",
    text_column: str = "text",
    pass_windows: int = PASS_WINDOWS,
) -> DataFrame:
    """One row a document: doc_id, text_key, n_words, spans (word places, merged), items (ids as sorted strings).

    A window is `size` words in a row of an item, or the whole of a shorter item; words are runs of
    digits, letters and non-ASCII characters, in any case of A-Z. Items without words find nothing; an
    item without an id is searched but not named; items of one id count as one. Null and repeated
    document ids each keep their own row. The windows go through the shards in passes of at most
    `pass_windows`, which bounds what is broadcast; each pass reads the indexes once. Words are compared
    by 64-bit hashes.
    """
    windows = stored(item_windows(items, size, id_column, text_column), "windows")
    passes = max(1, -(-windows.count() // pass_windows))
    cut = windows.withColumn("pass", F.pmod(F.xxhash64("window", "item"), F.lit(passes)))
    parts = []
    for k in range(passes):
        rows = cut.where(F.col("pass") == k).select("item", "window").collect()  # about pass_windows
        phrases = indexes.sparkSession.sparkContext.broadcast(_Phrases([tuple(r) for r in rows], size))

        def run(batches: Iterator[pa.RecordBatch], phrases=phrases) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(len(batch)):
                    yield _search(phrases.value, {c: batch.column(c)[i].as_py() for c in batch.schema.names})

        hits = indexes.select("shard", "text", "n_words", "index").mapInArrow(run, _HITS)
        parts.append(stored(hits, f"hits_{k}"))
    hits = reduce(DataFrame.unionAll, parts)
    if passes > 1:
        lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "items")]
        hits = hits.groupBy("shard", "at").agg(*lists).mapInArrow(_merged, _HITS)
        hits = hits.withColumn("items", F.array_sort(F.array_distinct("items")))
    rows = F.posexplode(F.arrays_zip("ids", "keys", "text")).alias("at", "d")
    docs = indexes.select("shard", "n_words", rows)
    docs = docs.select("shard", "at", "d.ids", "d.keys", F.get("n_words", F.col("d.text")).cast("long").alias("n_words"))
    none = lambda kind: F.array().cast(kind)
    return docs.join(hits, ["shard", "at"], "left").select(
        F.col("ids").alias("doc_id"),
        F.col("keys").alias("text_key"),
        "n_words",
        F.coalesce("spans", none("array<struct<start: long, end: long>>")).alias("spans"),
        F.coalesce("items", none("array<string>")).alias("items"),
    )


def covered(spans: Column) -> Column:
    """Words that merged spans cover."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def _cut(text: str, spans: list[dict]) -> str:
    """The text without the words of the spans, and without what parts words inside a span."""
    raw = text.encode()
    words = Words([raw.translate(_MAP)], _SEED)
    out, at = [], 0
    for s in spans:
        out.append(raw[at : words.starts[s["start"]]])
        at = int(words.ends[s["end"] - 1])
    return b"".join([*out, raw[at:]]).decode()


def without_phrases(docs: DataFrame, found: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents with the found spans cut out of their texts; all columns and rows stay.

    Spans belong to a text, not to an id, so null and repeated ids are no trouble: texts meet them by
    their 64-bit key. Null and clean texts stay as they are. Column names may be any but `_key` and `_spans`.
    """
    hit = found.where(F.size("spans") > 0).groupBy(F.col("text_key").alias("_key"))
    hit = hit.agg(F.any_value("spans").alias("_spans"))
    joined = docs.withColumn("_key", F.xxhash64(text_column)).join(hit, "_key", "left")

    def run(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or s is None else _cut(t, s) for t, s in zip(texts, spans)])

    cut = F.pandas_udf(run, "string")
    return joined.withColumn(
        text_column, F.when(F.col("_spans").isNull(), F.col(text_column)).otherwise(cut(text_column, "_spans"))
    ).select(*docs.columns)
