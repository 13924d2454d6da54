"""N-gram Jaccard join by MinHash banding, verified on full sets of n-grams.

Documents with the same set of n-grams are one node. Nodes that share a band hash are joined to the
bucket's smallest node; the components of those edges are clusters, and every pair that shares a band
lies in one of them. A cluster's sets are compared in cells of bounded size, which give counts of links
and a spanning forest of them, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteospark.llm.common import fresh, stored
from meteospark.llm.components import components
from meteospark.llm.hashing import mixed, slices, word_windows

_SEED = 0x6A09E667
#: Sets and n-grams one side of a cell holds, about; rows of sets that clusters of one cell share a task by, about.
SIDE_SETS, SIDE_GRAMS, TASK_ROWS = 256, 1 << 20, 1_024
#: Different hashes of rows that tell texts of clusters from most others.
NEAR_KEYS = 1 << 20


def choose_bands(threshold: float, recall: float, most: int = 256) -> tuple[int, int]:
    """(bands, rows) with the most rows for which `most` hashes still give the recall at the threshold."""
    chosen = (most, 1)
    for rows in range(2, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows > most:
            break
        chosen = (bands, rows)
    return chosen


def gram_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit n-gram hashes of each text; all words where they are fewer than n."""
    (grams,), owners, counts = word_windows(texts, n, (_SEED,))
    cuts = np.searchsorted(owners, np.arange(len(texts) + 1))
    sets = []
    for i, text in enumerate(texts):
        if counts[i] >= n:
            sets.append(np.unique(grams[cuts[i] : cuts[i + 1]]))
        elif counts[i]:
            digest = blake2b(b" ".join(text.split()), digest_size=8).digest()
            sets.append(np.frombuffer(digest, np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def node_of(grams: np.ndarray) -> int | None:
    """A 64-bit name of a set; equal sets have equal names."""
    return int.from_bytes(blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True) if len(grams) else None


class MinHash:
    """Band hashes of sets; the same permutations on every run."""

    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(20240229)
        self.bands, self.rows = bands, rows
        self.factors = rng.integers(0, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.masks = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)

    def band_hashes(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row of 64-bit hashes for each non-empty set."""
        sizes = np.array([len(s) for s in sets])
        values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum(sizes) - sizes
        out = np.zeros((len(sets), self.bands), np.uint64)
        for band in range(self.bands):
            key = np.full(len(sets), band + 1, np.uint64)
            for k in range(band * self.rows, (band + 1) * self.rows):
                least = np.minimum.reduceat((values ^ self.masks[k]) * self.factors[k], starts)
                key = mixed(key + least.astype(np.uint64))
            out[:, band] = key
        return out


def _row_key(id_column: str, text_column: str) -> Column:
    """A 64-bit hash of id and text; only rows that are copies of each other share one."""
    return F.xxhash64(F.col(id_column).cast("long"), F.col(text_column))


def _small(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts, so that few texts at a time are Python objects."""
    for batch in batches:
        for lo in range(0, len(batch), rows):
            yield batch.slice(lo, rows)


def _near(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(NEAR_KEYS))


def signatures(docs: DataFrame, n: int, bands: int, rows: int, id_column: str, text_column: str) -> DataFrame:
    """id, key, node, grams (set size), bands; node and bands are null for texts without words."""

    def run(batches):
        hasher = MinHash(bands, rows)
        for batch in _small(batches):
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for lo, hi in slices(texts):
                sets = gram_sets(texts[lo:hi], n)
                full = [i for i, s in enumerate(sets) if len(s)]
                hashes: list = [None] * len(sets)
                if full:
                    found = hasher.band_hashes([sets[i] for i in full]).view(np.int64)
                    for i, row in zip(full, found):
                        hashes[i] = row
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(2).slice(lo, hi - lo),
                        pa.array([node_of(s) for s in sets], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(hashes, pa.list_(pa.int64())),
                    ],
                    ["id", "key", "node", "grams", "bands"],
                )

    key = _row_key(id_column, text_column).alias("key")
    slim = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"), key)
    return slim.mapInArrow(run, "id long, key long, node long, grams long, bands array<long>")


def _with_sets(docs: DataFrame, n: int) -> DataFrame:
    """docs (text, node, ...) of those rows whose text has the node, with the set in place of the text."""

    def run(batches):
        for batch in _small(batches):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            expected = batch.column("node").to_pylist()
            found = []
            for lo, hi in slices(texts):
                found += gram_sets(texts[lo:hi], n)
            right = [node_of(s) == e for s, e in zip(found, expected)]
            names = [f for f in batch.schema.names if f != "text"]
            columns = [batch.column(f) for f in names] + [pa.array([s.tobytes() for s in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "set"]).filter(pa.array(right, pa.bool_()))

    rest = [f"{c} {t}" for c, t in docs.dtypes if c != "text"]
    return docs.mapInArrow(run, ", ".join([*rest, "set binary"]))


def overlaps(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of every set on the left with every one on the right (None: left)."""
    sets = left if right is None else left + right
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    name = np.cumsum(new) - 1
    shared = np.bincount(name)[name] > 1
    name, owner = name[shared], owner[shared]
    split, total = len(left), np.zeros((len(left), len(left if right is None else right)), np.float64)
    if len(name):
        name = np.cumsum(np.concatenate([[True], name[1:] != name[:-1]])) - 1
        width = max(1, min(4096, (1 << 22) // len(sets)))
        cuts = np.searchsorted(name, np.arange(0, name[-1] + width + 1, width))
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if b > a:
                block = np.zeros((len(sets), width), np.float32)
                block[owner[a:b], name[a:b] - i * width] = 1
                total += block[:split] @ (block[:split] if right is None else block[split:]).T
    return total


def _verify(threshold: Fraction):
    top, bottom = threshold.numerator, threshold.denominator
    kinds = pa.schema([(c, pa.int64()) for c in ("node", "texts", "copies", "root")])

    def run(table: pa.Table) -> pa.Table:
        rows = []
        data = table.to_pydict()
        cells: dict[tuple, dict[int, tuple]] = {}
        for root, i, j, slot, node, copies, raw in zip(*(data[c] for c in ("root", "i", "j", "slot", "node", "copies", "set"))):
            cells.setdefault((root, i, j), {})[node] = (slot, copies, np.frombuffer(raw, np.uint64))
        for (_, i, j), members in cells.items():
            a = [m for m in members.items() if m[1][0] == i]
            b = None if i == j else [m for m in members.items() if m[1][0] == j]
            if not a or b == []:
                continue
            inter = overlaps([m[1][2] for m in a], None if b is None else [m[1][2] for m in b])
            size = lambda side: np.array([len(m[1][2]) for m in side], float)
            both = size(a)[:, None] + size(a if b is None else b)[None, :]
            linked = inter * (top + bottom) >= top * both  # inter / (both - inter) >= top / bottom
            if b is None:
                np.fill_diagonal(linked, False)
            rows += _counted(linked, a, b)
        columns = list(zip(*rows)) or [[]] * 4
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=kinds)

    return run


def _counted(linked: np.ndarray, a: list, b: list | None) -> list[tuple[int, int, int, int]]:
    """(node, linked texts, linked documents, root in this cell) of every node with a link."""
    nodes = [m[0] for m in a] + ([] if b is None else [m[0] for m in b])
    weight_a = np.array([m[1][1] for m in a])
    weight_b = weight_a if b is None else np.array([m[1][1] for m in b])
    texts, copies = linked.sum(axis=1), linked @ weight_b
    if b is not None:
        texts, copies = np.concatenate([texts, linked.sum(axis=0)]), np.concatenate([copies, linked.T @ weight_a])
    shift = 0 if b is None else len(a)
    root = list(range(len(nodes)))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, row in enumerate(linked):
        for y in np.flatnonzero(row):
            p, q = top(x), top(int(y) + shift)
            if p != q:
                root[q] = p
    return [
        (nodes[k], int(texts[k]), int(copies[k]), nodes[top(k)]) for k in range(len(nodes)) if texts[k]
    ]


def jaccard_classes(
    docs: DataFrame,
    n: int = 5,
    threshold: Fraction = Fraction(4, 5),
    recall: float = 0.99999,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, class_id, n_links, n_text_links of every document, by the Jaccard similarity of n-gram sets.

    A link joins two documents with a similarity of `threshold` or more. n_links counts a document's
    links to other documents, copies included; n_text_links those to other sets of n-grams, each once.
    class_id is the smallest doc_id that links lead to. `recall` is the probability that a pair right at
    the threshold shares a band; it chooses bands and rows, and rises steeply above the threshold.

    Words are runs of anything but ASCII white space. Texts with fewer than n words have one n-gram of
    all words; null texts and those without words have none, no links and a class of their own. Null and
    repeated ids are documents like others, though a class of null ids has a null class_id. Empty tables
    give no rows; other columns aren't read.
    """
    signed, known = _classes(docs, n, threshold, recall, id_column, text_column)
    return signed.select("id", "node").join(known.drop("head"), "node", "left").select(
        F.col("id").alias("doc_id"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("texts", F.lit(0)).cast("long").alias("n_text_links"),
    )


def _first() -> Column:
    """The smallest id and, among rows of that id, the smallest key; null ids come last."""
    return F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first")


def _classes(
    docs: DataFrame, n: int, threshold: Fraction, recall: float, id_column: str, text_column: str
) -> tuple[DataFrame, DataFrame]:
    """The signatures, and node, class_id, head (key of the row that stays for the class), n, texts."""
    bands, rows = choose_bands(float(threshold), recall)
    signed = stored(signatures(docs, n, bands, rows, id_column, text_column), "signatures")
    named = signed.where("node IS NOT NULL")
    nodes = named.groupBy("node").agg(_first(), F.count("*").alias("copies"), F.first("grams").alias("grams"))
    nodes = nodes.select("node", "first.id", "first.key", "copies", "grams")
    keys = named.select("node", F.explode("bands").alias("key"))
    leaders = keys.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("most")).where("a < most")
    candidates = keys.join(leaders, "key").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    clusters = stored(components(candidates).join(nodes, "node"), "clusters")

    sizes = clusters.groupBy("root").agg(F.count("*").alias("sets"), F.sum("grams").alias("all_grams"))
    parts = F.greatest(F.ceil(F.col("sets") / SIDE_SETS), F.ceil(F.col("all_grams") / SIDE_GRAMS))
    sizes = sizes.withColumn("parts", F.least(parts, F.col("sets")).cast("int"))
    placed = clusters.join(sizes.select("root", "parts"), "root").withColumn("slot", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    texts = docs.select(_row_key(id_column, text_column).alias("key"), F.col(text_column).alias("text"))
    reps = placed.select("key", "node", "root", "copies", "slot", "parts")
    # at most NEAR_KEYS numbers are broadcast: most texts in no cluster are left out before the join
    wanted = F.broadcast(reps.select(_near("key").alias("near")).distinct())
    texts = texts.withColumn("near", _near("key")).join(wanted, "near", "left_semi").drop("near")
    # a row meets the one node of its own text, whatever its id; of copies of a row one does
    sets = _with_sets(texts.dropDuplicates(["key"]).join(reps, "key").drop("key"), n)
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    cells = sets.select("root", "slot", "node", "copies", "set", "parts", other).select(
        "root", F.least("slot", "other").alias("i"), F.greatest("slot", "other").alias("j"),
        "slot", "node", "copies", "set", "parts",
    )
    # a cell of a large cluster is a group of its own; clusters of one cell share groups by their rows and bytes
    one = sizes.where("parts = 1").agg(F.sum("sets").alias("sets"), F.sum("all_grams").alias("all_grams")).first()
    tasks = max(1, (one["sets"] or 0) // TASK_ROWS, (one["all_grams"] or 0) // (2 * SIDE_GRAMS))
    shared = F.pmod(F.xxhash64("root"), F.lit(tasks))
    dealt = cells.withColumn("task", F.when(F.col("parts") > 1, F.col("root")).otherwise(shared)).drop("parts")
    shape = "node long, texts long, copies long, root long"
    links = stored(dealt.groupBy("task", "i", "j").applyInArrow(_verify(threshold), shape), "links")

    classes = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("copies").alias("linked"))
    known = nodes.join(counts, "node", "left").join(classes, "node", "left")
    known = stored(
        known.select("node", "id", "key", "copies", F.coalesce("texts", F.lit(0)).alias("texts"),
                     F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("root", "node").alias("root")),
        "nodes",
    )
    heads = known.groupBy("root").agg(_first()).select("root", F.col("first.id").alias("class_id"), F.col("first.key").alias("head"))
    linked = (F.col("linked") + F.col("copies") - 1).alias("n")
    return signed, known.join(heads, "root").select("node", "class_id", "head", linked, "texts")


def one_of_each(
    docs: DataFrame,
    n: int = 5,
    threshold: Fraction = Fraction(4, 5),
    recall: float = 0.99999,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One document of each class: a row with its smallest id; of repeated rows one stays.

    Rows are judged by id and text, so those that share an id or have none are documents like others;
    a row without an id stays if its class has no ids. Texts without words are no copies of each other.
    Very long texts are judged whole, an empty table gives none. Columns are those of `docs`, whatever
    their names. Whole rows are shuffled only where they may be copies; a prefilter of NEAR_KEYS numbers
    tells, which tells less once the copies are more than about as many.
    """
    signed, known = _classes(docs, n, threshold, recall, id_column, text_column)
    judged = signed.select("node", "key").join(known.select("node", "head"), "node", "left")
    # null where a text without words is no copy of any
    keys = judged.groupBy("key").agg(F.count("*").alias("rows"), F.first(F.col("key") == F.col("head")).alias("stays"))
    keys = stored(keys.where("rows > 1 OR NOT stays").select("key", F.coalesce("stays", F.lit(True)).alias("stays")), "judged")
    key, mark, stays = fresh(docs, "_row_key", "_near", "_stays")
    marks = F.broadcast(keys.select(_near("key").alias(mark)).distinct().withColumn(stays, F.lit(True)))
    # at most NEAR_KEYS numbers are broadcast: rows that hit none of them are judged in the scan and stay
    marked = docs.withColumn(key, _row_key(id_column, text_column))
    marked = marked.withColumn(mark, _near(key))
    alone = marked.join(marks, mark, "left_anti")
    others = marked.join(marks.drop(stays), mark, "left_semi")
    others = others.join(keys.withColumnsRenamed({"key": key, "stays": stays}), key, "left")
    others = others.where(F.coalesce(F.col(stays), F.lit(True))).dropDuplicates([key])
    return alone.select(*docs.columns).unionAll(others.select(*docs.columns))
