"""Exact top-k by inner product with a pivot table that eliminates candidates.

Every vector's distances to a few pivots are its row of the pivot table. Vectors of one nearest pivot and
about one distance to it form a block, and a block's box - the least and largest distance to each pivot, the
largest norm - bounds the scores of all it holds. A query first meets the few blocks of the highest bounds,
which give a score that its k-th best can't be below, and then only those whose bound reaches that. Inside a block
candidates are evaluated in the order of their own bounds until none can come in any more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meteospark.llm.common import stored
from meteospark.operators import spans

#: Vectors of one block of candidates, about, and queries that meet it at once; blocks there may be, as their
#: boxes are broadcast (about 600 bytes each): larger tables have larger blocks.
BLOCK, QUERY_BLOCK, MOST_BLOCKS = 2_048, 1_024, 1 << 16
#: Rings of distance around a pivot, and blocks a query meets first.
_RINGS, FIRST_BLOCKS = 256, 8
#: The pivots are chosen from this many vectors at most, by farthest-first.
SAMPLE, PIVOTS = 512, 32


def integer_vectors(vectors: DataFrame, id_column="vec_id", vector_column="embedding", scale: int = 256) -> DataFrame:
    """id and v = floor(scale * x) of every vector whose components are all finite numbers."""
    v = F.col(vector_column)
    unfit = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    scaled = F.transform(v, lambda x: F.floor(x.cast("double") * scale))
    return vectors.where(v.isNotNull() & F.col(id_column).isNotNull()).where(~unfit).select(
        F.col(id_column).cast("long").alias("id"), scaled.alias("v")
    )


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS) -> dict[int, np.ndarray]:
    """Per dimension, pivots spread by farthest-first over the first SAMPLE vectors in a seeded order."""
    rows = vectors.orderBy(F.xxhash64("id"), "id", "v").limit(SAMPLE).collect()
    found = {}
    for size in sorted({len(r.v) for r in rows}):
        own = [r.v for r in rows if len(r.v) == size]
        points = np.array(own, float).reshape(len(own), size)
        chosen = [0]
        far = np.linalg.norm(points - points[0], axis=1)
        while len(chosen) < min(pivots, len(points)) and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, np.linalg.norm(points - points[chosen[-1]], axis=1))
        found[size] = points[chosen]
    return found


def _lists(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All elements of a list column behind one another, and the length of each list."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False), flat.value_lengths().to_numpy(zero_copy_only=False)


def _matrix(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """Lists of one length as the rows of a matrix; empty ones as rows without columns."""
    values, lengths = _lists(column)
    return values.astype(kind).reshape(len(lengths), int(lengths[0]) if len(lengths) else 0)


def with_table(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """id, v, dim, near, cell, own: near is the vector's row of the pivot table (empty where its dimension
    has no pivots), cell its nearest pivot, own the distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, lengths = _lists(batch.column(1))
            starts = np.cumsum(lengths) - lengths
            near: list = [[] for _ in lengths]
            cell, own = np.zeros(len(lengths), np.int32), np.zeros(len(lengths))
            for size in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == size)
                if size in pivots:
                    points = values[starts[at][:, None] + np.arange(size)].astype(float)
                    far = np.stack([np.linalg.norm(points - p, axis=1) for p in pivots[size]], axis=1)
                    cell[at], own[at] = far.argmin(axis=1), far.min(axis=1)
                    for i, row in zip(at.tolist(), far):
                        near[i] = row
            columns = [batch.column(0), batch.column(1), pa.array(lengths, pa.int32()), pa.array(near, pa.list_(pa.float64())), pa.array(cell), pa.array(own)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "v", "dim", "near", "cell", "own"])

    return vectors.mapInArrow(run, "id long, v array<long>, dim int, near array<double>, cell int, own double")


def _blocked(tabled: DataFrame, rows: int) -> DataFrame:
    """Adds `block`: vectors of one dimension, cell and ring of distances, or a part of a ring that holds more."""
    size = max(BLOCK, -(-rows // (MOST_BLOCKS // 4)))
    largest = tabled.groupBy("dim", "cell").count().agg(F.max("count")).first()[0] or 0
    rings = max(2, min(_RINGS, -(-largest // size)))
    ringed = spans.value_slices(tabled, ["dim", "cell"], "own", rings).withColumnRenamed("_slice", "ring")
    key = ["dim", "cell", "ring"]
    parts = ringed.groupBy(*key).agg(F.ceil(F.count("*") / size).alias("parts"))
    part = F.pmod(F.xxhash64("id", "v"), F.col("parts"))
    return ringed.join(parts, key).withColumn("block", F.xxhash64(*key, part)).drop("ring", "parts")


class _Boxes:
    """For each block the least and largest distance to every pivot, the largest norm, and its size."""

    def __init__(self, blocked: DataFrame, pivots: dict[int, np.ndarray]):
        most = max((len(p) for p in pivots.values()), default=0)
        ends = [f(F.get("near", F.lit(i))).alias(f"{n}{i}") for i in range(most) for f, n in ((F.min, "lo"), (F.max, "hi"))]
        norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
        sizes = F.count("*").alias("rows")
        rows = blocked.groupBy("block", "dim").agg(F.max(norm).alias("norm"), sizes, *ends).collect()  # MOST_BLOCKS, about
        self.by_dim = {}
        for dim in {r.dim for r in rows}:
            own, n = [r for r in rows if r.dim == dim], len(pivots.get(dim, ()))
            side = lambda s: np.array([[r[f"{s}{i}"] for i in range(n)] for r in own], float).reshape(len(own), n)  # noqa: B023, E731
            column = lambda c, kind: np.array([r[c] for r in own], kind)  # noqa: B023, E731
            self.by_dim[dim] = (column("block", np.int64), side("lo"), side("hi"), column("norm", float), column("rows", np.int64))

    def bounds(self, dim: int, norm: float, near: np.ndarray) -> np.ndarray:
        """What no score of a block is above, for a query of this norm and table row."""
        _, lo, hi, norms, _ = self.by_dim[dim]
        apart = np.maximum(np.maximum(lo - near, near - hi), 0).max(axis=1) if lo.shape[1] else np.zeros(len(norms))
        apart = np.maximum(apart * (1 - 1e-9) - 1e-6, 0)
        # |v| is at most `norms`, and d(q, v) at least `apart`
        bound = np.minimum(norm * norms, (norm**2 + norms**2 - apart**2) / 2)
        return bound + 1e-6 * (1 + norm**2 + norms**2)

    def first(self, dim: int, bounds: np.ndarray, rows: int) -> np.ndarray:
        """Places of the blocks of the highest bounds that hold so many rows, FIRST_BLOCKS at most."""
        order = np.argsort(-bounds, kind="stable")[:FIRST_BLOCKS]
        held = np.cumsum(self.by_dim[dim][4][order])
        return order[: int(np.searchsorted(held, rows)) + 1]


def scores_of(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in floating point or 64 bits where no sum can leave them, else by
    Python's integers."""
    if not vectors.size:
        return np.zeros(len(vectors), np.int64)
    high = lambda x: max(int(x.max()), -int(x.min()))
    most = high(vectors) * high(query) * vectors.shape[1]
    if most < 1 << 53:
        return (vectors.astype(float) @ query.astype(float)).astype(np.int64)
    if most < 1 << 63:
        return vectors @ query
    return vectors.astype(object) @ query.astype(object)


def squares(vectors: np.ndarray) -> np.ndarray:
    """Squared lengths, in floating point."""
    wide = vectors.astype(float)
    return np.einsum("ij,ij->i", wide, wide)


def best_of(ids, vectors, norms, near, query_id, query, query_near, k):
    """The k best candidates of one block for one query as (score, id), and how many were evaluated.

    |d(q, p) - d(v, p)| is at most d(q, v), so the largest over the pivots bounds the inner product
    (|q|^2 + |v|^2 - d^2) / 2 from above. Candidates are evaluated in the order of that bound until the
    k-th best score is above the next bound; equal scores go on, as a smaller id may still win.
    """
    own = float(squares(query[None])[0])
    low = np.abs(near - query_near).max(axis=1) if near.shape[1] else np.zeros(len(ids))
    bound = (own + norms - np.square(np.maximum(low * (1 - 1e-9) - 1e-6, 0))) / 2 + 1e-6 * (1 + own + norms)
    order = np.argsort(-bound, kind="stable")
    order = order[ids[order] != query_id]
    best: list[tuple[int, int]] = []
    at, step = 0, 64
    while at < len(order):
        if len(best) == k and bound[order[at]] < best[-1][0]:
            break
        part = order[at : at + step]
        scores = scores_of(vectors[part], query)
        if len(best) == k:
            close = np.asarray(scores >= best[-1][0], bool)
            part, scores = part[close], scores[close]
        found = zip(map(int, scores), ids[part].tolist())
        best = sorted([*best, *found], key=lambda x: (-x[0], x[1]))[:k]
        at, step = at + step, step * 2
    return best, min(at, len(order))


def _meet(k: int):
    """A block's vectors (left) and the queries it can serve (right): the k best of each."""

    def run(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        rows = []
        if len(candidates) and len(asked):
            ids = candidates["id"].to_numpy()
            matrix, near = _matrix(candidates["v"], "i8"), _matrix(candidates["near"], "f8")
            q, qn, norms = _matrix(asked["v"], "i8"), _matrix(asked["near"], "f8"), squares(matrix)
            for i, query_id in enumerate(asked["id"].to_pylist()):
                best = best_of(ids, matrix, norms, near, query_id, q[i], qn[i], k)[0]
                rows += [(query_id, vec_id, score) for score, vec_id in best]
        columns = list(zip(*rows)) or [[]] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    return run


def _routes(queries: DataFrame, boxes, k: int, groups: int) -> DataFrame:
    """id, block, group: the first blocks of each query, or, with its `floor`, all others that may reach it."""
    later = "floor" in queries.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                names, found = [], []
                floors = part.column("floor").to_pylist() if later else [None] * len(part)
                for i, dim, v, near, floor in zip(*(part.column(c).to_pylist() for c in ("id", "dim", "v", "near")), floors):
                    bounds = boxes.value.bounds(dim, float(np.linalg.norm(np.array(v, float))), np.array(near, float))
                    first = boxes.value.first(dim, bounds, 8 * k)
                    if later:
                        rest = np.ones(len(bounds), bool) if floor is None else bounds >= floor
                        rest[first] = False
                        first = np.flatnonzero(rest)
                    names += [i] * len(first)
                    found.append(boxes.value.by_dim[dim][0][first])
                block = np.concatenate(found) if found else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(block)], ["id", "block"])

    columns = ["id", "dim", "v", "near"] + ["floor"] * later
    group = F.pmod(F.xxhash64("id"), F.lit(groups)).alias("group")
    return queries.select(*columns).mapInArrow(run, "id long, block long").select("id", "block", group)


def _served(blocked: DataFrame, queries: DataFrame, routed: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score: the k best of each query in each block it is sent to."""
    left = blocked.join(routed.select("block", "group").distinct(), "block").select("block", "group", "dim", "id", "v", "near")
    right = routed.join(queries.select("id", "dim", "v", "near"), "id")
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # columns of its own: both sides come from `routed`
    keys = ["block", "group", "dim"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_meet(k), "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best vectors by integer inner product.

    vectors: id, v (array of long). Every row whose id is not the query's own is a candidate; equal
    scores go to the smaller id. A repeated id is one query (its smallest vector) and as many
    candidates; rows without an id take no part. Only vectors of the query's dimension have a score:
    empty vectors score 0 with each other. A query without candidates has no row, an empty table none.
    Scores are exact integers; one that doesn't fit into 64 bits is an error. A vector is shuffled once for
    each group of queries that its block can serve, a query once for each block that may hold one of its
    best; boxes of blocks are broadcast, and their number is bounded.
    """
    vectors = stored(vectors.where(F.col("id").isNotNull()), "vectors")
    rows, pivots = vectors.count(), choose_pivots(vectors)
    blocked = stored(_blocked(with_table(vectors, pivots), rows), "blocks")
    lowest = vectors.where(is_query).groupBy("id").agg(F.min("v").alias("v"))
    queries = stored(blocked.join(lowest, ["id", "v"]).dropDuplicates(["id"]), "queries")
    groups = max(1, -(-queries.count() // QUERY_BLOCK))
    boxes = vectors.sparkSession.sparkContext.broadcast(_Boxes(blocked, pivots))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    rank = F.row_number().over(order).cast("int").alias("rank")
    early = stored(_served(blocked, queries, stored(_routes(queries, boxes, k, groups), "first_routes"), k), "early")
    floors = early.select("query_id", "score", rank).where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    asked = queries.join(floors, queries["id"] == floors["query_id"], "left")
    late = _served(blocked, queries, stored(_routes(asked, boxes, k, groups), "routes"), k)
    return early.unionAll(late).select("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)
