"""Exact top-k against all inner products."""

import math

import numpy as np
from pyspark.sql import functions as F

from meteospark.llm import topk


def brute(vectors, k):
    fit = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors
           if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    queries = {}
    for i, v in fit:
        if i % 50 == 0:
            queries[i] = min(queries.get(i, v), v)
    for q, v in queries.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in fit if i != q and len(w) == len(v))
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)}
    return out


def test_equals_all_products(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(0, 0.2, (400, 16)).astype("float32")
    base[200:260] = base[0]  # ties
    vectors = [(i, v.tolist()) for i, v in enumerate(base)]
    vectors += [(1000, None), (1050, [None] * 16), (1100, [float("nan")] * 16), (None, [0.1] * 16)]
    vectors += [(1150, [0.5, 0.25]), (1151, [0.5, 0.5]), (50, base[3].tolist()), (1200, [float("inf")] * 16)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("near", F.lit("clash"))
    got = topk.top_k(topk.integer_vectors(df), F.col("id") % 50 == 0, 5).collect()
    assert {tuple(r) for r in got} == brute(vectors, 5) and len(got) == len(brute(vectors, 5))


def test_bounds_spare_evaluations():
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 300, (20, 8))
    data = np.floor(np.repeat(centres, 50, axis=0) + rng.normal(0, 5, (1000, 8))).astype("i8")
    pivots = data[::50]
    near = np.linalg.norm(data[:, None] - pivots[None], axis=2)
    query = data[123]
    best, seen = topk.best_of(np.arange(1000), data, topk.squares(data), near, 123, query, near[123], 5)
    scores = sorted((-(v @ query), i) for i, v in enumerate(data) if i != 123)
    assert best == [(-s, i) for s, i in scores[:5]] and seen < 1000


def test_empty_and_single(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(50, [1.0])]):
        vectors = topk.integer_vectors(spark.createDataFrame(rows, schema))
        assert topk.top_k(vectors, F.col("id") % 50 == 0).collect() == []


def test_empty_vectors_score_nothing(spark):
    vectors = [(0, []), (50, []), (7, []), (100, [1.0]), (None, []), (8, [0.5, 2.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = topk.top_k(topk.integer_vectors(df), F.col("id") % 50 == 0, 5).collect()
    assert {tuple(r) for r in got} == brute(vectors, 5) == {(0, 1, 7, 0), (0, 2, 50, 0), (50, 1, 0, 0), (50, 2, 7, 0)}


def test_scores_beyond_floating_point(spark):
    """Products above 2^53, and ones whose parts pass 64 bits before they cancel."""
    rng = np.random.default_rng(8)
    big = [(i, [int(x) for x in rng.integers(-3_000_000_000 // 8, 3_000_000_000 // 8, 8)]) for i in range(120)]
    big += [(200 + i, [768_000_000 + i] * 8) for i in range(8)]
    huge = [(300, [1 << 40, 1 << 40, 3]), (301, [1 << 40, -(1 << 40), 5]), (350, [-(1 << 40), 1 << 40, 7])]
    rows = big + huge
    df = spark.createDataFrame(rows, "id long, v array<long>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(df.where("id < 300"), F.col("id") % 50 == 0, 5).collect()}
    for q, v in big:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in big if i != q)[:5]
            assert [got[q, rank] for rank in range(1, 6)] == [(i, -s) for s, i in scores]
    assert topk.scores_of(np.array([v for _, v in huge[:2]]), np.array([1 << 40, -(1 << 40), 1])).tolist() == [3, 2**81 + 5]
    assert topk.scores_of(np.array([huge[0][1]]), np.array(huge[1][1])).tolist() == [15]


def test_queries_go_to_few_blocks(spark, monkeypatch):
    """Clustered vectors, a third of them equal: routes are far fewer than queries times blocks, results whole."""
    monkeypatch.setattr(topk, "BLOCK", 64)
    rng = np.random.default_rng(9)
    centres = rng.normal(0, 2_000, (25, 12))
    data = np.concatenate([np.repeat(centres, 80, axis=0) + rng.normal(0, 30, (2_000, 12)), np.tile(centres[0], (1_000, 1))])
    rows = [(i, [int(x) for x in v]) for i, v in enumerate(data)]
    df = spark.createDataFrame(rows, "id long, v array<long>")
    sizes, routed = [], []
    kept = topk.stored

    def watched(df, name):
        out = kept(df, name)
        if name.endswith("routes"):
            routed.append(out.count())
        if name == "blocks":
            sizes.extend(r["count"] for r in out.groupBy("block").count().collect())
        return out

    monkeypatch.setattr(topk, "stored", watched)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(df, F.col("id") % 50 == 0, 5).collect()}
    matrix = np.array([v for _, v in rows])
    for q in range(0, 3_000, 50):
        scores = sorted((-int(s), i) for i, s in enumerate(matrix @ matrix[q]) if i != q)[:5]
        assert [got[q, rank] for rank in range(1, 6)] == [(i, -s) for s, i in scores]
    assert sum(sizes) == 3_000 and max(sizes) < 4 * 64
    assert sum(routed) < 60 * len(sizes) / 2
