"""Temperature mixing and interleaved shards on small sources."""

import math
import zlib

import pytest
from pyspark.sql import functions as F

from meteospark.llm import mixing
from meteospark.llm.sharding import interleaved_shards
from tests.llm.rows import corpus, documents, words

SIZES = {"a": 64, "b": 16, "c": 4, "d": 1}


def sources(spark):
    texts, names = [], []
    for s, n in SIZES.items():
        for i in range(n):
            texts.append(" ".join(words(20, len(texts))))
            names.append(s)
    return documents(spark, texts, names)


def test_repetition_limit_sets_the_exponent(spark):
    slim = mixing.slim_documents(sources(spark))
    targets, budget, exponent = mixing.weights(slim, max_repetition=4.0)
    assert abs(exponent - (1 - math.log(4) / math.log(64))) < 1e-6  # the largest is 64 times the smallest
    rows = {r.key: r for r in targets.collect()}
    assert abs(rows["+a"].target - rows["+a"].tokens) <= 1 and abs(rows["+d"].target / rows["+d"].tokens - 4) < 0.1
    assert abs(sum(r.weight for r in rows.values()) - 1) < 1e-12


def test_entropy_target(spark):
    slim = mixing.slim_documents(sources(spark))
    table = slim.groupBy("key").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows"))
    exponent = mixing.find_exponent(table, 85 * 20, None, target_entropy=1.5)
    p = [n / 85 for n in SIZES.values()]
    z = sum(x**exponent for x in p)
    assert abs(-sum(x**exponent / z * math.log2(x**exponent / z) for x in p) - 1.5) < 1e-6


def test_passes_and_blocks(spark):
    got = mixing.mixed(sources(spark), max_repetition=4.0, block_tokens=200).collect()
    times = {}
    for r in got:
        times.setdefault(r.source, {}).setdefault(r.doc_id, []).append(r["pass"])
    for s, n in SIZES.items():
        assert len(times[s]) == n  # every document is used
        assert all(sorted(p) == list(range(len(p))) for p in times[s].values())
    assert len(times["d"].popitem()[1]) == 4
    blocks = {}
    for r in got:
        blocks.setdefault(r.block, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in blocks.values()) and len(blocks) > 5


def test_budget_cuts_the_last_pass(spark):
    got = mixing.mixed(sources(spark), max_repetition=None, target_entropy=0.0, budget=850).collect()
    assert sum(r.n_tokens for r in got) <= 850 and len(got) >= 38
    assert len({(r.doc_id, r["pass"]) for r in got}) == len(got)


def test_mixture_of_agrees_with_mixed(spark):
    docs = sources(spark).withColumn("tokens", F.lit("clash"))
    rows = mixing.mixed(docs, max_repetition=3.0).groupBy("doc_id").count().collect()
    out = mixing.mixture_of(docs, max_repetition=3.0)
    assert out.columns == docs.columns
    assert {(r.doc_id, r["count"]) for r in out.groupBy("doc_id").count().collect()} == {(r.doc_id, r["count"]) for r in rows}


def test_awkward_sources(spark):
    docs = documents(spark, corpus(12) + ["a b"], ["x"] * 12 + [None] * 11 + ["y"], [1, 1] + list(range(2, 24)))
    rows = mixing.mixed(docs).collect()
    assert {r.doc_id for r in rows} == set(range(1, 24)) and {r.source for r in rows} == {"x", None, "y"}
    assert mixing.mixed(documents(spark, [])).collect() == []
    assert mixing.mixture_of(documents(spark, [])).collect() == []
    only_empty = documents(spark, [None, ""], ["x", "y"])
    assert sorted(r.doc_id for r in mixing.mixture_of(only_empty).collect()) == [0, 1]


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_hold_the_mixture(spark, shards):
    texts = [f"t{i}" if i % 7 else None for i in range(203)]
    names = ["big" if i % 3 else f"s{i % 5}" for i in range(202)] + [None]
    rows = interleaved_shards(documents(spark, texts, names).withColumn("shard", F.lit("x")), shards).collect()
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
        text = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(text) + 1, zlib.crc32(text))
    counts = [len(x) for x in by.values()]
    assert max(counts) - min(counts) <= 1 and sum(counts) == 203
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
        for s in ("big", "s0", "s3"):
            assert abs(sum(r.source == s for r in own) - names.count(s) / shards) < 2
    again = interleaved_shards(documents(spark, texts, names), shards).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in again} == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_shards_of_awkward_rows(spark):
    assert interleaved_shards(documents(spark, [])).collect() == []
    rows = interleaved_shards(documents(spark, ["a", "a", None], ids=[1, 1, None]), 8).collect()
    assert sorted(r.slot for r in rows) == [0, 0, 0]
