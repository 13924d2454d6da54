"""Benchmark phrases: the index and the operator against plain search."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from meteospark.llm import decontamination
from meteospark.llm.fm_index import Index, suffix_order
from meteospark.llm.hashing import mixed
from tests.llm.rows import awkward, corpus, documents, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def windows(items, size):
    found = {}
    for item, text in items:
        w = split(text)
        m = min(size, len(w))
        for k in range(len(w) - m + 1 if w else 0):
            found.setdefault(tuple(w[k : k + m]), set()).add(None if item is None else str(item))
    return found


def brute(rows, items, size):
    wanted = windows(items, size)
    lengths = {len(w) for w in wanted}
    out = []
    for i, text in rows:
        w, hit, named = split(text), set(), set()
        for m in lengths:
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in wanted:
                    hit |= set(range(k, k + m))
                    named |= wanted[tuple(w[k : k + m])]
        out.append((i, len(w), sorted(hit), sorted(named - {None})))
    return sorted(out, key=str)


def got(found):
    flat = lambda spans: [p for s in spans for p in range(s.start, s.end)]
    return sorted([(r.doc_id, r.n_words, flat(r.spans), r["items"]) for r in found.collect()], key=str)


def benchmark(texts):
    rng = random.Random(3)
    items = []
    for k, text in enumerate(t for t in texts if t and len(split(t)) > 40):
        w = split(text)
        at = rng.randrange(len(w) - 20)
        items.append((k, " ".join(w[at : at + rng.randint(8, 20)]).upper()))
    items += [(7, " ".join(words(14, 77))), (None, items[0][1]), (1000, items[1][1]), (1000, items[1][1] + " more words")]
    return items + [(1001, "x" * 60_000), (1002, ""), (1003, None), (1004, "... --"), (1005, "one")]


@pytest.mark.parametrize("size, shard_bytes, pass_windows", [(10, 1 << 23, 1 << 17), (10, 5_000, 50), (3, 20_000, 1 << 17)])
def test_equals_brute_force(spark, size, shard_bytes, pass_windows):
    texts = corpus()
    items = benchmark(texts)
    table = spark.createDataFrame(items, "item_id long, text string")
    indexes = decontamination.shard_indexes(documents(spark, texts), shard_bytes=shard_bytes)
    found = decontamination.find_phrases(indexes, table, size, pass_windows=pass_windows)
    assert got(found) == brute(list(enumerate(texts)), items, size)


def test_null_and_repeated_ids_and_other_columns(spark):
    text = " ".join(words(40, 4))
    ids, texts = [None, 1, 1, None, 2], [text, text, text + " more", None, ""]
    df = documents(spark, texts, ids=ids).withColumn("shard", F.lit("x")).withColumn("spans", F.lit(1))
    items = [(1, " ".join(text.split()[5:25]))]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("window", F.lit(0))
    found = decontamination.find_phrases(decontamination.shard_indexes(df), table)
    assert got(found) == brute(list(zip(ids, texts)), items, 10)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    docs = documents(spark, ["a b c"])
    index = decontamination.shard_indexes
    assert decontamination.find_phrases(index(docs.limit(0)), items).collect() == []
    assert [(r.n_words, r.spans) for r in decontamination.find_phrases(index(docs), items.limit(0)).collect()] == [(3, [])]


def test_found_phrases_are_cut_out(spark):
    phrase = " ".join(words(15, 8))
    texts = [f"Before, {phrase}; after.", None, "clean é text", f"{phrase}", f"a {phrase} b {phrase.upper()}!", f"a {phrase} b {phrase.upper()}!"]
    docs = documents(spark, texts, ids=[1, 2, None, 4, 5, 5])
    items = spark.createDataFrame([("q", phrase)], "item_id string, text string")
    found = decontamination.find_phrases(decontamination.shard_indexes(docs), items)
    left = decontamination.without_phrases(docs, found)
    assert left.columns == docs.columns
    want = ["Before, ; after.", None, "clean é text", "", "a  b !", "a  b !"]
    assert sorted(map(str, [r.text for r in left.collect()])) == sorted(map(str, want))


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(5)
    for few in range(2, 9):
        text = np.concatenate([np.append(rng.integers(1, few, rng.integers(0, 60)), 0) for _ in range(9)])
        # an end ranks by its place, below all words
        key = lambda p: [(0, i) if text[i] == 0 else (1, text[i]) for i in range(p, len(text))]  # noqa: B023, E731
        assert suffix_order(text).tolist() == sorted(range(len(text)), key=key)
        hashes = mixed(text.astype(np.uint64))
        index = Index.from_bytes(Index.of(hashes, text == 0).to_bytes())
        phrases = [rng.integers(1, few + 1, rng.integers(1, 6)) for _ in range(50)]
        rows = np.zeros((50, 5), np.uint64)
        for row, p in zip(rows, phrases):
            row[5 - len(p) :] = mixed(p.astype(np.uint64))
        alive, low, high = index.search(rows, np.array([len(p) for p in phrases]))
        places = {k: sorted(index.locate(np.arange(a, b)).tolist()) for k, a, b in zip(alive.tolist(), low, high)}
        for k, p in enumerate(phrases):
            assert places.get(k, []) == [s for s in range(len(text) - len(p) + 1) if (text[s : s + len(p)] == p).all()]


def test_awkward_texts_alone(spark):
    texts = awkward()
    found = decontamination.find_phrases(
        decontamination.shard_indexes(documents(spark, texts), shard_bytes=100),
        spark.createDataFrame([(1, "b")], "item_id long, text string"),
    )
    assert got(found) == brute(list(enumerate(texts)), [(1, "b")], 10)
