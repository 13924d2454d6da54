"""Spelling variants: the operator against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meteospark.llm import spelling
from tests.llm.rows import awkward, documents

LOWER = {c: c + 32 for c in range(65, 91)}


def counted(rows, every=None):
    counts = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            if every and i is not None:
                h = zlib.crc32(f"{i}:{w}".encode())
                if h % every == 0:
                    w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return len(y) == len(x) + 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def brute(counts, factor=10):
    near = {w: [o for o in counts if abs(len(o) - len(w)) < 2 and one_edit(w, o)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], counts.get(form[w]), root))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


def texts(n=60, seed=2):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcdeéøßÿ", k=rng.randint(6, 11))) for _ in range(40)]
    pool = list(base)
    for w in base:
        for _ in range(5):
            i = rng.randrange(len(w))
            pool.append(rng.choice([w[:i] + w[i + 1 :], w[:i] + "a" + w[i:], w[:i] + "b" + w[i + 1 :], w.upper()]))
    weights = [rng.choice([1, 1, 1, 15, 200]) for _ in pool]
    parts = [" ", ", ", "3", "\n", "’", "œ"]
    chain = "chainab " * 2 + "chainabc " * 25 + "Chainabcd " * 300
    return [chain] + ["".join(w + rng.choice(parts) for w in rng.choices(pool, weights, k=rng.randint(1, 200))) for _ in range(n)]


@pytest.mark.parametrize("every", [None, 3, 31])
def test_equals_brute_force(spark, every):
    rows = list(enumerate(texts() + awkward()))
    docs = documents(spark, [t for _, t in rows])
    words = spelling.counted_words(docs, drop_every=every)
    want = brute(counted(rows, every))
    assert any(r[3] and r[5] != r[3] for r in want) or every
    assert got(spelling.spelling_groups(words)) == want


def test_long_words_and_words_of_one_letter(spark):
    rng = random.Random(6)
    long = ["".join(rng.choices("ab", k=k)) for k in (63, 64, 65, 66, 400, 5_000)]
    words = {"x" * k: 5 for k in (7, 8, 9, 63, 64, 65, 66, 67, 3_000, 3_001)}
    for w in long:
        words |= {w: 50, w[:20] + w[21:]: 5, w + "b": 3, w[:-1] + "c": 2, "a" + w: 500}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(spelling.spelling_groups(table)) == brute(words)


def test_null_and_repeated_ids_and_other_columns(spark):
    ids, rows = [None, 1, 1, None], ["Spelling spelling", "spelling", "spellling speling", "speling spellling"]
    df = documents(spark, rows, ids=ids).withColumn("word", F.lit("x")).withColumn("n", F.lit(1)).withColumn("key", F.lit(1))
    for every in (None, 2):
        words = spelling.counted_words(df, drop_every=every)
        assert got(spelling.spelling_groups(words)) == brute(counted(zip(ids, rows), every))


def test_empty_table(spark):
    assert spelling.spelling_groups(spelling.counted_words(documents(spark, []))).collect() == []
    assert spelling.spelling_groups(spelling.counted_words(documents(spark, [None, "a b"]))).collect() == []


def test_counts_are_sent_before_they_fill_a_task(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_BYTES", 500)
    rows = list(enumerate(texts(20)))
    found = spelling.counted_words(documents(spark, [t for _, t in rows]))
    assert {r.word: r.n for r in found.collect()} == counted(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=4, max_size=14), st.integers(2, 3), st.data())
def test_pivots_are_the_cheapest_disjoint_choice(weights, wanted, data):
    from itertools import combinations

    places = sorted(data.draw(st.sets(st.integers(0, 20), min_size=len(weights), max_size=len(weights))))
    cost = dict(zip(places, weights))
    apart = [c for c in combinations(places, wanted) if all(b - a >= 2 for a, b in zip(c, c[1:]))]
    if apart:
        chosen = spelling.pivots(places, weights, wanted)
        assert tuple(chosen) in apart
        assert sum(cost[p] for p in chosen) == min(sum(cost[p] for p in c) for c in apart)
