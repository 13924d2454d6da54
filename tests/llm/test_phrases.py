"""Collocations: the operator against plain counts of all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from meteospark.llm import phrases
from meteospark.llm.hashing import mixed
from tests.llm.rows import DOCS, awkward, words

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, m=3, min_count=10, top=2000, share=50):
    count, total = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for d in range(1, m + 1):
                count.update((lang, *w[k : k + d]) for k in range(len(w) - d + 1))
    longer = Counter()
    for key, a in count.items():
        if a >= min_count:
            w = key[1:]
            for d in range(2, len(w)):
                for k in range(len(w) - d + 1):
                    sub = (key[0], *w[k : k + d])
                    longer[sub] = max(longer[sub], a)
    out = []
    for (lang, *w), a in count.items():
        if len(w) < 2 or a < min_count or (longer[(lang, *w)] and 100 * longer[(lang, *w)] >= share * a):
            continue
        cuts = []
        for k in range(1, len(w)):
            lhs, rhs = count[(lang, *w[:k])], count[(lang, *w[k:])]
            cuts.append((1_000_000 * a * a // (lhs * rhs), k, lhs, rhs))
        score, _, lhs, rhs = min(cuts)
        out.append((lang, -score, -a, " ".join(w).encode(), lhs, rhs))
    found, rank = [], Counter()
    for lang, score, a, phrase, lhs, rhs in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            found.append((lang, rank[lang], phrase.decode(), -a, lhs, rhs, total[lang], -score))
    return found


def texts(n, seed):
    rng = random.Random(seed)
    common = words(25, seed)
    out = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randint(5, 60)):
            text += rng.choice(common if rng.random() < 0.8 else ["Of the", "in the end", "é à", "x"])
            text += rng.choice([" "] * 12 + ["\t", ". ", ",", "\n", "; ", "  ", " ? "])
        out.append(text)
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, (lang, t) in enumerate(rows)], DOCS)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[1]))


CORPUS = [(["en", "fr", None, "und"][i % 4], t) for i, t in enumerate(texts(120, 1) + awkward() + texts(1, 2) * 30)]


@pytest.mark.parametrize(
    "m, least, top, leaves, chunk",
    [(3, 10, 2000, 4 << 20, 8 << 20), (3, 3, 40, 500, 2_000), (4, 3, 2000, 100, 5_000), (2, 10, 5, 2_000, 1_000)],
)
def test_equals_brute_force(spark, m, least, top, leaves, chunk):
    df = phrases.collocations(table(spark, CORPUS), m, least, top, group_leaves=leaves, chunk_bytes=chunk)
    want = brute(CORPUS, m, least, top)
    assert len(want) > 10 and got(df) == want


def test_hot_prefixes_are_dealt_over_groups(spark, monkeypatch):
    """Two words make up half of the text, so their prefixes grow to full depth and counts come in parts."""
    rng = random.Random(4)
    rows = [("en", " ".join(rng.choices(["aa", "bb", *words(30, 3)], [30, 30, *[2] * 30], k=400))) for _ in range(40)]
    monkeypatch.setattr(phrases, "LONG_PREFIXES", 20)
    df = phrases.collocations(table(spark, rows), 3, 5, group_leaves=300, chunk_bytes=20_000)
    assert got(df) == brute(rows, 3, 5)


def test_a_third_of_the_corpus_is_one_row(spark):
    rows = [("en", "so it goes, so it goes")] * 60 + CORPUS
    df = table(spark, rows).withColumn("group", F.lit(1)).withColumn("phrase", F.lit("x"))
    assert got(phrases.collocations(df, chunk_bytes=4_000)) == brute(rows)


def test_empty_table(spark):
    assert phrases.collocations(table(spark, [])).collect() == []


def test_words_that_share_a_hash_get_another_seed(spark, monkeypatch):
    counts = spark.createDataFrame([("en", f"w{i}", 5) for i in range(50)], "lang string, word string, n long")
    assert phrases.vocabulary(counts)[1] == phrases._SEEDS[0]
    real = phrases._hashes
    bad = phrases._SEEDS[0]

    class Bad(phrases.Words):
        def _hashes(self, seed):
            found = super()._hashes(seed)
            return np.zeros_like(found) if seed == bad else found

    monkeypatch.setattr(phrases, "Words", Bad)
    assert real is phrases._hashes
    named, seed = phrases.vocabulary(counts)
    assert seed == phrases._SEEDS[1] and named.select("h").distinct().count() == 50


def test_scores_are_exact_beyond_64_bits(spark):
    h = [int(x) for x in mixed(np.arange(1, 4, dtype=np.uint64)).view(np.int64)]
    n = [3 * 10**14 + 7, 2 * 10**14 + 1, 10**14 + 9]
    a2, b2, a3 = 10**14 - 1, 10**14 + 3, 10**13 + 11
    counts = spark.createDataFrame([("en", f"w{i}", c, x) for i, (c, x) in enumerate(zip(n, h))], "lang string, word string, n long, h long")
    rows = [([h[0], h[1]], a2), ([h[1], h[2]], b2), (h, a3)]
    found = spark.createDataFrame(rows, "phrase array<long>, n long")
    got = {len(r.phrase): (r.score, r.l, r.r) for r in phrases.scored(found, counts).collect() if r.a != b2}
    cuts = [(10**6 * a3 * a3 // (x * y), x, y) for x, y in ((n[0], b2), (a2, n[2]))]
    assert got == {2: (10**6 * a2 * a2 // (n[0] * n[1]), n[0], n[1]), 3: min(cuts)}
