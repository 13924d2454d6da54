"""Near copies: classes and link counts against all pairs."""

import re
import uuid
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from meteospark.llm import jaccard_join
from meteospark.llm.components import components
from meteospark.llm.jaccard_join import choose_bands, jaccard_classes, one_of_each, overlaps
from tests.llm.rows import corpus, documents


def grams(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if not words:
        return frozenset()
    return frozenset(tuple(words[p : p + n]) for p in range(max(1, len(words) - n + 1)))


def brute(texts, threshold=Fraction(4, 5)):
    sets = [grams(t) for t in texts]
    linked = {
        i: [j for j in range(len(sets)) if i != j and sets[i] and sets[j]
            and Fraction(len(sets[i] & sets[j]), len(sets[i] | sets[j])) >= threshold]
        for i in range(len(sets))
    }
    out = []
    for i in linked:
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.append((i, min(seen), len(linked[i]), len({sets[j] for j in linked[i]} - {sets[i]})))
    return out


def near_pairs(n):
    return [" ".join([f"p{i}w{k}" for k in range(40)] + end) for i in range(n) for end in ([], ["end"])]


def test_equals_all_pairs(spark):
    texts = corpus(90)
    got = jaccard_classes(documents(spark, texts)).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == brute(texts)


def test_large_group_in_several_cells(spark):
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(600):  # each is like all others: three cells a side
        changed = list(base)
        changed[i % 120] = f"x{i}"
        texts.append(" ".join(changed))
    got = jaccard_classes(documents(spark, texts)).collect()
    assert {r.class_id for r in got} == {0}
    assert sorted((r.doc_id, r.n_links) for r in got) == [(i, n) for i, _, n, _ in brute(texts)]


def test_verify_groups_hold_one_cell_of_a_large_cluster(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SIDE_SETS", 16)
    monkeypatch.setattr(jaccard_join, "TASK_ROWS", 64)
    verify, folder = jaccard_join._verify, str(tmp_path)

    def watched(threshold):
        run = verify(threshold)

        def noted(table):
            with open(f"{folder}/{uuid.uuid4()}", "w") as f:
                f.write(str(table.num_rows))
            return run(table)

        return noted

    monkeypatch.setattr(jaccard_join, "_verify", watched)
    texts = []
    for i in range(300):  # one cluster of 19 parts, and 100 pairs that share groups
        texts.append(" ".join(f"x{i}" if k == i % 120 else f"w{k}" for k in range(120)))
    for i in range(100):
        texts += [" ".join([f"p{i}w{k}" for k in range(40)] + end) for end in ([], ["end"])]
    got = jaccard_classes(documents(spark, texts)).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == brute(texts)
    rows = [int(p.read_text()) for p in tmp_path.iterdir()]
    assert sum(rows) == 300 * 19 + 200
    assert max(rows) <= 4 * 64


def test_rows_that_share_an_id_meet_one_node_each(spark, monkeypatch):
    joined, with_sets = [], jaccard_join._with_sets

    def watched(docs, n):
        joined.append(docs.count())
        return with_sets(docs, n)

    monkeypatch.setattr(jaccard_join, "_with_sets", watched)
    texts = near_pairs(20) + near_pairs(1) * 15
    for one in (None, 4):
        got = jaccard_classes(documents(spark, texts, ids=[one] * len(texts))).collect()
        assert sorted((r.n_links, r.n_text_links) for r in got) == sorted(r[2:] for r in brute(texts))
        assert {r.class_id for r in got} == {one}
    assert joined == [40, 40]


def test_one_of_each(spark):
    texts = corpus(60)
    ids = list(range(len(texts)))
    docs = documents(spark, texts + [texts[0], None], ids=ids + [0, None]).withColumn("node", F.lit("clash"))
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    want = sorted(i for i, c, *_ in brute(texts) if i == c)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == want


def test_one_of_each_judges_rows_by_their_text(spark):
    (a, a2, b, b2, c, c2, d, d2), other = near_pairs(4), " ".join(f"o{i}" for i in range(30))
    rows = [(1, a), (5, a2), (5, other), (2, b), (2, b2), (None, c), (None, c2), (None, d), (9, d2), (None, ""), (7, "")]
    kept = one_of_each(documents(spark, [t for _, t in rows], ids=[i for i, _ in rows])).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "2", "5", "7", "9", "None", "None"]
    assert {r.text for r in kept if r.doc_id in (1, 5, 9)} == {a, other, d2}
    assert {r.text for r in kept if r.doc_id is None} in ({"", c}, {"", c2})


def test_null_ids_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(20))
    got = jaccard_classes(documents(spark, [text, text, "x", None], ids=[None, 4, None, None])).collect()
    assert sorted(map(str, got)) == sorted(
        str(r)
        for r in [
            type(got[0])(doc_id=None, class_id=4, n_links=1, n_text_links=0),
            type(got[0])(doc_id=4, class_id=4, n_links=1, n_text_links=0),
            type(got[0])(doc_id=None, class_id=None, n_links=0, n_text_links=0),
            type(got[0])(doc_id=None, class_id=None, n_links=0, n_text_links=0),
        ]
    )
    assert jaccard_classes(documents(spark, [])).collect() == []
    assert one_of_each(documents(spark, [])).collect() == []


def test_bands_reach_the_recall():
    bands, rows = choose_bands(0.8, 0.99999)
    assert bands * rows <= 256 and 1 - (1 - 0.8**rows) ** bands >= 0.99999


def test_overlaps_and_components(spark):
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))).astype(np.uint64) for _ in range(9)]
    want = [[len(np.intersect1d(a, b)) for b in sets[4:]] for a in sets[:4]]
    assert overlaps(sets[:4], sets[4:]).tolist() == want
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {i: 0 for i in range(41)} | {100: 100, 101: 100}
