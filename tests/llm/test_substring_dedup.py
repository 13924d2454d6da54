"""Word windows: the operator against a plain count of all windows."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from meteospark.llm import hashing
from meteospark.llm.substring_dedup import remove_repeated_windows
from tests.llm.rows import corpus, documents, words

LAST = 2**63


def brute(rows, n):
    found = {}
    cut = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    for (i, _), words in zip(rows, cut):
        i = LAST if i is None else i
        for p in range(len(words) - n + 1):
            key = tuple(words[p : p + n])
            found[key] = min(found.get(key, i), i)
    out = []
    for (i, _), words in zip(rows, cut):
        gone = set()
        for p in range(len(words) - n + 1):
            if found[tuple(words[p : p + n])] < (LAST if i is None else i):
                gone |= set(range(p, p + n))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("n, chunk_bytes", [(50, 1 << 23), (50, 4_000), (7, 20_000)])
def test_equals_brute_force(spark, n, chunk_bytes):
    texts = corpus()
    df = documents(spark, texts)
    got = remove_repeated_windows(df, n, with_text=True, chunk_bytes=chunk_bytes).collect()
    assert sorted(map(tuple, got), key=str) == brute(list(enumerate(texts)), n)


def test_null_and_repeated_ids_and_other_columns(spark):
    text = " ".join(f"w{i}" for i in range(80))
    ids, texts = [None, 1, 1, 2, None], [text, text, text, text + " more", "short"]
    df = documents(spark, texts, ids=ids).withColumn("chunk", F.lit("x")).withColumn("payload", F.lit(1))
    got = remove_repeated_windows(df, 50, with_text=True).collect()
    assert sorted(map(tuple, got), key=str) == brute(list(zip(ids, texts)), 50)


def test_empty_table(spark):
    assert remove_repeated_windows(documents(spark, [])).collect() == []


def test_sorted_numbers_survive_encoding():
    import numpy as np

    values = np.array([0, 1, 2, 65_534, 65_535, 65_536, 200_000, 10**7, 10**7 + 65_535 * 3])
    assert hashing.decode_sorted(hashing.encode_sorted(values)).tolist() == values.tolist()
    assert len(hashing.decode_sorted(hashing.encode_sorted(values[:0]))) == 0


def test_word_hashes_follow_words():
    texts = [b" a  bb\tccc\n" + b"d" * 40, b"", b"bb", b"a" + b"d" * 40]
    (hashes,), counts = hashing.word_hashes(texts, (7,))
    assert counts.tolist() == [4, 0, 1, 1]
    assert hashes[1] == hashes[4] and len(set(hashes.tolist())) == 5


@pytest.mark.parametrize("bits", [24, 40, 41, 47, 60])
def test_cells_of_large_sketches(bits):
    """Whatever the width of a cell: every cell once, sorted, and whether two documents touch it."""
    import numpy as np

    from meteospark.llm.substring_dedup import _ROWS, _blocks, _cells

    rng = np.random.default_rng(bits)
    windows = rng.integers(0, 1 << 64, 3_000, dtype=np.uint64)
    windows = np.concatenate([windows, windows[:700], windows[:300]])
    owners = np.concatenate([np.arange(3_000) % 90, np.full(700, 5), np.arange(300) % 90]).astype(np.int32)
    for row in range(2):
        cells, several = _cells(windows, owners, row, bits)
        docs = {}
        for cell, owner in zip(((windows * _ROWS[row]) >> np.uint64(64 - bits)).tolist(), owners.tolist()):
            docs.setdefault(cell, set()).add(owner)
        assert cells.tolist() == sorted(docs)
        assert several.tolist() == [len(docs[c]) > 1 for c in cells.tolist()]
        parts = _blocks(cells)
        assert [b for b, _ in parts] == sorted({c >> 24 for c in docs}) and len(parts) <= len(cells)
        assert np.concatenate([cells[p] for _, p in parts]).tolist() == cells.tolist()


def test_many_equal_rows_are_one_row_of_a_chunk(spark):
    """A third of all rows is one row, another third has neither id nor text; results have them all."""
    from meteospark.llm import substring_dedup

    text = " ".join(words(90, 7))
    rows = [(7, text)] * 60 + [(None, None)] * 60 + [(None, text)] * 3 + [(i, " ".join(words(70, i))) for i in range(20, 80)]
    docs = documents(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    chunked, _ = substring_dedup.dealt_chunks(docs, "doc_id", "text", 2_000)
    held = chunked.groupBy("chunk").count().collect()
    assert max(r["count"] for r in held) < 30 and chunked.agg(F.sum("copies")).first()[0] == len(rows)
    got = remove_repeated_windows(docs, 50, with_text=True, chunk_bytes=2_000).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 50)


def test_sizes_follow_the_corpus():
    from meteospark.llm.substring_dedup import sized_chunks

    assert sized_chunks(10**9) == (8 << 20, 24) and sized_chunks(10**14) == (64 << 20, 27)
