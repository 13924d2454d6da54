"""Byte strings: the operator and its index against plain search."""

import hashlib
import random

import numpy as np
import pytest

from meteospark.llm.run_index import RunIndex
from meteospark.llm.suffix_dedup import remove_repeated_bytes
from tests.llm.rows import corpus, documents

LAST = 2**63


def brute(rows, n):
    first = {}
    data = [(LAST if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in data:
        for p in range(len(t) - n + 1):
            key = t[p : p + n]
            first[key] = min(first.get(key, (i, p)), (i, p))
    out = []
    for (raw, _), (i, t) in zip(rows, data):
        gone = bytearray(len(t))
        for p in range(len(t) - n + 1):
            if first[t[p : p + n]] < (i, p):
                gone[p : p + n] = b"\1" * n
        runs = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((raw, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk_bytes, hot", [(1 << 23, 4_096), (5_000, 4_096), (5_000, 3)])
def test_equals_brute_force(spark, chunk_bytes, hot):
    texts = corpus()
    got = remove_repeated_bytes(documents(spark, texts), chunk_bytes=chunk_bytes, hot=hot).collect()
    assert sorted(map(tuple, got), key=str) == brute(list(enumerate(texts)), 100)


def test_null_and_repeated_ids(spark):
    line = "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf in the dark forest of night "
    ids = [None, 1, 1, 2, 4, 4, None, 5, None]
    texts = [line * 3, line * 2, line * 2, None, "a" * 500, "a" * 500, "a" * 300, "é" * 400, None]
    got = remove_repeated_bytes(documents(spark, texts, ids=ids), chunk_bytes=700, hot=5).collect()
    assert sorted(map(tuple, got), key=str) == brute(list(zip(ids, texts)), 100)


def test_kept_bytes_and_empty_table(spark):
    line = "".join(chr(97 + i % 26) + str(i) for i in range(80))
    rows = remove_repeated_bytes(documents(spark, [line, "x" + line + "y"]), with_bytes=True).orderBy("doc_id").collect()
    assert [bytes(r.kept) for r in rows] == [line.encode(), b"xy"]
    assert remove_repeated_bytes(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        remove_repeated_bytes(documents(spark, []), window=20)


def test_matching_statistics():
    rng = random.Random(3)
    for _ in range(60):
        strings, groups, asked, of = [], [], [], []
        for g in range(rng.randint(1, 5)):
            alphabet = bytes(rng.sample(range(250), rng.randint(1, 4)))
            base = bytes(rng.choices(alphabet, k=30))
            for k in range(rng.randint(1, 8)):
                s = bytearray(base[rng.randint(0, 5) : rng.randint(10, 30)])
                s[rng.randrange(len(s))] = rng.choice(alphabet + b"z")
                (strings, asked)[k % 2].append(bytes(s))
                (groups, of)[k % 2].append(g)
        if not asked:
            continue
        found = RunIndex(strings, np.array(groups)).matching_statistics(asked, np.array(of))
        for string, g, row in zip(asked, of, found):
            texts = [s for s, h in zip(strings, groups) if h == g]
            for i in range(len(string)):
                longest = max(n for n in range(len(string) - i + 1) if any(string[i : i + n] in t for t in texts))
                assert row[found.shape[1] - len(string) + i] == longest
