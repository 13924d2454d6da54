"""Documents that the tests share."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()


def words(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]


def documents(spark, texts, sources=None, ids=None):
    """A documents table; ids 0, 1, ... unless given."""
    ids = list(range(len(texts))) if ids is None else ids
    sources = ["s"] * len(texts) if sources is None else sources
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources)]
    return spark.createDataFrame(rows, DOCS)


def awkward() -> list[str | None]:
    """Null, empty, blank, tiny, repeated and very long texts."""
    return [None, "", " \n\t", "one", "a b", "é" * 300, "x" * 60_000, " ".join(words(9_000, 5)), "one", None, "\x00" * 250 + "b"]


def corpus(n: int = 60, seed: int = 1) -> list[str | None]:
    """Texts with exact copies, near copies, shared passages and lines that repeat."""
    rng = random.Random(seed)
    passage = " ".join(words(70, 99))
    out: list[str | None] = []
    for i in range(n):
        kind = i % 6
        text = words(rng.randint(55, 260), seed * 1000 + i)
        if kind == 1 and out and out[-1]:
            out.append(out[-1])
            continue
        if kind == 2 and out and out[-1]:
            near = out[-1].split(" ")
            near[rng.randrange(len(near))] = "changed"
            out.append(" ".join(near))
            continue
        if kind == 3:
            text[20:20] = passage.split(" ")
        if kind == 4:
            text = text[:30] * 3
        if kind == 5:
            text[10] += "\nThis line repeats.\nThis line repeats.\n"
        out.append(" ".join(text))
    return out + awkward()
