"""Phrases that occur together more than their parts explain, by vertical partitioning of word suffixes.

The suffixes of all pieces, cut off after `max_words`, form a tree of word sequences. It is never built as a
whole:

1. word counts give the prefixes: a word, or, where that is more than a share of a group's memory, the word
   and the next one, and so on. Prefixes are dealt into groups whose suffixes fit the memory budget;
2. every chunk of text sorts its suffixes, folds equal ones into a leaf with a count and sends each group
   its leaves;
3. a group builds the subtrees of its prefixes level by level, on its own; a node's count is the sum of its
   leaves. Nodes above a long prefix get parts from several groups, which are added up.

Scores, the choice of cuts and the ranking are DataFrame operations on the nodes that occur often enough.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meteospark.llm.common import stored
from meteospark.llm.hashing import mixed
from meteospark.llm.tokens import Words, byte_map, numbered

#: Bytes of text in a chunk; leaves in a group; bytes of words a task counts; prefixes of more than one word.
CHUNK_BYTES, GROUP_LEAVES, HELD_BYTES, LONG_PREFIXES = 4 << 20, 1 << 20, 16 << 20, 1 << 16
#: Parts the candidates of a language are ranked in first.
_PARTS = 64
_MAP = byte_map(b"\t", b".,;:!?\n\x0b\x0c\r")
_SEEDS = (0x6C62272E, 0x07BB0142, 0x62B82175, 0x6295C58D)
_MESSAGE, _NODES = "group long, payload binary", "phrase array<long>, n long, part boolean"


def _slim(docs: DataFrame, text_column: str, lang_column: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit("und"))
    return docs.select(lang, F.col(text_column).cast("string"))


def _prepared(column: pa.Array) -> list[bytes]:
    return [(t or b"").translate(_MAP) for t in column.cast(pa.binary()).to_pylist()]


def word_counts(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """lang, word, n: all words of all pieces. Counts are added up in a task first, up to HELD_BYTES of words."""

    def rows(counts: dict[str, Counter]) -> pa.RecordBatch:
        langs = [lang for lang, c in counts.items() for _ in c]
        words = [w for c in counts.values() for w in c]
        sums = [n for c in counts.values() for n in c.values()]
        columns = [pa.array(langs, pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(sums, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        held = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), _prepared(batch.column(1))):
                found = Counter(text.split())
                mine = counts.setdefault(lang, Counter())
                held += sum(len(w) + 64 for w in found if w not in mine)
                mine.update(found)
                if held > HELD_BYTES:
                    yield rows(counts)
                    counts, held = {}, 0
        yield rows(counts)

    sums = _slim(docs, text_column, lang_column).mapInArrow(run, "lang string, word string, n long")
    return sums.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _lang_seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _hashes(words: Words, langs: list[str]) -> np.ndarray:
    """A hash of every word together with its text's language."""
    seeds = {lang: _lang_seed(lang) for lang in set(langs)}
    of_text = np.array([seeds[lang] for lang in langs], np.uint64)
    return mixed(words.hashes ^ np.repeat(of_text, words.counts))


def vocabulary(counts: DataFrame) -> tuple[DataFrame, int]:
    """lang, word, n and `h`, a number that no other word or language shares; and the seed of these numbers."""
    for seed in _SEEDS:

        def run(batches: Iterator[pa.RecordBatch], seed=seed) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                h = _hashes(Words(_prepared(batch.column("word")), seed), batch.column("lang").to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(h.view(np.int64))], [*batch.schema.names, "h"])

        named = stored(counts.mapInArrow(run, "lang string, word string, n long, h long"), f"vocabulary_{seed}")
        if not named.groupBy("h").count().where("count > 1").limit(1).count():
            return named, seed
    raise RuntimeError("words share hashes under every seed")


def _levels(columns: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each level of the tree below the first: the node of every row, and one row of each node.

    A column has a word's number at that depth, from 1; 0 where the piece is over.
    """
    node = columns[0]
    for column in columns[1:]:
        _, node = numbered(node * (int(column.max(initial=0)) + 1) + column)
        row = np.empty(int(node.max(initial=-1)) + 1, np.int64)
        row[node] = np.arange(len(node))
        yield node, row


def _suffixes(words: Words, numbers: np.ndarray, depth: int) -> list[np.ndarray]:
    """The words of each suffix as columns of numbers from 1; 0 behind the end of the piece."""
    out = [numbers + 1]
    for d in range(1, depth):
        column = np.zeros(len(numbers), np.int64)
        if d < len(numbers):
            same = words.piece[d:] == words.piece[:-d]
            column[:-d] = np.where(same, numbers[d:] + 1, 0)
        out.append(column)
    return out


def _groups(hashes: np.ndarray, hot: np.ndarray, columns: list[np.ndarray], groups: int) -> np.ndarray:
    """The group of each leaf: by its prefix, the words up to the first one that isn't hot."""
    by_number = np.concatenate([np.zeros(1, np.uint64), hashes])
    goes_on = np.concatenate([[False], np.isin(hashes, hot)])
    key = mixed(by_number[columns[0]])
    more = goes_on[columns[0]]
    for column in columns[1:]:
        key = np.where(more, mixed(key + by_number[column]), key)
        more &= goes_on[column]
    return (key % np.uint64(groups)).astype(np.int64)


def _pack(hashes: np.ndarray, columns: list[np.ndarray], counts: np.ndarray) -> bytes:
    """Leaves over their own small dictionary of word hashes."""
    used = np.unique(np.concatenate(columns))
    used = used[used > 0]
    kind = np.uint16 if len(used) < 0xFFFF else np.uint32
    place = np.zeros(len(hashes) + 1, kind)
    place[used] = np.arange(1, len(used) + 1)
    head = np.array([len(counts), len(used)], np.int64)
    parts = [head, hashes[used - 1], counts.astype(np.uint32), *[place[c] for c in columns]]
    return b"".join(p.tobytes() for p in parts)


def _unpack(data: bytes, depth: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    n, used = np.frombuffer(data, np.int64, 2).tolist()
    hashes = np.frombuffer(data, np.uint64, used, 16)
    counts = np.frombuffer(data, np.uint32, n, 16 + 8 * used)
    kind = np.uint16 if used < 0xFFFF else np.uint32
    flat = np.frombuffer(data, kind, depth * n, 16 + 8 * used + 4 * n)
    return hashes, counts, list(flat.reshape(depth, n))


def _leaves(texts: list[bytes], langs: list[str], depth: int, seed: int, hot: np.ndarray, groups: int) -> pa.RecordBatch:
    """What one chunk sends: for each group its distinct cut-off suffixes and how often they occur."""
    words = Words(texts, seed)
    hashes, numbers = numbered(_hashes(words, langs))
    columns = _suffixes(words, numbers, depth)
    del words, numbers
    *_, (node, row) = _levels(columns)
    row, counts = row[columns[1][row] > 0], np.bincount(node, minlength=len(row))[columns[1][row] > 0]
    columns = [c[row] for c in columns]
    del node, row
    group = _groups(hashes, hot, columns, groups)
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[order], prepend=-1))
    names, payloads = [], []
    for at in np.split(order, cuts[1:]) if len(order) else []:
        names.append(int(group[at[0]]))
        payloads.append(_pack(hashes, [c[at] for c in columns], counts[at]))
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(payloads, pa.binary())], ["group", "payload"])


def _subtrees(depth: int, hot: np.ndarray, min_count: int):
    """Builds a group's subtrees and returns the nodes that occur often enough, or whose count is a part."""

    def run(table: pa.Table) -> pa.Table:
        parts = [_unpack(p, depth) for p in table["payload"].to_pylist()]
        hashes, place = numbered(np.concatenate([p[0] for p in parts]))
        columns = [np.empty(sum(len(p[1]) for p in parts), np.int64) for _ in range(depth)]
        at = begin = 0
        for own, counts, local in parts:
            to = np.concatenate([np.zeros(1, np.int64), place[begin : begin + len(own)] + 1])
            begin += len(own)
            for column, c in zip(columns, local):
                column[at : at + len(counts)] = to[c]
            at += len(counts)
        counts = np.concatenate([p[1] for p in parts]).astype(np.float64)
        del parts
        is_hot = np.concatenate([[False], np.isin(hashes, hot)])
        above = is_hot[columns[0]]
        phrases, sums, flags = [], [], []
        for d, (node, row) in enumerate(_levels(columns), 2):
            n = np.bincount(node, counts, len(row)).astype(np.int64)  # exact below 2^53
            above &= is_hot[columns[d - 1]]
            part = above[row] & (d < depth)
            keep = (columns[d - 1][row] > 0) & (part | (n >= min_count))
            paths = np.stack([hashes[c[row[keep]] - 1] for c in columns[:d]], 1).view(np.int64)
            phrases += list(paths)
            sums.append(n[keep])
            flags.append(part[keep])
        return pa.table(
            [pa.array(phrases, pa.list_(pa.int64())), pa.array(np.concatenate(sums)), pa.array(np.concatenate(flags))],
            names=["phrase", "n", "part"],
        )

    return run


def phrase_counts(
    docs: DataFrame,
    words: DataFrame,
    seed: int,
    max_words: int = 3,
    min_count: int = 10,
    text_column: str = "text",
    lang_column: str = "lang",
    group_leaves: int = GROUP_LEAVES,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """phrase (word numbers `h` of the vocabulary), n: all phrases of 2 to max_words words that occur min_count times."""
    total = words.agg(F.sum("n")).first()[0] or 0
    groups = total // group_leaves + 1
    # a prefix fills an eighth of a group at most, unless so few words would make too long a list
    most = max(group_leaves // 8, total // LONG_PREFIXES)
    hot = [r.h for r in words.where(F.col("n") > most).select("h").collect()]  # at most LONG_PREFIXES
    hot = np.sort(np.array(hot, np.int64).view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, langs, size = [], [], 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), _prepared(batch.column(1))):
                texts.append(text)
                langs.append(lang)
                size += len(text)
                if size > chunk_bytes:
                    yield _leaves(texts, langs, max_words, seed, hot, groups)
                    texts, langs, size = [], [], 0
        if texts:
            yield _leaves(texts, langs, max_words, seed, hot, groups)

    sent = _slim(docs, text_column, lang_column).mapInArrow(run, _MESSAGE)
    nodes = stored(sent.groupBy("group").applyInArrow(_subtrees(max_words, hot, min_count), _NODES), "nodes")
    parts = nodes.where("part").groupBy("phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    return nodes.where("NOT part").select("phrase", "n").unionByName(parts)


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(15,0)")


def scored(found: DataFrame, words: DataFrame, million: int = 1_000_000) -> DataFrame:
    """phrase, a, lang, l, r, score: of every phrase the cut of the lowest score, ties to the earliest.

    The score floor(million * a * a / (l * r)) is exact for counts below 10^15.
    """
    counts = found.select("phrase", "n", F.lit(None).cast("string").alias("lang")).unionByName(
        words.select(F.array("h").alias("phrase"), "n", "lang")
    )
    cuts = found.select("phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("phrase", 1, F.col("k")).alias("left"), F.slice("phrase", F.col("k") + 1, F.size("phrase")).alias("right"))
    # a word in many phrases makes these joins uneven; adaptive execution splits its rows
    side = lambda s, n, *c: counts.select(F.col("phrase").alias(s), F.col("n").alias(n), *c)
    cuts = cuts.join(side("left", "l", "lang"), "left").join(side("right", "r"), "right")
    product = F.lit(million).cast("decimal(7,0)") * (_exact("a") * _exact("a"))
    score = F.call_function("div", product, _exact("l") * _exact("r"))
    cuts = cuts.select("phrase", "a", "lang", F.struct(score.cast("long").alias("score"), "k", "l", "r").alias("cut"))
    best = cuts.groupBy("phrase", "a").agg(F.max("lang").alias("lang"), F.min("cut").alias("cut"))
    return best.select("phrase", "a", "lang", "cut.l", "cut.r", "cut.score")


def not_inside(found: DataFrame, share: int = 50) -> DataFrame:
    """The phrases that lie in no longer one with `share` percent of their occurrences or more."""
    d = F.size("phrase")
    shorter = F.flatten(
        F.transform(
            F.sequence(F.lit(2), d - 1),
            lambda w: F.transform(F.sequence(F.lit(1), d - w + 1), lambda i: F.slice("phrase", i, w)),
        )
    )
    longest = found.where(d > 2).select(F.explode(shorter).alias("phrase"), F.col("n").alias("longer"))
    longest = longest.groupBy("phrase").agg(F.max("longer").alias("longer"))
    kept = found.join(longest, "phrase", "left")
    return kept.where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("n"))).drop("longer")


def collocations(
    docs: DataFrame,
    max_words: int = 3,
    min_count: int = 10,
    top: int = 2000,
    share: int = 50,
    text_column: str = "text",
    lang_column: str = "lang",
    group_leaves: int = GROUP_LEAVES,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases of 2 to max_words words.

    Texts are lower-cased (A-Z), parted into pieces at `.,;:!?` and line ends, and into words at blanks and
    tabs. a, l, r: occurrences of the phrase and of both sides of its cut, n: of all words of the language.
    Order: score, a, both falling, then the phrase by its bytes. Null texts count as empty, a null language
    as `und`, repeated rows each count, empty tables give no rows, other columns aren't read. A very long
    text makes a chunk of its own; a very long word is a word.
    """
    words, seed = vocabulary(word_counts(docs, text_column, lang_column))
    found = phrase_counts(docs, words, seed, max_words, min_count, text_column, lang_column, group_leaves, chunk_bytes)
    judged = scored(found, words).join(not_inside(found, share).select("phrase"), "phrase", "left_semi")
    order = [F.col("score").desc(), F.col("a").desc()]
    part = F.pmod(F.xxhash64("phrase"), F.lit(_PARTS)).alias("_part")
    first = judged.select("*", part).withColumn("_rank", F.rank().over(Window.partitionBy("lang", "_part").orderBy(*order)))
    first = first.where(F.col("_rank") <= top).withColumn("_rank", F.rank().over(Window.partitionBy("lang").orderBy(*order)))
    first = stored(first.where(F.col("_rank") <= top).drop("_part", "_rank"), "ranked")
    spelled = first.select("phrase", F.posexplode("phrase").alias("i", "h")).join(words.select("h", "word"), "h")
    spelled = spelled.groupBy("phrase").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda s: s["word"]), " ").alias("_text")
    )
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "_text")).alias("rank")
    rows = first.join(spelled, "phrase").join(totals, "lang")
    rows = rows.select("lang", rank, F.col("_text").alias("phrase"), "a", "l", "r", "n", "score")
    return rows.where(F.col("rank") <= top)
