"""Packing against plain best-fit decreasing, and pieces against whole texts."""

import bisect
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from meteospark.llm.packing import _WordIds, RoomTree, best_fit_decreasing, packed, packed_documents, token_pieces
from tests.llm.rows import corpus, documents

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")


def plain_bins(lengths, capacity):
    rooms, bins = [], 0
    for length in sorted(lengths, reverse=True):
        i = bisect.bisect_left(rooms, length)
        if i == len(rooms):
            bins, room = bins + 1, capacity
        else:
            room = rooms.pop(i)
        bisect.insort(rooms, room - length)
    return bins


def check_places(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("capacity", [10, 64, 4096])
def test_steps_equal_plain_best_fit(capacity):
    rng = random.Random(capacity)
    for _ in range(40):
        lengths = [min(capacity, 1 + int(rng.expovariate(4 / capacity))) for _ in range(rng.randint(1, 400))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        steps = best_fit_decreasing(counts, capacity)
        bins = {}
        for length, first, after, per_bin, start, offset in steps:
            for rank in range(first, after):
                b, k = divmod(rank - first, per_bin)
                bins.setdefault(start + b, []).append((offset + k * length, length))
        assert sum(len(b) for b in bins.values()) == len(lengths)
        for placed in bins.values():
            at = 0
            for offset, length in sorted(placed):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(bins) == plain_bins(lengths, capacity)


def test_room_tree():
    tree, rng, rooms = RoomTree(100), random.Random(1), set()
    for _ in range(3000):
        room = rng.randint(0, 100)
        tree.put(room, room not in rooms)
        rooms ^= {room}
        asked = rng.randint(0, 100)
        assert tree.tightest(asked) == min((r for r in rooms if r >= asked), default=None)


def test_pieces_equal_the_tokenizer(spark):
    texts = corpus(40) + ["<|endoftext|> It's L'Été́ don't 123", "ΣΣ ﬁ x İ'LL\r\nß", "'s'S --'s a'b"]
    tok = tokenizers.Tokenizer.from_file(PATH)
    got = {(r.doc_id, r.piece): r for r in token_pieces(documents(spark, texts), PATH, 256, with_ids=True).collect()}
    want = 0
    for i, text in enumerate(texts):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 256)):
            part, r = ids[at : at + 256], got[i, piece]
            assert (r.start, r.length, list(r.ids)) == (at, len(part), part)
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            want += 1
    assert len(got) == want


def test_words_at_once_equal_the_tokenizer():
    rng = random.Random(3)
    signs = "abzstremvdAZ\u00c0\u00de\u00df\u00e9\u00ff\u00d7\u00f7019'\"-|<>._,~!\u0301\u03a3\u0130\t\u00a0\u4e2d"
    words = {"".join(rng.choices(signs, k=rng.randint(0, 9))) for _ in range(4000)}
    words = [*words, "<|endoftext|>", "<|ENDOFTEXT|>", "'s's", "--'s", "a'street", "x" * 300, "\u00e9'Ll" * 50]
    known, tok = _WordIds(PATH), tokenizers.Tokenizer.from_file(PATH)
    want = [np.array(tok.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]
    for _ in range(2):
        assert known.of(pa.array(words, pa.large_string())) == want
    assert known.of(pa.array([], pa.large_string())) == []
    known.cut = False
    assert known.of(pa.array(words[:50], pa.large_string())) == want[:50]


def test_plain_words_need_no_normalising(monkeypatch):
    """They are cut here and go to the model, so only other words pass through the whole tokenizer."""
    known, seen = _WordIds(PATH), []
    whole = known._whole
    monkeypatch.setattr(known, "_whole", lambda word: seen.append(word) or whole(word))
    known.of(pa.array(["Don't", "\u00c9t\u00e9,", "", "a1b2", "\u4e2d", "<|endoftext|>"], pa.large_string()))
    assert seen == ["\u4e2d", "<|endoftext|>"]


def test_remembered_words_stay_few(monkeypatch):
    """However many distinct words come at once, the tables hold two times the limit, and nothing after a task."""
    monkeypatch.setattr("meteospark.llm.packing._REMEMBERED", 50)
    known = _WordIds(PATH)
    known.of(pa.array([f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(500)], pa.large_string()))
    assert len(known.young) <= 50 and len(known.old) <= 50
    known.rest()
    assert not known.young and not known.old


def test_documents_fill_few_sequences(spark):
    texts = corpus(60)
    rows = packed_documents(documents(spark, texts), PATH, 128).collect()
    lengths = [r.length for r in rows]
    assert check_places(rows, 128) == plain_bins(lengths, 128)


def test_null_and_repeated_ids_and_empty_table(spark):
    docs = documents(spark, ["a b", "a b", None, "a b"], ids=[1, 1, None, 2])
    rows = packed_documents(docs, PATH, 8).collect()
    assert len(rows) == 4 and check_places(rows, 8) == 2
    assert packed_documents(documents(spark, []), PATH).collect() == []
    extra = token_pieces(docs, PATH).selectExpr("*", "'x' AS other")
    assert "other" in packed(extra).columns
