"""The pipeline's stages, one after the other, against plain Python."""

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402
from tests.llm import test_jaccard_join, test_packing, test_quality, test_secrets  # noqa: E402
from tests.llm.rows import corpus, documents  # noqa: E402


def test_stages(spark, tmp_path):
    texts = corpus(72)
    texts[30] = (texts[30] or "") + " password=b7db7aa4a5fcc78305"
    sources = [f"s{min(i % 9, 2)}" for i in range(len(texts))]
    path = str(tmp_path / "documents.parquet")
    documents(spark, texts, sources).write.parquet(path)
    docs = spark.read.parquet(path)
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "best_fit_packing"

    quality = corpus_pipeline.quality_rules(spark, docs, str(tmp_path))
    kept = {}
    for i, text in enumerate(texts):
        n, *_, repeated = test_quality.plain(text)
        if n >= 50 and 100 * repeated <= 50 * n:
            kept[i] = text
    assert quality.columns == columns and {r.doc_id for r in quality.collect()} == set(kept)

    unique = corpus_pipeline.ngram_jaccard_join(spark, quality, str(tmp_path))
    order = sorted(kept)
    classes = test_jaccard_join.brute([kept[i] for i in order])
    firsts = {order[i] for i, c, *_ in classes if i == c}
    assert unique.columns == columns and sorted(r.doc_id for r in unique.collect()) == sorted(firsts)

    clean = corpus_pipeline.secret_scans(spark, unique, str(tmp_path)).collect()
    assert {r.doc_id for r in clean} == firsts
    assert all(test_secrets.brute(r.text) == [] for r in clean)

    clean = spark.createDataFrame(clean, docs.schema)
    mixed = corpus_pipeline.source_mixing(spark, clean, str(tmp_path))
    times = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert mixed.columns == columns and set(times) == firsts and 1 <= min(times.values()) <= max(times.values()) <= 2

    rows = corpus_pipeline.best_fit_packing(spark, mixed, str(tmp_path)).collect()
    assert test_packing.check_places(rows, 4096) == test_packing.plain_bins([r.length for r in rows], 4096)
    assert {r.doc_id for r in rows} == firsts

    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    key = lambda r: (r.doc_id, r.piece, r.ids_crc32)
    assert sorted(map(key, whole)) == sorted(map(key, rows))


CLASHES = "_text _key _bad _pass _cut _secret_spans _measured _kept _base_failed _near _stays _row_key key node pass block rows".split()


def test_stages_with_awkward_rows(spark):
    """Nulls in every column, repeated rows, rows of one id, and columns named as the stages name theirs."""
    texts, ids = corpus(24), list(range(24 + len(corpus(24)) - 24))
    rows = list(zip(ids, texts)) + [(None, texts[0]), (None, texts[0]), (3, texts[3]), (3, texts[3]), (3, texts[5]), (None, None)]
    docs = documents(spark, [t for _, t in rows], [None if k % 5 == 0 else f"s{k % 2}" for k in range(len(rows))], [i for i, _ in rows])
    docs = docs.withColumns({c: F.concat(F.lit(f"{c} "), F.coalesce("text", F.lit("-"))) for c in CLASHES})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r._text for r in docs.collect()}
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        kept = out.collect()
        assert kept and {r._text for r in kept} <= before, name
        for r in kept:
            plain = r._text[len("_text ") :]
            assert all(r[c] == f"{c} {plain}" for c in CLASHES), name
            assert name != "ngram_jaccard_join" or plain == (r.text or "-")
        if name == "ngram_jaccard_join":
            assert len({(r.doc_id, r.text) for r in kept}) == len(kept)
        docs = spark.createDataFrame(kept, docs.schema)
    pieces = corpus_pipeline.best_fit_packing(spark, docs, "").collect()
    assert len(pieces) >= docs.count()


def test_stages_with_an_empty_table(spark):
    docs = documents(spark, []).withColumn("_text", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.collect() == []
    assert corpus_pipeline.best_fit_packing(spark, docs, "").collect() == []
