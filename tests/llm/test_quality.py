"""Quality rules: measures against plain Python, rates and verdicts on made hosts."""

import re
from collections import Counter

from pyspark.sql import functions as F

from meteospark.llm import quality
from tests.llm.rows import corpus, documents, words


def plain(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = list(zip(found, found[1:], found[2:]))
    counts = Counter(windows)
    covered = {k for i, w in enumerate(windows) if counts[w] > 1 for k in (i, i + 1, i + 2)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (len(found), sum(map(len, found)), symbols, len(lines), len(lines) - len(set(lines)), len(covered))


def test_measures(spark):
    texts = corpus() + ["a a a a", "# * $ % & | < >", "x\nx\n\nx\n", "é è ê", "a b c a b c a"]
    got = quality.measured(documents(spark, texts)).orderBy("doc_id").collect()
    assert [tuple(r._measured) for r in got] == [plain(t) for t in texts]


def test_bad_hosts_face_strict_rules(spark):
    clean = lambda i: " ".join(words(120, i))
    marked = lambda i: " ".join(w + " #" for w in words(120, 500 + i))
    texts = [clean(i) for i in range(40)] + ["too short"] * 60 + [clean(90), marked(1)]
    sources = ["good"] * 40 + ["bad"] * 60 + ["bad", "bad"]
    texts += [marked(2)] + ["short"] + [clean(91)]
    sources += ["good", "tiny", None]
    docs = documents(spark, texts, sources).withColumn("n", F.lit("clash"))
    got = quality.judged(docs).orderBy("doc_id").collect()
    kept = {r.doc_id for r in got if r._kept}
    assert kept == set(range(40)) | {100, 102, 104}  # a clean one of the bad host stays, a marked one goes
    assert quality.keep_clean(docs).columns == docs.columns


def test_prior_shrinks_small_hosts(spark):
    rows = [("a", 1000, 100), ("b", 1000, 300), ("c", 1000, 200), ("d", 2, 2)]
    rates = spark.createDataFrame([(k, "r", n, f) for k, n, f in rows], "key string, rule string, n long, failed long")
    a, b = quality.prior(rates)["r"]
    shrunk = {k: (f + a) / (n + a + b) for k, n, f in rows}
    assert abs(shrunk["a"] - 0.1) < 0.01 and shrunk["d"] < 0.5 < 1.0


def test_awkward_tables(spark):
    assert quality.judged(documents(spark, [])).collect() == []
    got = quality.judged(documents(spark, [None, "", None], [None, None, "x"], [None, 1, 1])).collect()
    assert [r._kept for r in got] == [False] * 3


def test_host_of(spark):
    urls = ["https://www.A.example.com:80/x?y", "http://u@b.org/", "no url", None]
    got = spark.createDataFrame([(u,) for u in urls], "u string").select(quality.host_of(F.col("u")).alias("h")).collect()
    assert [r.h for r in got] == ["www.a.example.com", "b.org", None, None]
