"""Quality rules per document and per host, with rates shrunk by an empirical beta prior."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meteospark.llm.common import fresh, group_key, stored

_WHITE = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
FIELDS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

#: Rules on a measured document: base rules fail it; the others count against its host.
BASE = {
    "short": "{m}.n_words < 50",
    "repetitive": "100 * {m}.n_repeat_words > 50 * {m}.n_words",
}
STRICT = {
    "symbols": "10 * {m}.n_symbols > {m}.word_chars",
    "dup_lines": "100 * {m}.n_dup_lines > 30 * {m}.n_lines",
    "half_repetitive": "100 * {m}.n_repeat_words > 25 * {m}.n_words",
}
#: A host is bad when its shrunk rate of some rule is above this.
MAX_RATE = 0.5


def repeated_words(words: list[bytes]) -> int:
    """Words covered by three-word windows that occur at least twice in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered = end = 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def measure(text: str | None) -> tuple[int, ...]:
    """The FIELDS of one whole text (null: empty)."""
    raw = (text or "").encode()
    words = raw.split()
    white = len(raw) - len(raw.translate(None, _WHITE))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text or "") - white,
        len(raw) - len(raw.translate(None, _SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def measured(docs: DataFrame, text_column: str = "text", out: str = "_measured") -> DataFrame:
    """Adds the struct column `out` with FIELDS; all other columns are passed on as they are."""
    at = docs.columns.index(text_column)
    kind = pa.struct([(f, pa.int64()) for f in FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(t.as_py()) for t in batch.column(at)]
            columns = [pa.array(c, pa.int64()) for c in zip(*found)] if found else [pa.array([], pa.int64())] * len(FIELDS)
            column = pa.StructArray.from_arrays(columns, fields=list(kind))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, out])

    fields = T.StructType([T.StructField(f, T.LongType()) for f in FIELDS])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, fields)]))


def base_failed(m: str = "_measured") -> Column:
    return F.expr(" OR ".join(f"({rule})" for rule in BASE.values()).format(m=m))


def strict_failed(m: str = "_measured") -> Column:
    return F.expr(" OR ".join(f"({rule})" for rule in STRICT.values()).format(m=m))


def host_of(url: Column) -> Column:
    """The lower-case host of a URL; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def prior(rates: DataFrame) -> dict[str, tuple[float, float]]:
    """Per rule the beta prior (a, b) by moments over hosts (key, rule, n, failed).

    The variance between hosts is what remains after taking off the binomial noise. Where nothing
    remains, hosts don't differ and the prior gets a strength no host's count overrules.
    """
    p = F.sum("failed") / F.sum("n")
    means = rates.groupBy("rule").agg(p.alias("p"), F.sum("n").alias("all_n"))
    spread = (
        rates.join(means, "rule")
        .groupBy("rule")
        .agg(
            F.first("p").alias("p"),
            F.first("all_n").alias("all_n"),
            F.count("*").alias("hosts"),
            F.sum(F.col("n") * F.pow(F.col("failed") / F.col("n") - F.col("p"), 2)).alias("ss"),
            F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
        )
    )
    found = {}
    for r in spread.collect():  # one row per rule
        noise = r.p * (1 - r.p)
        room = r.all_n - r.nn / r.all_n
        between = (r.ss - (r.hosts - 1) * noise) / room if room > 0 else 0.0
        strength = noise / between - 1 if between > 0 else float(r.all_n) * 1e6
        strength = max(strength, 1.0)
        found[r.rule] = (r.p * strength, (1 - r.p) * strength)
    return found


def host_verdicts(flagged: DataFrame, key: str, rules: list[str]) -> DataFrame:
    """One row per host (`key`) with its rows and shrunk rates, and `bad`.

    flagged: the key and one boolean column per rule. Failures are summed before the shuffle, so a host
    with a third of all documents costs as much as any other.
    """
    sums = stored(
        flagged.groupBy(key).agg(F.count("*").alias("n"), *[F.sum(F.col(r).cast("long")).alias(r) for r in rules]),
        "hosts",
    )
    long = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("failed")) for r in rules]))
    priors = prior(sums.select(key, "n", long.alias("x")).select(key, "n", "x.rule", "x.failed"))
    shrunk = [
        ((F.col(r) + a) / (F.col("n") + a + b)).alias(f"rate_{r}")
        for r in rules
        for a, b in [priors.get(r, (0.0, 1.0))]
    ]
    rates = sums.select(key, "n", *shrunk)
    worst = F.greatest(*[F.col(f"rate_{r}") for r in rules]) if len(rules) > 1 else F.col(f"rate_{rules[0]}")
    return rates.withColumn("bad", worst > MAX_RATE)


def judged(
    docs: DataFrame, host_column: str = "source", text_column: str = "text", out: str = "_measured"
) -> DataFrame:
    """Adds to `docs` the struct `out` (FIELDS) and the booleans `_base_failed` and `_kept`.

    A document fails by a base rule, or by a strict rule if its host is bad; clean documents of a bad
    host stay. A null host is a host of its own. Null and empty texts have no words and fail as short;
    very long texts are measured whole, one at a time. Repeated rows are judged alike; empty tables give
    no rows. The documents' own columns may have any names but those three. Texts are measured twice:
    once to sum up the hosts, once for the result.
    """
    rules = {**BASE, **STRICT}
    key, is_bad = fresh(docs, "_key", "_bad")
    flags = [F.expr(rule.format(m="_m")).alias(name) for name, rule in rules.items()]
    slim = docs.select(group_key(host_column).alias("_host"), F.col(text_column).alias("_text"))
    slim = measured(slim, "_text", "_m").select("_host", *flags)
    bad = stored(host_verdicts(slim, "_host", list(rules)).where("bad").select("_host"), "bad_hosts")
    bad = bad.select(F.col("_host").alias(key), F.lit(True).alias(is_bad))
    full = measured(docs, text_column, out).withColumn(key, group_key(host_column)).join(bad, key, "left")
    kept = ~base_failed(out) & ~(F.coalesce(F.col(is_bad), F.lit(False)) & strict_failed(out))
    return full.withColumns({"_base_failed": base_failed(out), "_kept": kept}).drop(key, is_bad)


def keep_clean(docs: DataFrame, host_column: str = "source", text_column: str = "text") -> DataFrame:
    """The documents that pass, with their own columns, whatever these are called.

    Nulls, empty and very long texts, repeated rows and empty tables are as in `judged`.
    """
    (out,) = fresh(docs, "_measured")
    renamed = docs.withColumnsRenamed({c: f"{c}__" for c in docs.columns if c.lower() in ("_base_failed", "_kept")})
    names = renamed.columns
    kept = judged(renamed, host_column, text_column, out).where("_kept").select(*names)
    return kept.withColumnsRenamed(dict(zip(names, docs.columns)))
