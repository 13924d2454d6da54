"""Mixing sources by temperature, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meteospark.llm.common import WORD, cumulated, fresh, group_key, seeded, stored

_SPACE = float(1 << 52)
#: Interior points of one search round and rounds: 63 points are six bisection steps at once.
_POINTS, _ROUNDS = 63, 8


def slim_documents(docs: DataFrame, id_column="doc_id", source_column="source", text_column="text") -> DataFrame:
    """doc_id, source, the source's key and the number of words, counted over the whole text (null: 0)."""
    words = F.regexp_count(F.coalesce(F.col(text_column), F.lit("")), F.lit(WORD))
    return docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(source_column).alias("source"),
        group_key(source_column).alias("key"),
        words.cast("long").alias("n_tokens"),
    )


def _probe(sources: DataFrame, total: int, low: float, high: float) -> list[tuple]:
    """(exponent, entropy, largest w/p, smallest w/p) at points spread evenly over [low, high]."""
    step = (high - low) / (_POINTS + 1)
    p = F.col("tokens") / F.lit(total)
    points = F.transform(F.sequence(F.lit(0), F.lit(_POINTS + 1)), lambda i: F.lit(low) + i * F.lit(step))
    rows = (
        sources.where("tokens > 0")
        .select(F.log2(p).alias("log_p"), F.explode(points).alias("a"))
        .groupBy("a")
        .agg(
            F.sum(F.pow(F.lit(2.0), F.col("a") * F.col("log_p"))).alias("z"),
            F.sum(F.pow(F.lit(2.0), F.col("a") * F.col("log_p")) * F.col("log_p")).alias("s"),
            F.min("log_p").alias("least"),
            F.max("log_p").alias("most"),
        )
        .collect()
    )
    found = []
    for r in rows:
        entropy = math.log2(r.z) - r.a * r.s / r.z
        found.append((r.a, entropy, 2 ** ((r.a - 1) * r.least) / r.z, 2 ** ((r.a - 1) * r.most) / r.z))
    return sorted(found)


def find_exponent(
    sources: DataFrame,
    total: int,
    max_repetition: float | None = 4.0,
    target_entropy: float | None = None,
    budget: int | None = None,
) -> float:
    """The exponent in [0, 1] nearest to 0 (most even) that keeps to what is asked.

    max_repetition: no source is read more often than that under the budget. target_entropy: the
    weights' entropy in bits comes down to it. With both the larger exponent counts. Entropy and
    repetition fall as the exponent rises; the search bisects six steps at a time, in one job over the
    table of sources, and brings a fixed number of sums to the driver. If even 1 doesn't do, it is 1.
    """

    def good(entropy: float, most: float, least: float) -> bool:
        repetition = most / least if budget is None else budget / total * most
        return (max_repetition is None or repetition <= max_repetition * (1 + 1e-12)) and (
            target_entropy is None or entropy <= target_entropy + 1e-12
        )

    low, high = 0.0, 1.0
    for _ in range(_ROUNDS):
        points = _probe(sources, total, low, high)
        if not points:
            return 1.0
        first = next((i for i, (_, *x) in enumerate(points) if good(*x)), None)
        if first is None:
            return high
        if first == 0:
            return points[0][0]
        low, high = points[first - 1][0], points[first][0]
    return high


def weights(
    slim: DataFrame,
    max_repetition: float | None = 4.0,
    target_entropy: float | None = None,
    budget: int | None = None,
) -> tuple[DataFrame, int, float]:
    """One row per source: key, tokens, rows, weight, target (tokens); then the budget and the exponent.

    budget None: the smallest budget under which every document is used at least once. A source without
    tokens has weight 0 and is passed once.
    """
    sources = stored(slim.groupBy("key").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows")), "sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    exponent = find_exponent(sources, max(total, 1), max_repetition, target_entropy, budget)
    p = F.col("tokens") / F.lit(max(total, 1))
    raw = sources.withColumn("raw", F.when(F.col("tokens") > 0, F.pow(p, F.lit(exponent))).otherwise(0.0))
    z, need = raw.agg(F.sum("raw"), F.max(F.when(F.col("tokens") > 0, F.col("tokens") / F.col("raw")))).first()
    z = z or 1.0
    budget = int(math.ceil((need or 0) * z)) if budget is None else budget
    weighted = raw.withColumn("weight", F.col("raw") / F.lit(z)).drop("raw")
    return weighted.withColumn("target", F.col("weight") * F.lit(float(budget))), budget, exponent


def _streamed(slim: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """A row for each document and pass that is kept, with `_order` and `_upto`, the pass's tokens so far."""
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("target") / F.col("tokens") + 1e-9)).otherwise(1)
    rest = F.when(F.col("tokens") > 0, F.col("target") - F.col("_whole") * F.col("tokens")).otherwise(0)
    plan = targets.withColumn("_whole", whole.cast("long")).withColumn("_rest", F.floor(rest + 1e-6))
    passes = plan.select(
        "key",
        "tokens",
        F.greatest(F.col("target"), F.lit(1.0)).alias("_target"),
        "_whole",
        "_rest",
        F.explode(F.sequence(F.lit(0), F.col("_whole"))).alias("pass"),
    ).where("pass < _whole OR _rest > 0")
    rows = slim.join(passes, "key").withColumn("_order", seeded(seed, "key", "pass", "doc_id"))
    ties = ["_order", "doc_id", "n_tokens"]
    streamed = cumulated(
        rows, ["key", "pass"], F.col("_order") / _SPACE, ties, slim.count(), amount="n_tokens", out="_upto"
    )
    return streamed.where("pass < _whole OR _upto <= _rest")


def mixed(
    docs: DataFrame,
    max_repetition: float | None = 4.0,
    target_entropy: float | None = None,
    budget: int | None = None,
    block_tokens: int = 1 << 17,
    seed: int = 11,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """Realises temperature weights as passes over seeded permutations, dealt into blocks of a token budget.

    A source with target T and t tokens gets floor(T / t) whole passes and a last one cut where the
    next document would exceed T. Each pass has a permutation of its own. A document's place in its
    source's stream, as a part of T, names its block, so every block holds the sources by weight; inside
    a block documents are permuted.

    Returns doc_id, source, pass, n_tokens, block and slot (from 0 in a block). Null texts and texts
    without words have 0 tokens and come in every pass begun; null sources form a source; null and
    repeated ids are rows like others (repeated rows may swap). Empty input gives no rows.
    """
    slim = stored(slim_documents(docs, id_column, source_column, text_column), "tokens")
    targets, budget, _ = weights(slim, max_repetition, target_entropy, budget)
    kept = _streamed(slim, targets, seed)
    place = (F.col("pass") * F.col("tokens") + F.col("_upto") - F.col("n_tokens") / 2.0) / F.col("_target")
    blocks = max(1, -(-budget // block_tokens))
    # documents without tokens at a stream's end, and a source without any, are spread by their order
    place = F.when(F.col("tokens") > 0, place).otherwise(F.col("_order") / _SPACE)
    placed = kept.withColumn("block", F.least(F.floor(place * blocks), F.lit(blocks - 1)).cast("long"))
    shuffled = placed.withColumn("_mixed", seeded(seed + 1, "key", "pass", "doc_id"))
    inside = Window.partitionBy("block").orderBy("_mixed", "key", "pass", "doc_id", "n_tokens")
    return shuffled.select(
        "doc_id",
        "source",
        F.col("pass").cast("int").alias("pass"),
        "n_tokens",
        "block",
        (F.row_number().over(inside) - 1).cast("long").alias("slot"),
    )


def mixture_of(
    docs: DataFrame,
    max_repetition: float | None = 4.0,
    target_entropy: float | None = None,
    budget: int | None = None,
    seed: int = 11,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """The documents as `mixed` passes them on: each row as often as its source's passes take it.

    What a cut pass keeps are the rows up to an order number, so a table of one number for each source
    and pass says it all, and texts aren't shuffled. Equal ids of a source share their order number and
    stay or go together. Null and empty texts have no tokens and stay, very long ones count whole; an
    empty table gives no rows. Columns are those of `docs`, whatever their names.
    """
    slim = stored(slim_documents(docs, id_column, source_column, text_column), "tokens")
    targets, _, _ = weights(slim, max_repetition, target_entropy, budget)
    key, number, cut = fresh(docs, "_key", "_pass", "_cut")
    cuts = stored(_streamed(slim, targets, seed).groupBy("key", "pass").agg(F.max("_order").alias("upto")), "cuts")
    cuts = cuts.select(F.col("key").alias(key), F.col("pass").alias(number), F.col("upto").alias(cut))
    keyed = docs.withColumn(key, group_key(source_column)).join(cuts, key)
    return keyed.where(seeded(seed, key, number, id_column) <= F.col(cut)).select(*docs.columns)
