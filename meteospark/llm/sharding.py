"""Sharding by proportional stratified interleaving, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteospark.llm.common import cumulated, group_key, seeded

_SPACE = float(1 << 52)


def interleaved_shards(
    docs: DataFrame,
    shards: int = 8,
    seed: int = 7,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """Deals documents into shards that all have the mixture of the sources.

    Rows of a source are ranked in a seeded order; rank over the source's rows, with a seeded offset for
    each source, is the row's place in [0, 1). All rows sorted by place are cut into shards whose row
    counts differ by one at most; every shard so holds each source's share up to a row or two.

    Returns id, source, size (UTF-8 bytes + 1), text_crc32, shard and slot (gapless from 0 in a shard).
    A null text has size 1 and the checksum of the empty text; a null source is a source of its own; a
    null id is allowed. Repeated rows are dealt like others; equal places are ordered by a seeded hash,
    source, id, checksum and size, so only fully equal rows may swap. Empty input gives no rows. Only
    the named columns are read, others may have any name.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    slim = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(source_column).alias("source"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        group_key(source_column).alias("_key"),
        seeded(seed, id_column).alias("_order"),
    )
    total = docs.count()
    ties = ["_order", "doc_id", "text_crc32", "size"]
    ranked = cumulated(slim, ["_key"], F.col("_order") / _SPACE, ties, total, out="_rank", group_total="_rows")
    offset = (seeded(seed, "_key") + 0.5) / _SPACE
    placed = ranked.withColumn("_place", (F.col("_rank") - offset) / F.col("_rows")).withColumn(
        "_mixed", seeded(seed + 1, "_key", "doc_id")
    )
    order = ["_place", "_mixed", "_key", "doc_id", "text_crc32", "size"]
    at = F.col("_at") - 1
    shard = F.floor(at * shards / F.lit(max(total, 1)))
    return (
        cumulated(placed, [], F.col("_place"), order, total, out="_at")
        .withColumn("shard", shard.cast("int"))
        .select(
            "doc_id",
            "source",
            "size",
            "text_crc32",
            "shard",
            (at - F.ceil(F.col("shard") * F.lit(total) / shards)).cast("long").alias("slot"),
        )
    )
