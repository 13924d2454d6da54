"""Raw telemetry: labels, staging, duplicates, minute gaps, existence tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meteospark.catalog import FEATURES, SCHEMES
from meteospark.functions import cleaning, times
from meteospark.operators import spans


def first_row(df: DataFrame, key, order) -> DataFrame:
    """One row per key, the smallest by `order`.

    A minimum over one struct combines on the map side, so copies of a hot key never meet in
    one task, unlike a ranked window.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    packed = F.min(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*key).agg(packed).select(*key, "_row.*").select(*df.columns)


def last_row(df: DataFrame, key, order=()) -> DataFrame:
    """One row per key, the largest by `order`, then by the other columns; null keys are keys like others."""
    rest = [c for c in df.columns if c not in key and c not in order]
    if not rest and not order:
        return df.distinct()
    packed = F.max(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*key).agg(packed).select(*key, "_row.*").select(*df.columns)


def with_utc_minutes(df: DataFrame, epoch: str = "epoch_timestamp") -> DataFrame:
    """UTC minute from the epoch, which is the source of truth for time."""
    return df.withColumn("ts", times.epoch_to_minute(F.col(epoch)))


def label_check(df: DataFrame, zone: str, label: str = "ts_label", epoch: str = "epoch_timestamp") -> DataFrame:
    """Rows per station whose local label differs from the epoch in that zone."""
    local = times.to_local(times.epoch_to_minute(F.col(epoch)), zone)
    return df.groupBy("station_id").agg(
        F.count("*").alias("n_rows"), F.count_if(local != F.col(label)).alias("n_mismatch")
    )


def counted_stage(raw: DataFrame) -> DataFrame:
    """Typed, renamed, one row per station and minute with the number of its raw rows, `_copies`.

    Among copies the earliest epoch wins, then the smallest measures. Rows without a station or a time are
    still there, for whoever counts them.
    """
    measures = [SCHEMES["raw"][f] for f in FEATURES]
    rows = raw.select("station_id", "ts", F.struct("epoch_timestamp", *[cleaning.to_number(c).alias(c) for c in measures]).alias("_row"))
    best = rows.groupBy("station_id", "ts").agg(F.min("_row").alias("_row"), F.count("*").alias("_copies"))
    return best.select(
        "station_id", "ts", *[F.col(f"_row.{SCHEMES['raw'][f]}").alias(SCHEMES["standard"][f]) for f in FEATURES], "_copies"
    )


def stage(raw: DataFrame) -> DataFrame:
    """Typed, renamed, one row per station and minute.

    Among copies the earliest epoch wins, then the smallest measures.
    """
    return counted_stage(raw.where(F.col("ts").isNotNull())).drop("_copies")


def not_in(new: DataFrame, existing: DataFrame, key) -> DataFrame:
    """Rows whose key the target does not hold yet."""
    return new.join(existing.select(*key), list(key), "left_anti")


def insert_or_ignore(target: DataFrame, new: DataFrame, key, order) -> DataFrame:
    """The rows to append: unseen keys, first of each by `order`."""
    return first_row(not_in(new, target, key), key, order)


def gaps(df: DataFrame, max_step_minutes: float = 1.5) -> DataFrame:
    """Missing minutes per station: first and last missing minute and their number."""
    minutes = df.select("station_id", "ts").where(F.col("ts").isNotNull()).distinct()
    steps = spans.with_previous(minutes, ["station_id"], "ts", spans.by_day(), "_prev")
    delta = times.seconds_between(F.col("_prev"), F.col("ts")) / 60.0
    return steps.where(delta > max_step_minutes).select(
        "station_id",
        (F.col("_prev") + times.minutes(1)).alias("gap_start"),
        (F.col("ts") - times.minutes(1)).alias("gap_end"),
        F.rint(delta - 1).cast("int").alias("missing_min"),
    )


def gap_summary(
    df: DataFrame, min_gap: int = 2, max_missing_ratio: float = 0.02, max_gap: int = 180
) -> DataFrame:
    """Expected and missing minutes, longest gap and threshold breach per station."""
    span = df.groupBy("station_id").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    found = (
        gaps(df)
        .groupBy("station_id")
        .agg(
            F.sum("missing_min").alias("missing"),
            F.count("*").alias("n_gaps"),
            F.count_if(F.col("missing_min") >= min_gap).alias("n_reported"),
            F.max("missing_min").alias("longest"),
        )
    )
    expected = F.floor(times.seconds_between(F.col("first_ts"), F.col("last_ts")) / 60) + 1
    out = span.join(found, "station_id", "left").fillna(0, ["missing", "n_gaps", "n_reported", "longest"])
    out = out.withColumn("expected", expected).withColumn("missing_ratio", F.col("missing") / F.col("expected"))
    breach = (F.col("missing_ratio") > max_missing_ratio) | (F.col("longest") > max_gap)
    return out.withColumn("is_breach", breach)
