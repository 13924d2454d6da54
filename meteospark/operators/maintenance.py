"""Freshness, gap bridging, replay, range deletes, periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meteospark.functions import times
from meteospark.operators import spans, staging


def last_run(forecast: DataFrame, as_of, by=()) -> DataFrame:
    """Time of the last forecast run up to as_of, from created_at or else from ts."""
    known = lambda c: F.max(F.when(F.col(c) <= times.instant(as_of), F.col(c)))
    created = known("created_at") if "created_at" in forecast.columns else F.lit(None)
    return forecast.groupBy(*by).agg(F.coalesce(created, known("ts")).alias("last_run"))


def should_skip(forecast: DataFrame, as_of, interval_hours: float = 1, by=()) -> DataFrame:
    """Skip a run while the last one is younger than the interval."""
    age = times.seconds_between(F.col("last_run"), times.instant(as_of)) / 3600.0
    out = last_run(forecast, as_of, by).withColumn("age_hours", age)
    return out.withColumn("skip", F.coalesce(F.col("age_hours") < interval_hours, F.lit(False)))


def last_staged(staged: DataFrame, as_of, by=()) -> DataFrame:
    """Newest staged time, as_of when there is none."""
    return staged.groupBy(*by).agg(F.coalesce(F.max("ts"), times.instant(as_of)).alias("last_ts"))


def continuous_until(forecast: DataFrame, interval_hours: float = 1) -> DataFrame:
    """End of the first unbroken run of forecast times per station."""
    marks = forecast.select("station_id", "ts").distinct()
    steps = spans.with_previous(marks, ["station_id"], "ts", spans.by_month(), "_prev")
    broken = times.seconds_between(F.col("_prev"), F.col("ts")) > (interval_hours * 60 + 15) * 60
    return steps.groupBy("station_id").agg(
        F.coalesce(F.min(F.when(broken, F.col("_prev"))), F.max("ts")).alias("continuous_end")
    )


def bridge_plan(
    forecast: DataFrame, telemetry: DataFrame, interval_hours: int = 1, step_hours: int = 1
) -> DataFrame:
    """Hourly slots to forecast again, for stations whose unbroken run ends too far behind.

    Slots start one interval after the run and end with the latest telemetry hour; those that
    already have a forecast are left alone.
    """
    newest = telemetry.groupBy("station_id").agg(F.max("ts").alias("last_telemetry"))
    behind = times.seconds_between(F.col("continuous_end"), F.col("last_telemetry"))
    begin = F.col("continuous_end") + times.minutes(interval_hours * 60)
    end = times.floor_hour(F.col("last_telemetry"))
    open_stations = (
        continuous_until(forecast, interval_hours)
        .join(newest, "station_id")
        .where((behind > (interval_hours + 1) * 3600) & (begin <= end))
    )
    slots = open_stations.select(
        "station_id",
        "continuous_end",
        "last_telemetry",
        F.explode(F.sequence(begin, end, times.minutes(step_hours * 60))).alias("ts"),
    )
    return staging.not_in(slots, forecast, ["station_id", "ts"])


def months_between(first: Column, last: Column) -> Column:
    """Array of 'YYYY-MM' from the first to the last month, both included."""
    months = F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("INTERVAL 1 MONTH"))
    return F.transform(months, lambda m: F.date_format(m, "yyyy-MM"))


def month_sequence(df: DataFrame, at: str, by=()) -> DataFrame:
    """All months from a table's first to its last time, per key."""
    ends = df.groupBy(*by).agg(F.min(at).alias("_first"), F.max(at).alias("_last"))
    return ends.select(*by, F.explode(months_between(F.col("_first"), F.col("_last"))).alias("month"))


def replay_extend(df: DataFrame, as_of, block_days: int = 7) -> DataFrame:
    """Rows that continue each station's telemetry up to as_of by repeating its recent past.

    Whole blocks of the last `block_days` follow one another; the remainder up to as_of is
    filled with the most recent rows of that length. Copies of one row differ in their shift
    alone, so all of them come from one pass over the block.
    """
    block = block_days * 86400
    now = times.instant(as_of)
    ends = df.groupBy("station_id").agg(F.max("ts").alias("_end"))
    gap = times.seconds_between(F.col("_end"), now)
    ends = ends.withColumn("_gap", gap).where("_gap > 0")
    whole = F.floor(F.col("_gap") / block)
    rest = F.col("_gap") - whole * block
    age = times.seconds_between(F.col("ts"), F.col("_end"))
    blocks = F.when(whole > 0, F.transform(F.sequence(F.lit(1).cast("bigint"), whole), lambda i: i * block))
    shifts = F.concat(
        F.when(age < block, F.coalesce(blocks, F.array().cast("array<bigint>"))).otherwise(
            F.array().cast("array<bigint>")
        ),
        F.when(age < rest, F.array("_gap")).otherwise(F.array().cast("array<bigint>")),
    )
    shifted = (
        df.join(ends, "station_id")
        .where(age < block)
        .withColumn("_shift", F.explode(shifts))
        .withColumn("ts", F.timestamp_add("SECOND", F.col("_shift"), F.col("ts")))
    )
    out = shifted.where(F.col("ts") <= now).select(df.columns)
    return staging.not_in(out, df, ["station_id", "ts"])


def keep_outside(df: DataFrame, begin, end, at: str = "ts", zone: str | None = None) -> DataFrame:
    """What a range delete leaves: rows outside [begin, end]; a zone makes the range local."""
    lo, hi = times.instant(begin), times.instant(end)
    if zone:
        lo, hi = times.to_utc(lo, zone), times.to_utc(hi, zone)
    inside = F.coalesce(F.col(at).between(lo, hi), F.lit(False))
    return df.where(~inside)
