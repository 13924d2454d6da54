"""Minute telemetry to a dense, cleaned hourly series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from meteospark.catalog import FEATURES
from meteospark.functions import physics, times
from meteospark.operators import spans

KEYS = ("station_id",)


def apply_offset(df: DataFrame, offset=-1.5, feature: str = "temp") -> DataFrame:
    """Sensor offset, a literal or a per-station column."""
    shift = offset if isinstance(offset, Column) else F.lit(float(offset))
    return df.withColumn(feature, F.col(feature) + shift)


def resample(df: DataFrame, step_minutes: int = 60, keys=KEYS, features=FEATURES) -> DataFrame:
    """One row per key and occupied slot: mean of each feature, maximum of rain.

    Partial aggregation leaves at most one row per slot and task to shuffle, so a station that
    holds a third of the telemetry costs no more than a small one.
    """
    aggs = [(F.max if f == "rain" else F.avg)(f).alias(f) for f in features]
    slot = F.window("ts", f"{step_minutes} minutes")
    slots = df.groupBy(*keys, slot).agg(*aggs)
    return slots.select(*keys, F.col("window.start").alias("ts"), *features)


def _grid(df: DataFrame, step_minutes: int, keys, features, carried: dict[str, Column], value: dict) -> DataFrame:
    """Every slot between a key's first and last one, from the rows that exist.

    Each row emits the slots up to its successor. All of them have the same neighbours, so
    windows run over existing rows, `carried` is computed once per row, and only the `value`
    formulas run per slot, after an explode that neither sorts nor shuffles. Positions are epoch
    seconds: `_row` of the emitting row, `_t` of the slot.

    A partition grows by its gaps after the windows, which adaptive execution can't foresee when it puts
    small partitions together; so there are as many as the session sets for a shuffle.
    """
    step = F.lit(step_minutes * 60).cast("bigint")
    df = df.select(*keys, spans.by_month().alias(spans.SPAN), times.epoch_seconds(F.col("ts")).alias("_row"), *features)
    cols = features if carried else ()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = spans.with_neighbours(spans.with_carry(df, keys, "_row", cols, parts), keys, "_row", cols)
    following = F.coalesce(F.lead("_row").over(spans.local(keys, "_row")), F.col("_after_at"))
    df = df.withColumn("_until", F.coalesce(following - step, F.col("_row")))
    kept = {**carried, **({} if carried else {f: F.col(f) for f in features})}
    df = df.select(*keys, "_row", "_until", *[c.alias(n) for n, c in kept.items()])
    df = df.withColumn("_t", F.explode(F.sequence(F.col("_row"), F.col("_until"), step)))
    return df.select(*keys, times.from_epoch(F.col("_t")).alias("ts"), *[c.alias(n) for n, c in value.items()])


def densify(df: DataFrame, step_minutes: int = 60, keys=KEYS, features=FEATURES) -> DataFrame:
    """Every slot between a key's first and last one; slots without data hold NULL."""
    observed = F.col("_t") == F.col("_row")
    return _grid(df, step_minutes, keys, features, {}, {f: F.when(observed, F.col(f)) for f in features})


def _line(features, max_gap_seconds: int | None = None) -> tuple[dict, dict]:
    """Line through the neighbours of a row, and its value at a slot.

    At a slot with a value the line starts there and gives that value. Without a later value
    the line is flat, without an earlier one there is none.
    """
    carried, value = {}, {}
    for f in features:
        carried[f"_from_{f}"] = F.col(f"_prev_{f}")
        carried[f"_since_{f}"] = F.col(f"_prev_{f}_at")
        carried[f"_slope_{f}"] = F.expr(
            f"coalesce((_next_{f} - _prev_{f}) / (_next_{f}_at - _prev_{f}_at), 0D)"
        )
        line = f"_from_{f} + _slope_{f} * (_t - _since_{f})"
        if max_gap_seconds is not None:
            line = f"IF(_t <= _since_{f} + {max_gap_seconds}, {line}, NULL)"
        value[f] = F.expr(line)
    return carried, value


def interpolate(
    df: DataFrame, max_hours: float | None = 2, step_minutes: int = 60, keys=KEYS, features=FEATURES
) -> DataFrame:
    """Densifies, then interpolates linearly in time.

    At most `max_hours` of slots after a valid value are filled, so a longer gap is filled in
    part. Trailing slots hold the last value, leading slots stay NULL. `max_hours=None`
    fills without a limit.
    """
    limit = None if max_hours is None else int(max_hours * 60 / step_minutes) * step_minutes * 60
    return _grid(df, step_minutes, keys, features, *_line(features, limit))


def fill_edges(df: DataFrame, step_minutes: int = 60, keys=KEYS, features=FEATURES) -> DataFrame:
    """Densifies, then fills forward and, where nothing lies before, backward."""
    carried = {f"_fill_{f}": F.coalesce(f"_prev_{f}", f"_next_{f}") for f in features}
    return _grid(df, step_minutes, keys, features, carried, {f: F.col(f"_fill_{f}") for f in features})


def fill_past(df: DataFrame, step_minutes: int = 60, keys=KEYS, features=FEATURES) -> DataFrame:
    """Densifies, then carries the last value forward; what has no value before it stays NULL, so a
    slot depends on nothing behind it."""
    carried = {f"_fill_{f}": F.col(f"_prev_{f}") for f in features}
    return _grid(df, step_minutes, keys, features, carried, {f: F.col(f"_fill_{f}") for f in features})


def interpolate_all(df: DataFrame, step_minutes: int = 60, keys=KEYS, features=FEATURES) -> DataFrame:
    """Unbounded linear interpolation with leading slots filled backward: no NULL is left
    in a feature that has any value. `filled` marks rows in which anything was filled."""
    carried, value = _line(features)
    for f in features:
        # before the first value the line is flat at that value
        carried[f"_from_{f}"] = F.coalesce(carried[f"_from_{f}"], F.col(f"_next_{f}"))
        carried[f"_since_{f}"] = F.coalesce(carried[f"_since_{f}"], F.col("_row"))
    carried["_complete"] = reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in features])
    value["filled"] = ~(F.col("_complete") & (F.col("_t") == F.col("_row")))
    return _grid(df, step_minutes, keys, features, carried, value)


def guard_series(df: DataFrame, specs: dict | None = None) -> DataFrame:
    """Guardrails of the hourly path: rain, rh, solar and wind only."""
    res = specs or {}
    return df.withColumns(
        {f: physics.guard_feature(f, F.col(f), res.get(f)) for f in ("rain", "rh", "solar", "wind")}
    )


def clean_hourly(
    telemetry: DataFrame,
    offset=-1.5,
    max_hours: float = 2,
    step_minutes: int = 60,
    specs: dict | None = None,
) -> DataFrame:
    """Offset, resample, densify, bounded interpolation, guardrails.

    With `max_hours=0` gaps stay NULL and, as in the per-station pipeline, no guardrail runs.
    """
    hourly = resample(apply_offset(telemetry, offset), step_minutes)
    if max_hours * 60 < step_minutes:
        return densify(hourly, step_minutes)
    return guard_series(interpolate(hourly, max_hours, step_minutes), specs)
