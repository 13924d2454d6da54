"""Feature rows, sample windows, targets, scaling, split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from meteospark.catalog import FEATURES, INPUT_FEATURES
from meteospark.functions import physics, times
from meteospark.operators import profiling


def feature_rows(series: DataFrame, stations: DataFrame) -> DataFrame:
    """The six features of a gap-free series with cyclic time and theoretical radiation."""
    places = stations.select("station_id", "latitude", "longitude")
    sky = physics.clear_sky_radiation(F.col("ts"), F.col("latitude"), F.col("longitude"), F.col("rh"))
    derived = {**times.cyclic(F.col("ts")), "theo_solar": sky}
    rows = series.join(places, "station_id").withColumns(derived)
    extra = [c for c in ("filled",) if c in series.columns]
    return rows.select("station_id", "ts", *INPUT_FEATURES, "latitude", "longitude", *extra)


def _vector(names) -> Column:
    return F.array(*[F.col(n).cast("double") for n in names])


def month_rows(
    rows: DataFrame,
    lookback: int,
    ahead: int,
    step_minutes: int = 60,
    inputs=INPUT_FEATURES,
    targets=FEATURES,
    keep=(),
    block_days: int | None = None,
) -> DataFrame:
    """The rows each month's windows need: its own, `lookback` - 1 before them and `ahead` after them.

    station_id, ts, _in, _out, `keep` and _month. A row goes to more than one month near a border only.
    With `block_days` blocks of so many days, counted from 1970, take the place of months.
    """
    if block_days is None:
        block, every = lambda ts: F.trunc(ts, "MM"), F.expr("INTERVAL 1 MONTH")
    else:
        block, every = lambda ts: times.floor_slot(ts, 1440 * block_days), F.expr(f"INTERVAL '{block_days}' DAY")
    first_user = block(F.col("ts") - times.minutes(ahead * step_minutes))
    last_user = block(F.col("ts") + times.minutes((lookback - 1) * step_minutes))
    return rows.select(
        "station_id",
        "ts",
        _vector(inputs).alias("_in"),
        _vector(targets).alias("_out"),
        *keep,
        F.explode(F.sequence(first_user, last_user, every)).alias("_month"),
    )


def sample_windows(
    rows: DataFrame,
    lookback: int = 24,
    horizon: int = 6,
    step_minutes: int = 60,
    inputs=INPUT_FEATURES,
    targets=FEATURES,
    with_targets: bool = True,
    keep=(),
) -> DataFrame:
    """One row per reference time t: x = rows t-L+1..t, y[h] = f(t+h) - f(t) for h = 1..H.

    `rows` is a dense series. Each row is sent to the months whose samples need it - its own,
    and the next or previous one near a border - so that windows run inside (station, month)
    and no task holds a station's whole history. `keep` names per-row columns to carry along.
    """
    spread = month_rows(rows, lookback, horizon if with_targets else 0, step_minutes, inputs, targets, keep)
    by = W.partitionBy("station_id", "_month").orderBy("ts")
    past = by.rowsBetween(-(lookback - 1), 0)
    out = spread.withColumn("x", F.collect_list("_in").over(past))
    if with_targets:
        steps = [F.lead("_out", h).over(by).alias(f"_h{h}") for h in range(1, horizon + 1)]
        out = out.select("*", *steps)
    out = out.where((F.size("x") == lookback) & (F.trunc("ts", "MM") == F.col("_month")))
    columns = ["station_id", F.col("ts").alias("ts_ref"), "x", F.col("_out").alias("last_actual"), *keep]
    if with_targets:
        out = out.where(F.col(f"_h{horizon}").isNotNull())
        delta = [
            F.zip_with(f"_h{h}", "_out", lambda later, now: later - now) for h in range(1, horizon + 1)
        ]
        columns.append(F.array(*delta).alias("y"))
    return out.select(*columns)


def scaler_stats(
    rows: DataFrame,
    lookback: int = 24,
    horizon: int = 6,
    step_minutes: int = 60,
    inputs=INPUT_FEATURES,
    until: DataFrame | None = None,
) -> DataFrame:
    """Mean and population deviation of each input over all steps of all complete windows.

    A row counts once per window that contains it; that number follows from its position, so
    no window is built. `until` (station_id, cut_ts) limits the samples to those up to a time.
    Values are shifted by the station's first row before they are summed, which keeps the
    deviation exact where it is small against the mean. Zero deviation gives scale 1.
    """
    base = [F.min_by(f, "ts").alias(f"_base_{f}") for f in inputs]
    bounds = rows.groupBy("station_id").agg(F.min("ts").alias("_first"), F.max("ts").alias("_last"), *base)
    position = lambda ts: times.seconds_between(F.col("_first"), ts) / (60 * step_minutes)
    samples = position(F.col("_last")) + 1 - lookback - horizon + 1
    if until is not None:
        bounds = bounds.join(until, "station_id")
        samples = F.least(samples, position(F.col("cut_ts")) + 1 - lookback + 1)
    i = position(F.col("ts"))
    weight = F.greatest(F.lit(0), F.least(i + 1, F.lit(lookback), samples, samples + lookback - 1 - i))
    used = rows.join(bounds, "station_id").withColumn("_w", weight).where("_w > 0")
    parts = [F.struct(F.lit(f).alias("feature"), F.col(f).alias("value"), F.col(f"_base_{f}").alias("base")) for f in inputs]
    long = used.select("station_id", "_w", F.inline(F.array(*parts)))
    w, x = F.col("_w"), F.col("value") - F.coalesce("base", F.lit(0.0))
    stats = long.where("value IS NOT NULL").groupBy("station_id", "feature").agg(
        F.sum(w).cast("double").alias("n"),
        F.coalesce(F.first("base"), F.lit(0.0)).alias("base"),
        F.sum(w * x).alias("s1"),
        F.sum(w * x * x).alias("s2"),
    )
    mean = F.col("s1") / F.col("n")
    variance = F.greatest(F.col("s2") / F.col("n") - mean * mean, F.lit(0.0))
    return stats.select("station_id", "feature", "n", (F.col("base") + mean).alias("mean"), scale_of(F.sqrt(variance)))


def target_stats(samples: DataFrame, targets=FEATURES) -> DataFrame:
    """Mean and population deviation of each target's deltas over all samples and horizons."""
    steps = samples.select("station_id", F.explode("y").alias("d"))
    long = steps.select("station_id", *[F.col("d")[j].alias(f) for j, f in enumerate(targets)])
    long = profiling.melt(long, ["station_id"], targets)
    return long.groupBy("station_id", "feature").agg(
        F.count("value").cast("double").alias("n"), F.avg("value").alias("mean"), scale_of(F.stddev_pop("value"))
    )


def scale_of(spread: Column) -> Column:
    return F.when(spread > 0, spread).otherwise(1.0).alias("scale")


def scale_vector(vector: Column, mean: Column, scale: Column) -> Column:
    shifted = F.zip_with(vector, mean, lambda v, m: v - m)
    return F.zip_with(shifted, scale, lambda v, s: v / s)


def unscale_vector(vector: Column, mean: Column, scale: Column) -> Column:
    sized = F.zip_with(vector, scale, lambda v, s: v * s)
    return F.zip_with(sized, mean, lambda v, m: v + m)


def stats_arrays(stats: DataFrame, names, prefix: str) -> DataFrame:
    """Mean and scale per station as arrays in feature order."""
    pick = lambda c: F.array(*[F.max(F.when(F.col("feature") == f, F.col(c))) for f in names])
    return stats.groupBy("station_id").agg(pick("mean").alias(f"{prefix}_mean"), pick("scale").alias(f"{prefix}_scale"))


def split_point(samples: DataFrame, share: float = 0.8, step_minutes: int = 60) -> DataFrame:
    """Time of the last training sample per station: the first int(n * share) samples train.

    Samples of a dense series are evenly spaced, so the cut follows from count and first time.
    """
    n_train = F.floor(F.col("n_samples") * F.lit(float(share)))
    cut = F.timestamp_add("MINUTE", (n_train - 1).cast("int") * step_minutes, F.col("first_ref"))
    return (
        samples.groupBy("station_id")
        .agg(F.count("*").alias("n_samples"), F.min("ts_ref").alias("first_ref"))
        .select("station_id", "n_samples", n_train.cast("bigint").alias("n_train"), F.when(n_train > 0, cut).alias("cut_ts"))
    )


def split_of_rows(
    rows: DataFrame, lookback: int, horizon: int, share: float = 0.8, step_minutes: int = 60
) -> DataFrame:
    """The same cut from the dense rows themselves: their ends say how many samples there are."""
    steps = F.floor(times.seconds_between(F.col("_first"), F.col("_last")) / (60 * step_minutes)) + 1
    n = F.greatest(steps - lookback - horizon + 1, F.lit(0))
    n_train = F.floor(F.col("n_samples") * F.lit(float(share)))
    cut = F.timestamp_add("MINUTE", ((n_train + lookback - 2) * step_minutes).cast("int"), F.col("_first"))
    return (
        rows.groupBy("station_id")
        .agg(F.min("ts").alias("_first"), F.max("ts").alias("_last"))
        .withColumn("n_samples", n)
        .select("station_id", "n_samples", F.when(n_train > 0, cut).alias("cut_ts"))
    )


def with_split(samples: DataFrame, share: float = 0.8) -> DataFrame:
    cut = split_point(samples, share).select("station_id", "cut_ts")
    return samples.join(cut, "station_id").withColumn("is_train", F.coalesce(F.col("ts_ref") <= F.col("cut_ts"), F.lit(False))).drop("cut_ts")


def feature_contract(
    samples: DataFrame, lookback: int = 24, horizon: int = 6, n_inputs: int = len(INPUT_FEATURES), n_targets: int = len(FEATURES)
) -> DataFrame:
    """Shape check per station and month: every x is L x inputs, every y is H x targets."""
    widths = lambda c: F.transform(c, F.size)
    out = (
        samples.groupBy("station_id", times.month_of(F.col("ts_ref")).alias("month"))
        .agg(
            F.count("*").alias("n_samples"),
            F.min(F.size("x")).alias("x_steps_min"),
            F.max(F.size("x")).alias("x_steps_max"),
            F.min(F.array_min(widths("x"))).alias("x_width_min"),
            F.max(F.array_max(widths("x"))).alias("x_width_max"),
            F.min(F.size("y")).alias("y_steps_min"),
            F.max(F.size("y")).alias("y_steps_max"),
            F.min(F.array_min(widths("y"))).alias("y_width_min"),
            F.max(F.array_max(widths("y"))).alias("y_width_max"),
            F.count_if(F.exists("x", lambda r: F.exists(r, lambda v: v.isNull()))).alias("n_null_x"),
        )
    )
    fits = (
        (F.col("x_steps_min") == lookback)
        & (F.col("x_steps_max") == lookback)
        & (F.col("x_width_min") == n_inputs)
        & (F.col("x_width_max") == n_inputs)
        & (F.col("y_steps_min") == horizon)
        & (F.col("y_steps_max") == horizon)
        & (F.col("y_width_min") == n_targets)
        & (F.col("y_width_max") == n_targets)
        & (F.col("n_null_x") == 0)
    )
    return out.withColumn("is_valid", fits)


def same_order(training: list[str], inference: list[str], equivalent: dict[str, str]) -> bool:
    """True when both column lists name the same features in the same order."""
    return [equivalent.get(c, c) for c in training] == [equivalent.get(c, c) for c in inference]
