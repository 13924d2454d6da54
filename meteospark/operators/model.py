"""Multi-step forecast: ridge fit, scoring, baselines, backtest, registry."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from meteospark.catalog import FEATURES, INPUT_FEATURES
from meteospark.functions import physics, times
from meteospark.operators import moments, windows
from meteospark.operators.frames import MonthWindows, nested, per_month

def score(
    narrow: DataFrame, models: DataFrame, lookback: int, horizon: int = 0, targets=FEATURES, block_days: int | None = None
) -> DataFrame:
    """Predicted deltas (`delta`, steps x targets, physical units) of the windows of month rows.

    narrow carries latitude, longitude and `_origin`, which chooses the reference times. models: weights
    and scalers, and what else is to be carried along for a station (model_version, cut_ts); with `_month`
    each is for that block of `block_days` alone. With a horizon the observed deltas `y` come along and windows without a full future have no row.
    """
    extra = [c for c in ("model_version", "cut_ts") if c in models.columns]
    kinds = {"model_version": "string", "cut_ts": "timestamp_ntz"}
    arrow = {"model_version": pa.string(), "cut_ts": pa.timestamp("us")}
    block = pa.list_(pa.list_(pa.float64()))
    fields = [("station_id", pa.string()), ("ts_ref", pa.timestamp("us")), ("latitude", pa.float64()),
              ("longitude", pa.float64()), ("last_actual", pa.list_(pa.float64())), ("delta", block)]
    fields += [("y", block)] * bool(horizon) + [(c, arrow[c]) for c in extra]
    schema = pa.schema(fields)

    def run(rows: pa.Table, known: pa.Table) -> pa.Table:
        if not len(rows) or not len(known):
            return schema.empty_table()
        w = MonthWindows(rows, lookback, horizon, block_days)
        keep = w.column("_origin").fill_null(False).to_numpy(zero_copy_only=False) if len(w.refs) else np.zeros(0, bool)
        if not keep.any():
            return schema.empty_table()
        get = lambda c: np.array(known[c][0].as_py(), float)
        n = int(keep.sum())
        x = ((w.x[keep] - get("x_mean")) / get("x_scale")).reshape(n, -1)
        x = np.hstack([x, np.ones((n, 1))])
        scaled = (x @ get("weights").reshape(x.shape[1], -1)).reshape(n, -1, len(targets))
        mask = pa.array(keep)
        columns = [
            w.column("station_id").filter(mask),
            pa.array(w.ts[keep]).cast(pa.timestamp("us")),
            w.column("latitude").filter(mask).cast(pa.float64()),
            w.column("longitude").filter(mask).cast(pa.float64()),
            w.column("_out").filter(mask).cast(pa.list_(pa.float64())),
            nested(scaled * get("y_scale") + get("y_mean")),
        ]
        if horizon:
            columns.append(nested(np.ascontiguousarray(w.y[keep])))
        columns += [pa.array([known[c][0].as_py()] * n, arrow[c]) for c in extra]
        return pa.Table.from_arrays(columns, schema=schema)

    shape = "station_id string, ts_ref timestamp_ntz, latitude double, longitude double, last_actual array<double>, delta array<array<double>>"
    shape += ", y array<array<double>>" * bool(horizon) + "".join(f", {c} {kinds[c]}" for c in extra)
    return per_month(narrow, models).applyInArrow(run, shape)


def is_finite(delta="delta"):
    """True when no predicted value is NULL, NaN or infinite."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    return ~F.exists(F.flatten(delta), bad)


def split_rejects(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable predictions and rejected ones."""
    ok = F.coalesce(is_finite(), F.lit(False))
    return scored.where(ok), scored.where(~ok)


def to_forecast(
    scored: DataFrame, model_version, step_minutes: int = 60, lookback: int = 24, specs: dict | None = None
) -> DataFrame:
    """Last actual plus delta for every horizon, guardrails applied, one row per target time."""
    version = model_version if not isinstance(model_version, str) else F.lit(model_version)
    base = times.floor_hour(F.col("ts_ref"))
    rows = scored.select(
        "station_id",
        "ts_ref",
        version.alias("model_version"),
        "latitude",
        "longitude",
        F.posexplode(F.transform("delta", lambda d: F.zip_with(d, "last_actual", lambda a, b: a + b))).alias("_h", "p"),
    )
    rows = rows.withColumn("ts", F.timestamp_add("MINUTE", (F.col("_h") + 1) * step_minutes, base))
    sky = physics.clear_sky_radiation(F.col("ts"), F.col("latitude"), F.col("longitude"))
    rows = rows.withColumns({"_sky": sky, **{f"_{f}": F.col("p")[j] for j, f in enumerate(FEATURES)}})
    preds = physics.guard_forecast({f: F.col(f"_{f}") for f in FEATURES}, F.col("_sky"), specs)
    return rows.select(
        "station_id",
        "ts",
        "model_version",
        F.col("ts_ref").alias("created_at"),
        (F.col("ts_ref") - times.minutes((lookback - 1) * step_minutes)).alias("ts_window_start"),
        F.col("ts_ref").alias("ts_window_stop"),
        (F.col("_h") + 1).alias("horizon"),
        *[preds[f].alias(f"pred_{f}") for f in FEATURES],
    )


def fit_ridge(
    rows: DataFrame,
    lookback: int = 24,
    horizon: int = 6,
    penalty: float = 1.0,
    share: float = 0.8,
    step_minutes: int = 60,
    inputs=INPUT_FEATURES,
    targets=FEATURES,
) -> DataFrame:
    """Fits every station on the first `share` of its samples, in one pass over its rows.

    Weights, both scalers (which see training samples only), the number of training samples, cut_ts and
    the mean square error over the held-out samples all come from the moments of station months. No
    window is stored, none is scored and no sample reaches the driver.
    """
    narrow = windows.month_rows(rows, lookback, horizon, step_minutes, inputs, targets)
    cut = windows.split_of_rows(rows, lookback, horizon, share, step_minutes).select("station_id", "cut_ts")
    parts = moments.month_moments(narrow, lookback, horizon, step_minutes, cut)
    return moments.fit(parts, lookback, horizon, len(inputs), penalty).join(cut, "station_id")


def train_and_score(
    rows: DataFrame,
    lookback: int = 24,
    horizon: int = 6,
    penalty: float = 1.0,
    share: float = 0.8,
    step_minutes: int = 60,
    inputs=INPUT_FEATURES,
    targets=FEATURES,
    store=lambda model: model,
) -> tuple[DataFrame, DataFrame]:
    """Fits on the first `share` of samples, scores every sample. Returns (model with its cut, scored).

    `store` writes the model and reads it back, so that whoever reads the scores doesn't fit again. `rows`
    are read more than once: pass the stored feature rows.
    """
    model = store(fit_ridge(rows, lookback, horizon, penalty, share, step_minutes, inputs, targets))
    narrow = windows.month_rows(
        rows.withColumn("_origin", F.lit(True)), lookback, horizon, step_minutes, inputs, targets,
        keep=("latitude", "longitude", "_origin"),
    )
    return model, score_known(narrow, model, lookback, horizon, targets)


def score_known(narrow: DataFrame, model: DataFrame, lookback: int, horizon: int, targets=FEATURES) -> DataFrame:
    """Scores of windows with a known future, and whether they were trained on."""
    scored = score(narrow, model, lookback, horizon, targets)
    is_train = F.coalesce(F.col("ts_ref") <= F.col("cut_ts"), F.lit(False))
    return scored.withColumn("is_train", is_train).drop("cut_ts")


def registry_rows(model: DataFrame, rows: DataFrame, base: str, trained_at) -> DataFrame:
    """One registry row per fitted station: version, sample count, last telemetry hour, validation error
    (that of the very model, over the samples that were held out, over all where none were)."""
    at = times.instant(trained_at)
    last = rows.groupBy("station_id").agg(F.max("ts").alias("last_ts"))
    return model.join(last, "station_id").select(
        "station_id",
        version_name(base, F.date_format("last_ts", "yyyy_MM"), at).alias("model_version"),
        at.alias("trained_at"),
        "last_ts",
        F.col("n_samples").cast("bigint").alias("train_samples_count"),
        "metrics_mse",
        F.lit(1).alias("is_active"),
    )


def infer(
    rows: DataFrame,
    models: DataFrame,
    registry: DataFrame,
    lookback: int = 24,
    step_minutes: int = 60,
    origins=None,
    inputs=INPUT_FEATURES,
    targets=FEATURES,
) -> DataFrame:
    """Predicted deltas by each station's active model, from windows that end at the given origins.

    rows: feature rows filled from the past alone. models: station_id, model_version, weights and
    scalers. origins: a condition on `ts_ref`; None takes the newest window of every station, and only
    the rows it needs are kept. Nothing is fitted. Stations without an active model or a whole window
    have no row.
    """
    active = active_models(registry).select("station_id", "model_version")
    model = models.join(active, ["station_id", "model_version"])
    if origins is None:
        last = rows.groupBy("station_id").agg(F.max("ts").alias("_last"))
        reach = F.col("_last") - times.minutes((lookback - 1) * step_minutes)
        rows = rows.join(last, "station_id").where(F.col("ts") >= reach)
        chosen = F.col("ts") == F.col("_last")
    else:
        rows, chosen = rows.withColumn("ts_ref", F.col("ts")), origins
    narrow = windows.month_rows(
        rows.withColumn("_origin", chosen), lookback, 0, step_minutes, inputs, targets, ("latitude", "longitude", "_origin")
    )
    return score(narrow, model, lookback, 0, targets)


def rmse(scored: DataFrame, by=()) -> DataFrame:
    """Root mean square error of the deltas, over everything or per horizon / feature / split."""
    steps = scored.select(
        *[c for c in ("station_id", "is_train") if c in scored.columns],
        F.posexplode(F.arrays_zip("delta", "y")).alias("_h", "s"),
    ).select("*", (F.col("_h") + 1).alias("horizon"), F.posexplode(F.arrays_zip("s.delta", "s.y")).alias("_j", "v"))
    names = F.array(*[F.lit(f) for f in FEATURES])
    err = F.col("v")["delta"] - F.col("v")["y"]
    return (
        steps.withColumn("feature", names[F.col("_j")])
        .groupBy(*by)
        .agg(F.count("*").alias("n"), F.sqrt(F.avg(err * err)).alias("rmse"))
    )


def backtest_origins(begin, end, every_hours: int = 6):
    """Origins from begin to before end, every k hours, as a condition on `ts_ref`."""
    since = times.seconds_between(times.instant(begin), F.col("ts_ref"))
    inside = (F.col("ts_ref") >= times.instant(begin)) & (F.col("ts_ref") < times.instant(end))
    return inside & (since % (every_hours * 3600) == 0)


def _hour_means(hourly: DataFrame, features=FEATURES) -> DataFrame:
    """Each hour with the means of its hour of day over all days up to it, `mean_{feature}`.

    Days before the month come from a table of one row per station, hour of day and month, so a
    task holds a month of one hour of day.
    """
    rows = hourly.select("station_id", "ts", *features).withColumns({"_hour": F.hour("ts"), "_month": F.trunc("ts", "MM")})
    sums = [x for f in features for x in (F.sum(f).alias(f"_s_{f}"), F.count(f).alias(f"_n_{f}"))]
    months = rows.groupBy("station_id", "_hour", "_month").agg(*sums)
    before = W.partitionBy("station_id", "_hour").orderBy("_month").rowsBetween(W.unboundedPreceding, -1)
    earlier = [F.coalesce(F.sum(f"_{k}_{f}").over(before), F.lit(0)).alias(f"_{k}_{f}") for f in features for k in "sn"]
    months = months.select("station_id", "_hour", "_month", *earlier)
    upto = W.partitionBy("station_id", "_hour", "_month").orderBy("ts").rowsBetween(W.unboundedPreceding, 0)
    inside = {f"_i{k}_{f}": fn(f).over(upto) for f in features for k, fn in (("s", F.sum), ("n", F.count))}
    total = lambda f: F.col(f"_s_{f}") + F.coalesce(f"_is_{f}", F.lit(0.0))
    count = lambda f: F.col(f"_n_{f}") + F.col(f"_in_{f}")
    return (
        rows.withColumns(inside)
        .join(months, ["station_id", "_hour", "_month"])
        .select("station_id", "ts", *[F.try_divide(total(f), count(f)).alias(f"mean_{f}") for f in features])
    )


def baseline_forecasts(hourly: DataFrame, horizon: int = 6, lookback: int = 24) -> DataFrame:
    """Persistence (last value) and climatology (mean of the target's hour of day) forecasts.

    Both know nothing from behind their origin. The last hour of the target's hour of day lies whole
    days before the target, so climatology rows are the running means moved ahead, and no join is
    needed; targets without such an hour have no climatology. `hourly` is dense.
    """
    steps = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon")
    hours = lambda n, ts: F.timestamp_add("HOUR", n, ts)
    last = hourly.select("station_id", F.col("ts").alias("created_at"), steps, *[F.col(f).alias(f"pred_{f}") for f in FEATURES])
    last = last.withColumn("ts", hours(F.col("horizon"), times.floor_hour(F.col("created_at"))))
    ends = hourly.groupBy("station_id").agg(F.max("ts").alias("_end"))
    days = (F.ceil(F.col("horizon") / 24) * 24).cast("int")
    target, made = hours(days, F.col("ts")), hours(days - F.col("horizon"), F.col("ts"))
    typical = (
        _hour_means(hourly)
        .join(ends, "station_id")
        .select("*", steps)
        .where(made <= F.col("_end"))
        .select("station_id", made.alias("created_at"), "horizon", *[F.col(f"mean_{f}").alias(f"pred_{f}") for f in FEATURES], target.alias("ts"))
    )
    both = last.withColumn("model_version", F.lit("persistence")).unionByName(
        typical.withColumn("model_version", F.lit("climatology"))
    )
    return both.select(
        "station_id",
        "ts",
        "model_version",
        "created_at",
        (F.col("created_at") - times.minutes((lookback - 1) * 60)).alias("ts_window_start"),
        F.col("created_at").alias("ts_window_stop"),
        "horizon",
        *[f"pred_{f}" for f in FEATURES],
    )


def register(registry: DataFrame, new: DataFrame) -> DataFrame:
    """Adds model rows; the newest per station becomes the only active one, nothing is dropped."""
    rows = registry.drop("is_active").unionByName(new.drop("is_active"), allowMissingColumns=True)
    newest = rows.groupBy("station_id").agg(
        F.max_by("model_version", F.struct("trained_at", "model_version")).alias("_active")
    )
    return (
        rows.join(newest, "station_id")
        .withColumn("is_active", (F.col("model_version") == F.col("_active")).cast("int"))
        .drop("_active")
    )


def version_name(base: str, period, trained_at):
    """`{base}_{YYYY_MM}_{yyyymmdd_HHMM}`."""
    return F.concat_ws("_", F.lit(base), period, F.date_format(trained_at, "yyyyMMdd_HHmm"))


def active_models(registry: DataFrame) -> DataFrame:
    """Latest active model row per station."""
    rest = [c for c in registry.columns if c != "station_id"]
    best = F.max_by(F.struct(*rest), F.struct("trained_at", "model_version")).alias("m")
    return registry.where("is_active = 1").groupBy("station_id").agg(best).select("station_id", "m.*")


def retrain_due(stations: DataFrame, registry: DataFrame, telemetry_periods: DataFrame, as_of) -> DataFrame:
    """Per station: no active model -> due; trained too recently -> not due; else due when a
    newer month of telemetry exists.

    `stations`: station_id, min_training_days. `telemetry_periods`: station_id, last_period (YYYY-MM).
    """
    active = active_models(registry).select("station_id", "trained_at", "last_ts")
    rows = stations.join(active, "station_id", "left").join(telemetry_periods, "station_id", "left")
    age = F.floor(times.seconds_between(F.col("trained_at"), times.instant(as_of)) / 86400)
    newer = F.col("last_period") > times.month_of(F.col("last_ts"))
    reason = (
        F.when(F.col("trained_at").isNull(), "no_model")
        .when(age < F.col("min_training_days"), "too_recent")
        .when(newer, "newer_period")
        .otherwise("up_to_date")
    )
    return rows.withColumn("age_days", age).withColumn("reason", reason).withColumn(
        "is_due", F.col("reason").isin("no_model", "newer_period")
    )
