"""Public table and read-side queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meteospark.catalog import FEATURES, PUBLIC_COLUMNS
from meteospark.functions import cleaning, physics, times
from meteospark.operators import profiling, quality

PUBLIC_KEY = ("station_id", "ts", "model_version")


def most_complete(df: DataFrame, key=PUBLIC_KEY) -> DataFrame:
    """One row per key: most filled columns, then latest created_at, a missing one winning.

    A maximum over one struct, so copies of a hot key combine before the shuffle.
    """
    rest = [c for c in df.columns if c not in key]
    filled = profiling.non_null_count(df.columns)
    tie = [c for c in rest if c != "created_at"]
    rank = F.struct(filled, F.col("created_at").isNull(), "created_at", *tie)
    return (
        df.groupBy(*key).agg(F.max_by(F.struct(*rest), rank).alias("_row")).select(*key, "_row.*").select(*df.columns)
    )


def public_export(forecast: DataFrame, mart: DataFrame) -> DataFrame:
    """Forecast rows with their benchmark and errors, one per station, time and version."""
    for df in (forecast, mart):
        quality.require_columns(df, PUBLIC_KEY)
    errors = mart.select(
        *PUBLIC_KEY, "created_at", *[f"{f}_era5" for f in FEATURES], *[f"abs_error_{f}" for f in FEATURES]
    )
    # forecasts of all origins are kept, so a mart row belongs to one run; it may lack created_at
    run = F.coalesce("created_at", times.instant("1970-01-01"))
    left = forecast.withColumn("_run", run)
    right = errors.withColumn("_run", run).drop("created_at")
    joined = left.join(right, [*PUBLIC_KEY, "_run"], "left")
    return most_complete(joined.select("station_id", *PUBLIC_COLUMNS))


def feature_day(public: DataFrame, feature: str, day: str, zone: str) -> DataFrame:
    """The columns of one feature for one local day, with display time."""
    start, end = times.local_day_bounds(day, zone)
    names = [f"pred_{feature}", f"diff_{feature}", f"historical_bias_{feature}", f"drift_vs_bias_{feature}"]
    names += [f"{feature}_era5", f"abs_error_{feature}"]
    names += [c for c in (f"actual_{feature}",) if c in public.columns]
    rows = public.where((F.col("ts") >= start) & (F.col("ts") < end))
    return rows.select(
        "station_id",
        "ts",
        "created_at",
        times.to_local(F.col("ts"), zone).alias("ts_local"),
        *[cleaning.to_number(c).alias(c) for c in names],
    )


def latest_per_hour(df: DataFrame, tie=()) -> DataFrame:
    """Latest created row per station and hour."""
    rows = df.withColumn("ts", times.floor_hour(F.col("ts")))
    rest = [c for c in rows.columns if c not in ("station_id", "ts")]
    rank = F.struct("created_at", *tie)
    return rows.groupBy("station_id", "ts").agg(F.max_by(F.struct(*rest), rank).alias("_r")).select("station_id", "ts", "_r.*")


def daily_series(public: DataFrame, zone: str, features=FEATURES) -> DataFrame:
    """Prediction, observation and reanalysis per station, hour and feature, in local days.

    The latest run of an hour counts. A missing observation is rebuilt from prediction and
    difference, then clipped.
    """
    rows = latest_per_hour(public, tie=("model_version",))
    local = times.to_local(F.col("ts"), zone)

    def one(f):
        actual = F.col(f"pred_{f}") - F.col(f"diff_{f}")
        if f"actual_{f}" in public.columns:
            actual = F.coalesce(F.col(f"actual_{f}"), actual)
        return F.struct(
            F.lit(f).alias("feature"),
            F.col(f"pred_{f}").alias("pred"),
            physics.clip_for_display(f, actual).alias("actual"),
            F.col(f"{f}_era5").alias("era5"),
            F.col(f"abs_error_{f}").alias("abs_error"),
            F.col(f"historical_bias_{f}").alias("bias"),
            F.col(f"drift_vs_bias_{f}").alias("drift"),
        )

    return rows.select(
        "station_id",
        "ts",
        local.alias("ts_local"),
        F.to_date(local).alias("local_day"),
        F.inline(F.array(*[one(f) for f in features])),
    )


def daily_kpis(series: DataFrame) -> DataFrame:
    """Error against reanalysis, mean bias and drift per station, local day and feature."""
    return series.groupBy("station_id", "local_day", "feature").agg(
        F.avg("abs_error").alias("mae_era5"),
        F.coalesce(F.avg("bias"), F.lit(0.0)).alias("mean_bias"),
        F.coalesce(F.avg("drift"), F.lit(0.0)).alias("mean_drift"),
        F.bool_or(F.col("era5").isNotNull()).alias("has_era5"),
    )


def available_dates(public: DataFrame, zone: str = "UTC") -> DataFrame:
    """Distinct local dates, newest first."""
    day = F.to_date(times.to_local(F.col("ts"), zone))
    return public.select(day.alias("day")).distinct().orderBy(F.col("day").desc())


def inspector(public: DataFrame, n: int | None = None) -> DataFrame:
    """One row per forecast row and feature with formatted values and drift label.

    `n` keeps the latest n target times, returned in time order.
    """
    if n is not None:
        newest = public.select("ts").distinct().orderBy(F.col("ts").desc()).limit(n)
        public = public.join(newest, "ts", "left_semi")
    text = cleaning.two_decimals

    def one(f):
        pred, diff, era5 = F.col(f"pred_{f}"), F.col(f"diff_{f}"), F.col(f"{f}_era5")
        return F.struct(
            F.lit(f).alias("feature"),
            text(pred).alias("pred"),
            text(pred - diff).alias("actual"),
            cleaning.signed(diff).alias("diff"),
            text(era5).alias("era5"),
            cleaning.signed(pred - era5).alias("err_era5"),
            cleaning.signed(F.col(f"historical_bias_{f}")).alias("bias"),
            cleaning.drift_label(F.col(f"drift_vs_bias_{f}")).alias("drift_status"),
        )

    out = public.select("station_id", "ts", "model_version", F.inline(F.array(*[one(f) for f in FEATURES])))
    return out if n is None else out.orderBy("ts", "station_id", "model_version", "feature")
