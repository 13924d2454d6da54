"""Reconciliation with observations, quality and consensus marts, drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meteospark.catalog import FEATURES
from meteospark.functions import physics, times
from meteospark.operators import profiling

KEY = ("station_id", "ts")


def reconcile(forecast: DataFrame, matches: DataFrame, bias: DataFrame) -> DataFrame:
    """Closes forecast rows for which an observation exists; other rows stay as they are.

    diff = prediction - observation, drift = diff - bias. Observations arrive days before the
    reanalysis, so every run computes anew from what is there: a stored value is kept only where
    its input is missing, and a bias that was never known counts as zero. Running it again on the
    same inputs changes nothing.
    """
    have = set(forecast.columns)
    actual = matches.select(*KEY, F.lit(True).alias("_observed"), *[F.col(f"{f}_eco").alias(f"_a_{f}") for f in FEATURES])
    known_bias = bias.select(*KEY, *[F.col(f"bias_{f}").alias(f"_b_{f}") for f in FEATURES])
    rows = forecast.join(actual, list(KEY), "left").join(known_bias, list(KEY), "left")
    seen = F.col("_observed").isNotNull()
    old = lambda name: F.col(name) if name in have else F.lit(None).cast("double")
    out = []
    for f in FEATURES:
        actual = F.coalesce(F.col(f"_a_{f}"), old(f"actual_{f}"))
        diff = F.coalesce(F.col(f"pred_{f}") - actual, old(f"diff_{f}"))
        base = F.coalesce(F.col(f"_b_{f}"), old(f"historical_bias_{f}"), F.when(seen, F.lit(0.0)))
        out += [
            actual.alias(f"actual_{f}"),
            diff.alias(f"diff_{f}"),
            base.alias(f"historical_bias_{f}"),
            (diff - base).alias(f"drift_vs_bias_{f}"),
        ]
    replaced = {f"{p}_{f}" for p in ("actual", "diff", "historical_bias", "drift_vs_bias") for f in FEATURES}
    kept = [c for c in forecast.columns if c not in replaced and c != "drift_vs_bias"]
    return rows.select(*kept, *out).withColumn("drift_vs_bias", F.col("drift_vs_bias_temp"))


def quality_mart(
    forecast: DataFrame,
    staged: DataFrame,
    bias: DataFrame,
    as_of=None,
    high_water=None,
    lookback_days: int = 3,
) -> DataFrame:
    """Predictions against observations and reanalysis, one row per forecast row.

    `as_of` hides forecasts made later. `high_water` (a one-row DataFrame column `high_water`)
    limits an incremental run to forecasts made since that time less the lookback.
    """
    if as_of is not None:
        forecast = forecast.where(F.col("created_at") <= times.instant(as_of))
    if high_water is not None:
        forecast = since_high_water(forecast, high_water, "created_at", lookback_days)
    preds = forecast.select(
        "station_id",
        "ts",
        "model_version",
        "created_at",
        *[
            (
                F.when(F.col(f"pred_{f}") > 0, F.col(f"pred_{f}")).otherwise(0.0)
                if f in ("solar", "rain")
                else F.col(f"pred_{f}")
            ).alias(f"pred_{f}")
            for f in FEATURES
        ],
    )
    actual = staged.where(F.col("temp").isNotNull()).select(*KEY, *[F.col(f).alias(f"actual_{f}") for f in FEATURES])
    era5 = bias.select(*KEY, *[F.col(f"era5_{f}").alias(f"{f}_era5") for f in FEATURES])
    rows = preds.join(actual, list(KEY), "left").join(era5, list(KEY), "left")
    p, a, e = (lambda f: F.col(f"pred_{f}")), (lambda f: F.col(f"actual_{f}")), (lambda f: F.col(f"{f}_era5"))
    return rows.select(
        "*",
        *[(p(f) - a(f)).alias(f"delta_{f}") for f in FEATURES],
        *[F.abs(p(f) - e(f)).alias(f"abs_error_{f}") for f in FEATURES],
        *[physics.percent_error(p(f), e(f)).alias(f"perc_error_{f}") for f in FEATURES],
    )


def high_water(target: DataFrame, at: str = "ts") -> DataFrame:
    """One row with the newest time of a target table, 1970 when it is empty."""
    return target.agg(F.coalesce(F.max(at), times.instant("1970-01-01 00:00:00")).alias("high_water"))


def since_high_water(df: DataFrame, mark: DataFrame, at: str, lookback_days: int = 0) -> DataFrame:
    """Rows at or after the mark less the lookback."""
    start = F.col("high_water") - F.expr(f"INTERVAL '{int(lookback_days)}' DAY")
    return df.where(F.col(at) >= mark.select(start).scalar())


def after_high_water(df: DataFrame, mark: DataFrame, at: str = "ts") -> DataFrame:
    """Rows strictly after the mark, read as a scalar subquery.

    In a table with months the mark's month bounds the partitions that are opened.
    """
    newer = df.where(F.col(at) > mark.select("high_water").scalar())
    if "month" not in df.columns:
        return newer
    return newer.where(F.col("month") >= mark.select(times.month_of(F.col("high_water"))).scalar())


def consensus(forecast: DataFrame, mark: DataFrame | None = None) -> DataFrame:
    """Votes, mean and population deviation of all runs per station, model version and target."""
    if mark is not None:
        forecast = after_high_water(forecast, mark)
    return forecast.groupBy("station_id", "model_version", "ts").agg(
        F.count("*").alias("n_votes"),
        *[F.avg(f"pred_{f}").alias(f"consensus_{f}") for f in FEATURES],
        *[F.stddev_pop(f"pred_{f}").alias(f"std_{f}") for f in FEATURES],
    )


def drift_summary(reconciled: DataFrame, limit: float = 1.5) -> DataFrame:
    """Mean prediction and difference and number of drifting rows per model and feature."""
    one = lambda f: F.struct(
        F.lit(f).alias("feature"),
        F.col(f"pred_{f}").alias("pred"),
        F.col(f"diff_{f}").alias("diff"),
        F.col(f"drift_vs_bias_{f}").alias("drift"),
    )
    long = reconciled.select("station_id", "model_version", F.inline(F.array(*[one(f) for f in FEATURES])))
    return long.groupBy("station_id", "model_version", "feature").agg(
        F.avg("pred").alias("avg_pred"),
        F.avg("diff").alias("avg_diff"),
        F.count_if(F.abs("drift") > limit).alias("n_drift"),
    )


def last_actual_plus_delta(hourly: DataFrame, deltas: DataFrame, horizon: int = 6) -> DataFrame:
    """Adds each station's last observation to every horizon step of its deltas.

    `deltas`: station_id, horizon, delta_{feature}.
    """
    last = profiling.latest_rows(hourly, 1).select("station_id", F.col("ts").alias("origin"), *FEATURES)
    return last.join(deltas, "station_id").select(
        "station_id",
        "origin",
        "horizon",
        F.timestamp_add("HOUR", F.col("horizon"), times.floor_hour(F.col("origin"))).alias("ts"),
        *[(F.col(f) + F.col(f"delta_{f}")).alias(f"pred_{f}") for f in FEATURES],
    )
