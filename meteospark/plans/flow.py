"""The pipeline as functions from tables to tables; months are partitions of one job."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from meteospark.catalog import FEATURES, INPUT_FEATURES
from meteospark.functions import times
from meteospark.operators import evaluation, matching, model, moments, resample, serving, windows
from meteospark.session import run_folder
from meteospark.sources import sinks


@dataclass
class Settings:
    """Run parameters; `as_of` replaces the clock."""

    as_of: str
    offset: float = -1.5
    step_minutes: int = 60
    max_interpolate_hours: float = 2
    lookback: int = 24
    horizon: int = 6
    penalty: float = 1.0
    share: float = 0.8
    model_name: str = "ridge"


def prepare(
    telemetry: DataFrame,
    grid: DataFrame,
    stations: DataFrame,
    s: Settings,
    folder: str,
    known_cells: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Clean hours, matches and bias. Hours and matches are stored, as the marts read them often.

    A station's own offset (column `temp_offset` of `stations`) comes before the setting.
    """
    known, offset = as_known(telemetry, stations, s)
    hourly = resample.clean_hourly(known, offset, s.max_interpolate_hours, s.step_minutes)
    hourly = sinks.materialise(hourly, folder, "hourly")
    matches = sinks.materialise(matching.match(hourly, grid, stations, known_cells), folder, "matches")
    return {"hourly": hourly, "matches": matches, "bias": matching.bias_table(matches)}


def as_known(telemetry: DataFrame, stations: DataFrame, s: Settings):
    """The telemetry up to `as_of`, and the sensor offset: a station's own (`temp_offset`) before the setting."""
    known = telemetry.where(F.col("ts") <= times.instant(s.as_of))
    if "temp_offset" not in stations.columns:
        return known, s.offset
    known = known.join(stations.select("station_id", "temp_offset"), "station_id", "left")
    return known, F.coalesce("temp_offset", F.lit(float(s.offset)))


def observed_hours(telemetry: DataFrame, stations: DataFrame, s: Settings) -> DataFrame:
    """Hourly means as they were known at `as_of`: the same offsets as in training, guardrails, but nothing
    interpolated. Predictions from them use nothing that came later."""
    known, offset = as_known(telemetry, stations, s)
    return resample.guard_series(resample.resample(resample.apply_offset(known, offset), s.step_minutes))


def training_rows(hourly: DataFrame, stations: DataFrame) -> DataFrame:
    """Gap-free feature rows for a fit; gaps are filled from both sides."""
    return windows.feature_rows(resample.interpolate_all(hourly), stations)


def known_rows(observed: DataFrame, stations: DataFrame, s: Settings) -> DataFrame:
    """Feature rows for predictions; gaps are filled from the past alone."""
    return windows.feature_rows(resample.fill_past(observed, s.step_minutes), stations)


def train(
    hourly: DataFrame,
    stations: DataFrame,
    s: Settings,
    folder: str,
    inputs=INPUT_FEATURES,
    targets=FEATURES,
) -> dict[str, DataFrame]:
    """Fits every station on the hours given: models (weights, both scalers), registry rows, scored samples.

    The narrow feature rows and the fitted models are stored in the shared folder: one fit gives models,
    registry errors and scores. Windows are views inside a task. Store `models` and `registry` to predict
    later without a fit.
    """
    rows = sinks.materialise(training_rows(hourly, stations), folder, "features")
    fitted, scored = model.train_and_score(
        rows, s.lookback, s.horizon, s.penalty, s.share, s.step_minutes, inputs, targets,
        store=lambda m: sinks.materialise(m, folder, "fitted"),
    )
    registry = model.registry_rows(fitted, rows, s.model_name, s.as_of)
    registry = sinks.materialise(registry, folder, "registry")
    models = fitted.drop("cut_ts", "metrics_mse").join(registry.select("station_id", "model_version"), "station_id")
    return {"models": models, "registry": registry, "scored": scored}


def all_moments(spark: SparkSession, features_path: str, moments_path: str, s: Settings, inputs=INPUT_FEATURES, targets=FEATURES) -> None:
    """The moments of every station month of stored feature rows, as a table by month."""
    rows = sinks.read_table(spark, features_path)
    narrow = windows.month_rows(rows, s.lookback, s.horizon, s.step_minutes, inputs, targets)
    parts = moments.month_moments(narrow, s.lookback, s.horizon, s.step_minutes)
    sinks.replace_rows(spark, moments_path, None, parts, ["station_id", "kind"], at="block")


def update_moments(spark: SparkSession, features_path: str, moments_path: str, month: str, s: Settings, inputs=INPUT_FEATURES, targets=FEATURES) -> None:
    """Computes the moments that a new or changed month of stored feature rows touches, and replaces them.

    features_path: feature rows by month (`sinks.upsert`). Only the month and the edges of its neighbours
    that share windows with it are read; other months' moments stay. A refit is `refit`.
    """
    reach = times.minutes((s.lookback + s.horizon) * s.step_minutes)
    start = times.instant(f"{month}-01 00:00:00")
    end = start + F.expr("INTERVAL '1' MONTH")
    day = F.expr("INTERVAL '1' DAY")
    near = F.col("month").between(times.month_of(start - day), times.month_of(end))
    rows = sinks.read_table(spark, features_path).where(near & (F.col("ts") >= start - reach) & (F.col("ts") < end + reach))
    narrow = windows.month_rows(rows, s.lookback, s.horizon, s.step_minutes, inputs, targets)
    fresh = moments.changed(moments.month_moments(narrow, s.lookback, s.horizon, s.step_minutes), month)
    fresh = sinks.materialise(fresh, run_folder(spark), "moments")
    gone = None
    if sinks.table_exists(spark, moments_path):
        months = [r.m for r in spark.range(1).select(F.explode(F.array(*[times.month_of(t) for t in (start - day, start, end)])).alias("m")).collect()]
        held = sinks.read_table(spark, moments_path, months).select("station_id", "block", "kind", "month")
        gone = moments.changed(held, month).select("station_id", "kind", "month")
    sinks.replace_rows(spark, moments_path, gone, fresh, ["station_id", "kind"], at="block")


def refit(spark: SparkSession, moments_path: str, s: Settings, split, width: int = len(INPUT_FEATURES)) -> DataFrame:
    """Models from the stored moments: sums and solves, no feature row is read. Samples whose future ends
    before `split` (the start of a month) train, the others give the validation error."""
    parts = sinks.read_table(spark, moments_path).drop("month")
    return moments.fit(parts, s.lookback, s.horizon, width, s.penalty, split)


def predict(
    observed: DataFrame, stations: DataFrame, models: DataFrame, registry: DataFrame, s: Settings, origins=None
) -> dict[str, DataFrame]:
    """Forecasts by the stored active models: from the newest hours, or from all chosen origins."""
    rows = known_rows(observed, stations, s)
    scored = model.infer(rows, models, registry, s.lookback, s.step_minutes, origins)
    usable, rejected = model.split_rejects(scored)
    version = F.col("model_version")
    return {"forecast": model.to_forecast(usable, version, s.step_minutes, s.lookback), "rejected": rejected}


def run_due(
    telemetry: DataFrame, stations: DataFrame, registry: DataFrame, models: DataFrame, s: Settings, folder: str, inputs=INPUT_FEATURES, targets=FEATURES
) -> dict[str, DataFrame]:
    """One scheduled run as of the clock: stations that are due are fitted anew, then every station is
    predicted from its newest hours by the model that is now active.

    stations: station_id, place, min_training_days (and temp_offset). registry and models: what earlier runs
    have stored; nothing is dropped from either. Returns due (with reasons), registry, models and scored.
    """
    known, offset = as_known(telemetry, stations, s)
    hourly = sinks.materialise(resample.clean_hourly(known, offset, s.max_interpolate_hours, s.step_minutes), folder, "hourly")
    periods = hourly.groupBy("station_id").agg(times.month_of(F.max("ts")).alias("last_period"))
    due = model.retrain_due(stations.select("station_id", "min_training_days"), registry, periods, s.as_of)
    due = sinks.materialise(due, folder, "due")
    mine = hourly.join(due.where("is_due").select("station_id"), "station_id", "left_semi")
    fit = train(mine, stations, s, folder, inputs, targets)
    registry = sinks.materialise(model.register(registry, fit["registry"]), folder, "registry_now")
    models = sinks.materialise(models.unionByName(fit["models"], allowMissingColumns=True), folder, "models_now")
    rows = known_rows(observed_hours(telemetry, stations, s), stations, s)
    scored = model.infer(rows, models, registry, s.lookback, s.step_minutes, None, inputs, targets)
    return {"due": due, "registry": registry, "models": models, "scored": scored}


def backtest(
    telemetry: DataFrame,
    stations: DataFrame,
    begin,
    end,
    every_hours: int,
    s: Settings,
    folder: str,
    refit_days: int | None = 7,
    inputs=INPUT_FEATURES,
    targets=FEATURES,
) -> DataFrame:
    """Scored origins in [begin, end), each by a model that saw only what lies before it.

    Walk-forward: each block of `refit_days` days has a model of its own, fitted on all blocks before it;
    the blocks' moments are computed once and added up in order. Rows are filled from the past alone.
    With None one model, fitted on what lies before `begin`, serves all origins.
    """
    seen = replace(s, as_of=str(end))
    known = telemetry.where(F.col("ts") < times.instant(end))
    observed = observed_hours(known, stations, seen)
    origins = model.backtest_origins(begin, end, every_hours)
    if refit_days is None:
        early = telemetry.where(F.col("ts") < times.instant(begin))
        early, offset = as_known(early, stations, s)
        hourly = resample.clean_hourly(early, offset, s.max_interpolate_hours, s.step_minutes)
        fit = train(sinks.materialise(hourly, folder, "hourly"), stations, s, folder, inputs, targets)
        rows = known_rows(observed, stations, s)
        return model.infer(rows, fit["models"], fit["registry"], s.lookback, s.step_minutes, origins, inputs, targets)
    rows = sinks.materialise(known_rows(observed, stations, s), folder, "known")
    whole = rows.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in dict.fromkeys([*inputs, *targets])]))
    blocks = windows.month_rows(whole, s.lookback, s.horizon, s.step_minutes, inputs, targets, block_days=refit_days)
    parts = moments.month_moments(blocks, s.lookback, s.horizon, s.step_minutes, block_days=refit_days)
    models = moments.walk_forward(parts, begin, end, s.lookback, s.horizon, len(inputs), s.penalty, refit_days, s.model_name)
    models = sinks.materialise(models, folder, "walked")
    chosen = whole.withColumn("ts_ref", F.col("ts")).withColumn("_origin", origins)
    narrow = windows.month_rows(
        chosen, s.lookback, 0, s.step_minutes, inputs, targets, ("latitude", "longitude", "_origin"), refit_days
    )
    return model.score(narrow, models, s.lookback, 0, targets, refit_days)


def backtest_forecasts(telemetry: DataFrame, stations: DataFrame, begin, end, every_hours: int, s: Settings, folder: str, refit_days: int | None = 7) -> DataFrame:
    """The forecasts of `backtest`, guardrails applied."""
    usable, _ = model.split_rejects(backtest(telemetry, stations, begin, end, every_hours, s, folder, refit_days))
    return model.to_forecast(usable, F.col("model_version"), s.step_minutes, s.lookback)


def evaluate(
    forecast_rows: DataFrame, hourly: DataFrame, matches: DataFrame, bias: DataFrame, s: Settings
) -> dict[str, DataFrame]:
    """Reconciled forecasts, quality and consensus marts, public table."""
    reconciled = evaluation.reconcile(forecast_rows, matches, bias)
    mart = evaluation.quality_mart(forecast_rows, hourly, bias, as_of=s.as_of)
    return {
        "reconciled": reconciled,
        "quality": mart,
        "consensus": evaluation.consensus(forecast_rows),
        "public": serving.public_export(reconciled, mart),
    }
