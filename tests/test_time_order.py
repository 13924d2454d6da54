"""Nothing looks ahead, stored models are used without a fit, keyed reads are bounded."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import SparkSession, functions as F

from meteospark import session
from meteospark.catalog import CSV_COLUMNS, FEATURES
from meteospark.functions import times
from meteospark.operators import evaluation, model, spans
from meteospark.plans import flow
from meteospark.sources import files, sinks
from tests.helpers import frame, hours

KEY = ["station_id", "ts"]
PLACES = pd.DataFrame({"station_id": ["a", "b"], "latitude": [45.0, 46.0], "longitude": [9.0, 8.0]})


def telemetry(n=24 * 20):
    """Two stations, ten-minute means already hourly, some hours missing."""
    rows = pd.concat([hours(n, "2024-01-01", seed=i, station=s) for i, s in enumerate("ab")], ignore_index=True)
    return rows[np.random.default_rng(1).random(len(rows)) > 0.05]


def settings():
    return flow.Settings(as_of="2024-01-21 00:00:00", lookback=6, horizon=3)


def predictions(df):
    return df.orderBy("station_id", "created_at", "ts").toPandas()


def test_backtest_ignores_what_comes_later(spark):
    data = telemetry()
    begin, end = "2024-01-15 00:00:00", "2024-01-17 00:00:00"
    last_origin = pd.Timestamp("2024-01-16 18:00:00")
    changed = data.copy()
    changed.loc[changed["ts"] > last_origin, list(FEATURES)] += 50
    run = lambda d: predictions(
        flow.backtest_forecasts(frame(spark, d), frame(spark, PLACES), begin, end, 6, settings(), session.run_folder(spark))
    )
    one, two = run(data), run(changed)
    assert len(one) == 2 * 8 * 3 and one.equals(two)
    early = changed.copy()
    early.loc[early["ts"] < pd.Timestamp(begin), "temp"] += np.arange((early["ts"] < pd.Timestamp(begin)).sum()) % 5
    assert not one.equals(run(early))


def test_climatology_ignores_what_comes_later(spark):
    data = telemetry()
    data = data.set_index("ts").groupby("station_id")[list(FEATURES)].resample("h").ffill().reset_index()
    cut = pd.Timestamp("2024-01-10 05:00:00")
    changed = data.copy()
    changed.loc[changed["ts"] > cut, list(FEATURES)] += 50
    known = F.col("created_at") <= times.instant("2024-01-10 05:00:00")
    run = lambda d: model.baseline_forecasts(frame(spark, d)).where(known).orderBy("station_id", "created_at", "ts", "model_version").toPandas()
    one, two = run(data), run(changed)
    pd.testing.assert_frame_equal(one, two)
    row = one[(one.station_id == "a") & (one.model_version == "climatology") & (one.created_at == cut) & (one.horizon == 2)].iloc[0]
    past = data[(data.station_id == "a") & (data.ts <= cut) & (data.ts.dt.hour == 7)]
    assert row.pred_temp == pytest.approx(past.temp.mean())


def test_stored_models_predict_in_another_session(spark, monkeypatch):
    folder = session.run_folder(spark)
    data = telemetry()
    fit = flow.train(flow.resample.clean_hourly(frame(spark, data)), frame(spark, PLACES), settings(), folder)
    fit["models"].write.parquet(f"{folder}/models")
    fit["registry"].write.parquet(f"{folder}/registry")
    registry = {r.station_id: r for r in fit["registry"].collect()}
    assert registry["a"].model_version == "ridge_2024_01_20240121_0000" and registry["a"].metrics_mse > 0

    def no_fit(*_args, **_options):
        raise AssertionError("a prediction must not fit")

    monkeypatch.setattr(model, "fit_ridge", no_fit)
    other: SparkSession = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    observed = flow.observed_hours(frame(other, data), frame(other, PLACES), settings())
    out = flow.predict(
        observed, frame(other, PLACES), other.read.parquet(f"{folder}/models"), other.read.parquet(f"{folder}/registry"), settings()
    )["forecast"]
    rows = predictions(out)
    last = data.groupby("station_id")["ts"].max()
    assert len(rows) == 2 * 3 and set(rows.model_version) == {registry["a"].model_version}
    for station, own in rows.groupby("station_id"):
        assert list(own.ts) == [last[station] + pd.Timedelta(hours=h) for h in (1, 2, 3)]


def test_windows_without_a_past_are_rejected(spark):
    data = telemetry(24 * 6)
    fit = flow.train(flow.resample.clean_hourly(frame(spark, data)), frame(spark, PLACES), settings(), session.run_folder(spark))
    data.loc[data.station_id == "a", "rain"] = np.nan
    observed = flow.observed_hours(frame(spark, data), frame(spark, PLACES), settings())
    out = flow.predict(observed, frame(spark, PLACES), fit["models"], fit["registry"], settings())
    assert {r.station_id for r in out["forecast"].collect()} == {"b"}
    assert {r.station_id for r in out["rejected"].collect()} == {"a"}


def test_late_bias_replaces_an_assumed_one(spark):
    schema = "station_id string, ts timestamp_ntz"
    at = pd.Timestamp("2024-01-01").to_pydatetime()
    forecast = spark.createDataFrame([("a", at, *[5.0] * 6)], schema + "".join(f", pred_{f} double" for f in FEATURES))
    seen = spark.createDataFrame([("a", at, *[4.0] * 6)], schema + "".join(f", {f}_eco double" for f in FEATURES))
    bias = lambda v: spark.createDataFrame([("a", at, *[v] * 6)], schema + "".join(f", bias_{f} double" for f in FEATURES))
    first = evaluation.reconcile(forecast, seen, bias(None))
    assert (first.first().historical_bias_temp, first.first().drift_vs_bias_temp) == (0.0, 1.0)
    second = evaluation.reconcile(first, seen, bias(3.0)).first()
    assert (second.historical_bias_temp, second.drift_vs_bias_temp, second.drift_vs_bias) == (3.0, -2.0, -2.0)
    third = evaluation.reconcile(evaluation.reconcile(first, seen, bias(3.0)), seen.limit(0), bias(3.0).limit(0)).first()
    assert (third.actual_temp, third.historical_bias_temp, third.drift_vs_bias_temp) == (4.0, 3.0, -2.0)


def test_reads_are_bounded_by_months(spark, monkeypatch):
    path = session.run_folder(spark)
    sinks.upsert(spark, frame(spark, hours(3000, "2024-01-01")), path, KEY)
    plans = []
    write = sinks._write
    monkeypatch.setattr(sinks, "_write", lambda df, *a: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *a)))
    sinks.append_new(spark, frame(spark, hours(5, "2024-02-28")), path, KEY, ["temp"])
    sinks.delete_range(spark, path, "2024-03-01 00:00:00", "2024-03-02 00:00:00")
    bounded = lambda plan: any("month#" in part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:])
    assert len(plans) == 2 and all(map(bounded, plans))
    table = spark.read.parquet(path)
    newer = evaluation.after_high_water(table, evaluation.high_water(table.where("ts <= '2024-03-20'")))
    assert bounded(newer._jdf.queryExecution().executedPlan().toString())
    assert newer.count() == spark.read.parquet(path).where("ts > '2024-03-20 00:00:00'").count()


def test_updates_write_null(spark):
    path = session.run_folder(spark)
    sinks.upsert(spark, frame(spark, hours(10, "2024-01-01")), path, KEY)
    fresh = frame(spark, hours(3, "2024-01-01")).select(*KEY, F.lit(None).cast("double").alias("temp"), F.lit(2.0).alias("rh"))
    sinks.upsert(spark, fresh, path, KEY)
    out = spark.read.parquet(path)
    assert out.where("temp is null").count() == 3 and out.where("rh = 2").count() == 3 and out.where("pres is null").count() == 0


def test_an_outlier_leaves_slices_small(spark):
    rows = spark.range(20_000).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("v"))
    rows = rows.unionByName(spark.createDataFrame([("a", 1e9)], "k string, v double"))
    sizes = [r["count"] for r in spans.value_slices(rows, ["k"], "v").groupBy("_slice").count().collect()]
    assert sum(sizes) == 20_001 and max(sizes) < 20_000 / 256 * 4


def test_files_with_different_headers(spark, tmp_path):
    names = {v: k for k, v in CSV_COLUMNS.items()}
    time, epoch, temp, rh = (names[c] for c in ("ts_label", "epoch_timestamp", "outdoor_temperature_c", "outdoor_humidity"))
    (tmp_path / "2024-01.csv").write_text(f"{time},{epoch},{temp}\n2024-01-01 00:00,1704067200,1.5\n")
    (tmp_path / "2024-02.csv").write_text(f"{epoch},{time},{rh},Firmware\n1706745600,2024-02-01 00:00,55,x\n")
    rows = files.read_station_csv(spark, str(tmp_path)).orderBy("epoch_timestamp").collect()
    assert [(r.period, r.outdoor_temperature_c, r.outdoor_humidity) for r in rows] == [("2024-01", 1.5, None), ("2024-02", None, 55.0)]


def test_other_zones_are_refused(spark):
    with pytest.raises(ValueError):
        session.require_utc("Europe/Paris")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(ValueError):
            times.epoch_seconds(F.col("ts"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
