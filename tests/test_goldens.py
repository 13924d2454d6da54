"""Small inputs with known results."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meteospark import catalog
from meteospark.functions import cleaning, physics, times
from meteospark.operators import maintenance, matching, profiling, quality, resample, serving, staging, stations
from meteospark.operators import evaluation, model, windows
from tests.helpers import frame, hours, to_pandas


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


def test_epoch_label(spark):
    df = spark.createDataFrame([("a", 1785542400, "2026-08-01 02:00:00")], "station_id string, e long, l string")
    df = df.withColumn("l", F.col("l").cast("timestamp_ntz"))
    row = df.select(times.epoch_to_minute(F.col("e")).alias("ts")).first()
    assert row.ts == dt.datetime(2026, 8, 1, 0, 0)
    checked = staging.label_check(df, "Europe/Paris", "l", "e").first()
    assert (checked.n_rows, checked.n_mismatch) == (1, 0)


def test_epoch_after_2038(spark):
    assert one(spark, times.epoch_to_minute(F.lit(4102444859))) == dt.datetime(2100, 1, 1, 0, 0)


def test_gap_of_three_minutes(spark):
    pdf = pd.DataFrame({"station_id": "a", "ts": pd.to_datetime(["2026-01-01 00:00", "2026-01-01 00:01", "2026-01-01 00:05"])})
    rows = staging.gaps(frame(spark, pdf)).collect()
    assert [(r.gap_start.minute, r.gap_end.minute, r.missing_min) for r in rows] == [(2, 4, 3)]
    summary = staging.gap_summary(frame(spark, pdf)).first()
    assert (summary.expected, summary.missing, summary.longest, summary.is_breach) == (6, 3, 3, True)


@pytest.mark.parametrize("t,d,want", [(20.0, 20.0, 100.0), (10.0, 25.0, 100.0), (20.0, None, None), (float("nan"), 5.0, None)])
def test_relative_humidity(spark, t, d, want):
    got = one(spark, physics.relative_humidity(F.col("t"), F.col("d").cast("double")), t=t, d=d)
    assert got == want if want is None else got == pytest.approx(want)


@pytest.mark.parametrize(
    "feature,x,want",
    [("temp", 22.345, 22.3), ("rain", 0.02, 0.0), ("wind", 0.01, 0.0), ("wind", 2.45, 2.4), ("rh", 130.0, 130.0),
     ("rh", -3.0, 0.0), ("solar", 0.5, 0.0), ("solar", 1.5, 2.0), ("rain", None, None)],
)
def test_guard_feature(spark, feature, x, want):
    got = one(spark, physics.guard_feature(feature, F.col("x").cast("double")), x=x)
    assert got is None if want is None else got == pytest.approx(want, abs=1e-9)


def test_guard_forecast(spark):
    preds = {"temp": 22.345, "rh": 130.0, "pres": 1013.25, "wind": -1.0, "solar": 900.0, "rain": 0.04}
    for sky, solar in ((0.0, 0.0), (400.0, 400.0), (1200.0, 900.0)):
        out = physics.guard_forecast({f: F.lit(v) for f, v in preds.items()}, F.lit(sky))
        row = spark.range(1).select(*[c.alias(f) for f, c in out.items()]).first()
        assert (row.temp, row.rh, row.wind, row.rain, row.solar) == (22.3, 100.0, 0.0, 0.0, solar)
        assert row.pres == pytest.approx(1013.2)


def test_solar_formula(spark):
    ts = pd.date_range("2026-06-01", periods=48, freq="h")
    rh = np.linspace(20, 120, 48)
    lat, lon = 45.0, 9.0
    b = np.radians(360 * (ts.dayofyear.values - 81) / 365)
    eot = 9.87 * np.sin(2 * b) - 7.53 * np.cos(b) - 1.5 * np.sin(b)
    ha = np.radians(15 * (ts.hour.values + lon / 15 + eot / 60 - 12))
    dec = np.radians(23.45 * np.sin(np.radians(360 * (284 + ts.dayofyear.values) / 365)))
    phi = np.radians(lat)
    sky = 1000 * np.maximum(0, np.sin(phi) * np.sin(dec) + np.cos(phi) * np.cos(dec) * np.cos(ha))
    want = sky * np.exp(-0.35 * np.clip(rh / 100, 0, 1))
    df = frame(spark, pd.DataFrame({"ts": ts, "rh": rh})).select(
        "ts", physics.clear_sky_radiation(F.col("ts"), F.lit(lat), F.lit(lon), F.col("rh")).alias("s")
    )
    got = df.orderBy("ts").toPandas()["s"].to_numpy()
    assert np.allclose(got, want) and got.max() > 500 and (got == 0).any()


def test_cyclic_noon(spark):
    c = times.cyclic(F.lit("2026-06-01 12:00:00").cast("timestamp_ntz"))
    row = spark.range(1).select(*[v.alias(k) for k, v in c.items()]).first()
    assert row.hour_sin == pytest.approx(0, abs=1e-9) and row.hour_cos == pytest.approx(-1)
    assert row.doy_sin == pytest.approx(math.sin(2 * math.pi * 152 / 365.25))


def test_resample_and_bounded_interpolation(spark):
    pdf = pd.DataFrame({"station_id": "a", "ts": pd.to_datetime(["2024-01-01 00:10", "2024-01-01 03:20"])})
    for f in catalog.FEATURES:
        pdf[f] = [1.0, 2.0]
    dense = to_pandas(resample.densify(resample.resample(frame(spark, pdf))))
    assert dense["rain"].fillna(-1).tolist() == [1, -1, -1, 2]
    values = [None, 1, None, None, None, 5, None, None, None, None]
    pdf = pd.DataFrame({"station_id": "a", "ts": pd.date_range("2024-01-01", periods=10, freq="h"), "temp": values})
    got = to_pandas(resample.interpolate(frame(spark, pdf.astype({"temp": float})), 2, features=["temp"]))
    assert got["temp"].fillna(-1).tolist() == [-1, 1, 2, 3, -1, 5, 5, 5, -1, -1]


def test_nearest_cell_tie_goes_up(spark):
    grid = spark.createDataFrame([(45.0, 9.0), (45.25, 9.25), (45.5, 9.5)], "latitude double, longitude double")
    places = spark.createDataFrame([("a", 45.125, 9.0), ("b", 40.0, 12.0)], "station_id string, latitude double, longitude double")
    got = {r.station_id: (r.cell_latitude, r.cell_longitude) for r in matching.nearest_cells(places, grid).collect()}
    assert got == {"a": (45.25, 9.0), "b": (45.0, 9.5)}


def test_resolution(spark):
    base = pd.DataFrame({"station_id": "a", "temp": np.arange(0, 50, 0.5)})
    got = profiling.sensor_resolution(frame(spark, base), features=["temp"]).first()
    assert got.resolution == 0.5
    few = profiling.sensor_resolution(frame(spark, base.head(3)), features=["temp"]).first()
    assert few.resolution is None
    tie = pd.DataFrame({"station_id": "a", "temp": [1.0, 2.0, 4.0] * 20})
    assert profiling.sensor_resolution(frame(spark, tie), features=["temp"]).first().resolution == 1.0


def test_month_range(spark):
    df = spark.createDataFrame([("2026-01-15",), ("2026-04-02",)], "t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert sorted(r.month for r in maintenance.month_sequence(df, "t").collect()) == ["2026-01", "2026-02", "2026-03", "2026-04"]


def test_bias_report(spark):
    pdf = pd.DataFrame({"station_id": "a", "ts": pd.to_datetime(["2026-06-01", "2026-06-02"])})
    for f in catalog.FEATURES:
        pdf[f"{f}_era5"], pdf[f"{f}_eco"] = [10.0, 10.0], [10.5, 9.8]
    bias = matching.bias_table(frame(spark, pdf))
    row = matching.monthly_bias(bias, "2026-06").where("feature = 'temp'").first()
    assert row.mean_bias == pytest.approx(0.15) and {r.bias_overflow_flag for r in bias.collect()} == {0}


def test_bias_cleans_text_and_flags_overflow(spark):
    rows = [("a", " ", "3"), ("b", "junk", "3"), ("c", "12", "3"), ("d", None, None)]
    df = spark.createDataFrame(rows, "station_id string, temp_eco string, temp_era5 string").withColumn("ts", F.lit("2026-06-01").cast("timestamp_ntz"))
    rest = {f"{f}_{s}": F.lit(1.0) for f in catalog.FEATURES if f != "temp" for s in ("eco", "era5")}
    got = {r.station_id: (r.bias_temp, r.bias_overflow_flag) for r in matching.bias_table(df.withColumns(rest)).collect()}
    assert got == {"a": (None, 0), "b": (None, 0), "c": (9.0, 1), "d": (None, 0)}


def test_most_complete_row_wins(spark):
    rows = [("a", "m", "2024-01-02", None), ("a", "m", None, None), ("a", "m", "2024-01-01", None),
            ("b", "m", "2024-01-02", None), ("b", "m", "2024-01-01", 1.0)]
    df = spark.createDataFrame(rows, "station_id string, model_version string, created_at string, v double")
    df = df.withColumns({"created_at": F.col("created_at").cast("timestamp_ntz"), "ts": F.lit("2024-01-03").cast("timestamp_ntz")})
    got = {r.station_id: r for r in serving.most_complete(df).collect()}
    assert got["a"].created_at == dt.datetime(2024, 1, 2) and got["b"].v == 1.0
    same = df.where("station_id = 'a'").withColumn("v", F.when(F.col("created_at").isNull(), 1.0))
    assert serving.most_complete(same).first().created_at is None  # equal counts: the missing one wins


def test_range_delete(spark):
    df = frame(spark, hours(24, "2026-01-01"))
    left = maintenance.keep_outside(df, "2026-01-01 10:00:00", "2026-01-01 14:00:00")
    assert left.count() == 19
    assert maintenance.keep_outside(df, "2026-01-01 10:00:00", "2026-01-01 14:00:00", zone="Europe/Paris").where("hour(ts) = 9").count() == 0


def test_local_day_of_25_hours(spark):
    start, end = times.local_day_bounds("2026-10-25", "Europe/Paris")
    assert one(spark, times.seconds_between(start, end)) == 25 * 3600


def test_drift_labels(spark):
    label = lambda x: one(spark, cleaning.drift_label(F.col("x").cast("double")), x=x)
    assert [label(x) for x in (1.504, -2.0, 0.125, None)] == ["DRIFT(+1.50)", "DRIFT(-2.00)", "OK(+0.12)", "-"]


def test_specs_json(spark):
    parse = lambda text: one(spark, cleaning.parse_specs(F.col("x").cast("string")), x=text)
    nominal = parse(None)
    assert nominal["ecowitt_rh"].resolution == 1.0 and parse("{broken")["ecowitt_wind"].deadband == 0.2
    assert parse(catalog.specs_json(catalog.GUARDRAIL_SPECS))["ecowitt_solar"].resolution == 1.0


def test_station_dimension(spark):
    columns = "station_id station_name latitude longitude elevation floor min_training_days retrain_window_days".split()
    rows = [("a", "A", "45.1", "9.2", "120.7", "0", "", ""), ("b", " ", "", "x", "", "0", "7", "60"), ("c", "C", "1", "2", "-5", "3", "", "")]
    got = {r.station_id: r for r in stations.dimension(spark.createDataFrame(rows, columns), "2026-01-01 00:00:00").collect()}
    assert [got[s].elevation_m for s in "abc"] == [120, 2, 11]
    assert (got["b"].station_name, got["b"].latitude, got["b"].min_training_days) == ("Default Station", 0.0, 7)


def test_sanity_rule_waits_for_reanalysis(spark):
    base = {"station_id": "a", "model_version": "m"}
    base |= {f"{p}_{f}": 5.0 for p in ("pred", "actual", "abs_error") for f in catalog.FEATURES}
    rows = pd.DataFrame([{**base, "ts": pd.Timestamp(t)} for t in ("2026-01-01", "2026-01-09")])
    df = frame(spark, rows).withColumns({f"{f}_era5": F.lit(None).cast("double") for f in catalog.FEATURES})
    bad = quality.sanity_failures(df, "2026-01-10 00:00:00").collect()
    assert [r.ts.day for r in bad] == [1]


def test_retrain_rule(spark):
    known = spark.createDataFrame([(s, 14) for s in "abcd"], "station_id string, min_training_days int")
    rows = [("a", "2026-01-01", "2025-12-20"), ("b", "2026-02-20", "2026-02-01"), ("c", "2026-01-01", "2026-02-20")]
    new = spark.createDataFrame(rows, "station_id string, trained_at string, last_ts string")
    new = new.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("trained_at", "last_ts")})
    new = new.withColumn("model_version", F.concat(F.lit("m-"), "station_id"))
    registry = model.register(new.limit(0).withColumn("is_active", F.lit(1)), new)
    periods = spark.createDataFrame([(s, "2026-02") for s in "abcd"], "station_id string, last_period string")
    got = {r.station_id: (r.reason, r.is_due) for r in model.retrain_due(known, registry, periods, "2026-03-01 00:00:00").collect()}
    assert got == {"a": ("newer_period", True), "b": ("too_recent", False), "c": ("up_to_date", False), "d": ("no_model", True)}


def test_feature_order():
    raw, eco = catalog.SCHEMES["raw"], catalog.SCHEMES["ecowitt"]
    training = [raw[f] for f in catalog.FEATURES] + list(catalog.AUX_FEATURES)
    inference = [eco[f] for f in catalog.FEATURES] + list(catalog.AUX_FEATURES)
    same = {**{v: k for k, v in raw.items()}, **{v: k for k, v in eco.items()}}
    assert windows.same_order(training, inference, same) and not windows.same_order(training, inference[::-1], same)
    assert len(catalog.PUBLIC_COLUMNS) == 39 and len(catalog.CSV_COLUMNS) == 30


def test_reconcile_is_repeatable(spark):
    forecast = frame(spark, hours(3, "2026-01-01")).select("station_id", "ts", F.lit("m").alias("model_version"), *[F.col(f).alias(f"pred_{f}") for f in catalog.FEATURES])
    seen = frame(spark, hours(2, "2026-01-01", seed=1))
    matches = seen.select("station_id", "ts", *[F.col(f).alias(f"{f}_eco") for f in catalog.FEATURES], *[F.lit(None).cast("double").alias(f"{f}_era5") for f in catalog.FEATURES])
    bias = matching.bias_table(matches)
    once = evaluation.reconcile(forecast, matches, bias)
    rows = once.orderBy("ts").collect()
    assert rows[0].diff_temp == pytest.approx(rows[0].pred_temp - rows[0].actual_temp) and rows[0].historical_bias_temp == 0.0
    assert rows[2].actual_temp is None and rows[2].historical_bias_temp is None
    assert sorted(map(tuple, evaluation.reconcile(once, matches, bias).select(once.columns).collect())) [0] == sorted(map(tuple, rows))[0]


def test_metadata_defaults(spark):
    schema = "station_id string, station_name string, elevation_m double, min_training_days int, retrain_window_days int, sensor_specs string"
    rows = [("a", None, None, None, None, "{broken"), ("b", "B", 3.0, 7, 9, catalog.specs_json({"temp": (0.5, 0.0)}))]
    got = {r.station_id: r for r in stations.with_defaults(spark.createDataFrame(rows, schema)).collect()}
    assert (got["a"].station_name, got["a"].elevation_m, got["a"].min_training_days, got["a"].retrain_window_days) == ("Local Home Weather Station", 0.0, 14, 30)
    assert got["a"].sensor_specs["ecowitt_temp"].resolution == 0.1 and got["b"].sensor_specs["ecowitt_temp"].resolution == 0.5
    res = stations.with_defaults(spark.createDataFrame(rows, schema)).select(stations.resolution_of("rh").alias("r")).collect()
    assert {r.r for r in res} == {1.0}


def test_times_of_runs(spark):
    df = frame(spark, hours(5, "2026-01-01")).withColumn("created_at", F.col("ts") - F.expr("INTERVAL 2 HOURS"))
    assert maintenance.last_run(df, "2026-01-01 01:30:00").first().last_run == dt.datetime(2026, 1, 1, 1)
    assert maintenance.last_run(df.drop("created_at"), "2026-01-01 01:30:00").first().last_run == dt.datetime(2026, 1, 1, 1)
    assert maintenance.should_skip(df, "2026-01-01 01:30:00").first().skip is True
    assert maintenance.last_staged(df.limit(0), "2026-01-05 00:00:00").first().last_ts == dt.datetime(2026, 1, 5)


def test_period_filters(spark):
    df = frame(spark, hours(24 * 40, "2026-01-20"))
    count = lambda c: df.where(c).count()
    ts = F.col("ts")
    assert count(times.in_month(ts, "2026-02")) == 28 * 24
    assert count(times.in_month(ts, "2026-02", as_of="2026-02-01 05:00:00")) == 6
    assert count(times.in_extended_month(ts, "2026-02", 24, 0)) == 29 * 24
    assert count(times.trailing(ts, "2026-02-10 00:00:00", 3)) == 73
