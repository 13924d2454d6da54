"""Operators against pandas / NumPy on series that cross span borders."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks import QUERIES
from meteospark.catalog import FEATURES, INPUT_FEATURES
from meteospark.operators import frames, maintenance, model, profiling, resample, spans, staging, windows
from tests.helpers import frame, hours, to_pandas


def three_months(seed=3, keep=0.3):
    """Sparse hours over three months with NULLs in single features and whole hours missing."""
    pdf = hours(24 * 75, "2024-01-10", seed, nulls=0.4)
    rng = np.random.default_rng(seed)
    kept = rng.random(len(pdf)) < keep
    kept[300:1200] = False  # a gap that holds a whole month
    return pdf[kept].reset_index(drop=True)


@pytest.mark.parametrize("max_hours", [2, 30, None])
def test_interpolation_like_pandas(spark, max_hours):
    pdf = three_months()
    got = to_pandas(resample.interpolate(frame(spark, pdf), max_hours)).set_index("ts")[list(FEATURES)]
    wide = pdf.set_index("ts")[list(FEATURES)].asfreq("h")
    want = wide.interpolate(method="time", limit=max_hours)
    assert got.index.equals(want.index)
    pd.testing.assert_frame_equal(got, want, check_freq=False, check_names=False, rtol=1e-9)


def test_fills_like_pandas(spark):
    pdf = three_months(5)
    wide = pdf.set_index("ts")[list(FEATURES)].asfreq("h")
    got = to_pandas(resample.fill_edges(frame(spark, pdf))).set_index("ts")[list(FEATURES)]
    pd.testing.assert_frame_equal(got, wide.ffill().bfill(), check_freq=False, check_names=False)
    full = to_pandas(resample.interpolate_all(frame(spark, pdf))).set_index("ts")
    want = wide.interpolate(method="linear").bfill()
    pd.testing.assert_frame_equal(full[list(FEATURES)], want, check_freq=False, check_names=False, rtol=1e-9)
    assert (full["filled"].astype(bool).to_numpy() == wide.isna().any(axis=1).to_numpy()).all()


def test_gaps_across_days(spark):
    rng = np.random.default_rng(1)
    all_minutes = pd.date_range("2024-02-28 20:00", periods=4000, freq="min")
    ts = all_minutes[np.sort(rng.choice(4000, 700, replace=False))]
    pdf = pd.DataFrame({"station_id": "a", "ts": ts.append(ts[:50])})
    got = staging.gaps(frame(spark, pdf)).orderBy("gap_start").toPandas()
    step = pd.Series(ts).diff().dt.total_seconds() / 60
    assert got["missing_min"].tolist() == (step[step > 1.5] - 1).astype(int).tolist()
    assert got["missing_min"].sum() + 700 == (ts[-1] - ts[0]) / pd.Timedelta("1min") + 1


def test_exact_percentile(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"k": np.where(rng.random(5000) < 0.9, "hot", "cold"), "v": rng.exponential(3, 5000).round(2)})
    pdf.loc[:2000, "v"] = 7.25  # one value holds a large part of the rows
    for p in (0.0, 0.1, 0.5, 0.937, 1.0):
        got = {r.k: r.q for r in spans.exact_percentile(frame(spark, pdf), ["k"], "v", p, "q").collect()}
        for k, g in pdf.groupby("k"):
            assert got[k] == pytest.approx(np.percentile(g["v"], p * 100))


def test_windows_across_months(spark):
    pdf = hours(100, "2024-01-29 10:00", 7)
    df = frame(spark, pdf)
    look, ahead = 24, 6
    got = windows.sample_windows(df, look, ahead, inputs=FEATURES).orderBy("ts_ref").collect()
    data = pdf[list(FEATURES)].to_numpy()
    assert len(got) == 100 - look - ahead + 1
    for n, row in enumerate(got):
        t = n + look - 1
        assert row.ts_ref == pdf["ts"][t]
        assert np.allclose(row.x, data[n : t + 1])
        assert np.allclose(row.y, data[t + 1 : t + 1 + ahead] - data[t])
    assert np.shape(got[0].x) == (24, 6) and np.shape(got[0].y) == (6, 6)
    small = windows.sample_windows(frame(spark, hours(10)), 3, 2, inputs=FEATURES)
    assert small.count() == 6
    # a lookback longer than a month reaches more than one border
    long = windows.sample_windows(frame(spark, hours(24 * 70, "2024-01-20")), 24 * 40, 2, inputs=("temp",), targets=("temp",))
    assert long.count() == 24 * 70 - 24 * 40 - 2 + 1


def test_totals_of_windows_need_no_nested_arrays(spark):
    look, ahead, names = 5, 3, ("rh", "temp")
    pdf = pd.concat([hours(200, "2024-01-29 10:00", 7, 0.02), hours(8, seed=3, station="b"), hours(7, seed=4, station="c")])
    got = to_pandas(frames.sample_totals(frame(spark, pdf), look, ahead, 60, names, ("temp",), 2), ("station_id", "ts_ref"))
    parts = []
    for station, own in pdf.groupby("station_id"):
        at = np.arange(look - 1, len(own) - ahead)
        parts.append(pd.DataFrame({"station_id": station, "ts_ref": own.ts.to_numpy()[at]}))
        for c in names:
            parts[-1][f"past_{c}"] = own[c].rolling(look).sum().to_numpy()[at]
        parts[-1]["delta_temp"] = own.temp.to_numpy()[at + ahead] - own.temp.to_numpy()[at]
    pd.testing.assert_frame_equal(got, pd.concat(parts, ignore_index=True), check_dtype=False)
    assert got.station_id.tolist() == ["a"] * 193 + ["b"] and got.past_rh.isna().any()
    plan = QUERIES["long_history_windows"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "collect_list" not in plan


def test_scaler_counts_every_window(spark):
    pdf = hours(50, seed=4)
    df = frame(spark, pdf)
    got = {r.feature: r for r in windows.scaler_stats(df, 24, 6, inputs=FEATURES).collect()}
    data = pdf[list(FEATURES)].to_numpy()
    stacked = np.concatenate([data[i : i + 24] for i in range(50 - 24 - 6 + 1)])
    for j, f in enumerate(FEATURES):
        assert got[f].n == len(stacked)
        assert got[f]["mean"] == pytest.approx(stacked[:, j].mean())
        assert got[f].scale == pytest.approx(stacked[:, j].std())
    flat = frame(spark, pdf.assign(temp=3.0))
    assert windows.scaler_stats(flat, 24, 6, inputs=("temp",)).first().scale == 1.0


def _feature_frame(spark, n=240):
    parts = []
    for seed, station in enumerate(("a", "b")):
        pdf = hours(n, seed=seed, station=station)
        rng = np.random.default_rng(seed + 10)
        for f in INPUT_FEATURES[6:]:
            pdf[f] = rng.normal(0, 1, n)
        parts.append(pdf.assign(latitude=45.0, longitude=9.0))
    return pd.concat(parts, ignore_index=True)


def test_ridge_equals_closed_form(spark):
    pdf = _feature_frame(spark)
    rows = frame(spark, pdf)
    look, ahead = 4, 2
    fitted, scored = model.train_and_score(rows, look, ahead, penalty=2.0)
    got = {(r.station_id, r.ts_ref): np.array(r.delta) for r in scored.collect()}
    for station, g in pdf.groupby("station_id"):
        data, target = g[list(INPUT_FEATURES)].to_numpy(), g[list(FEATURES)].to_numpy()
        n = len(g) - look - ahead + 1
        x = np.stack([data[i : i + look] for i in range(n)])
        y = np.stack([target[i + look : i + look + ahead] - target[i + look - 1] for i in range(n)])
        cut = int(n * 0.8)
        xm, xs = x[:cut].reshape(-1, 11).mean(0), x[:cut].reshape(-1, 11).std(0)
        ym, ys = y[:cut].reshape(-1, 6).mean(0), y[:cut].reshape(-1, 6).std(0)
        a = np.hstack([((x - xm) / xs).reshape(n, -1), np.ones((n, 1))])
        b = ((y - ym) / ys).reshape(n, -1)
        ridge = np.eye(a.shape[1]) * 2.0
        ridge[-1, -1] = 0
        w = np.linalg.solve(a[:cut].T @ a[:cut] + ridge, a[:cut].T @ b[:cut])
        want = (a @ w).reshape(n, ahead, 6) * ys + ym
        for i in range(n):
            assert np.allclose(got[(station, g["ts"].iloc[i + look - 1])], want[i], atol=1e-6)
    assert {r.n_samples for r in fitted.collect()} == {188.0}
    errors = model.rmse(scored).first()
    assert errors.n == len(got) * ahead * 6
    forecast = model.to_forecast(scored, "m", lookback=look)
    assert forecast.count() == len(got) * ahead and forecast.where("pred_solar < 0 or pred_rh > 100").count() == 0


def test_night_solar_is_blocked(spark):
    deltas = spark.createDataFrame([([[0.0, 0.0, 0.0, 0.0, 450.0, 0.0]] * 6, [10.0, 50.0, 1000.0, 1.0, 450.0, 0.0])], "delta array<array<double>>, last_actual array<double>")
    rows = deltas.withColumns({"station_id": F.lit("a"), "ts_ref": F.lit("2026-01-01 20:00:00").cast("timestamp_ntz"), "latitude": F.lit(45.0), "longitude": F.lit(9.0)})
    assert {r.pred_solar for r in model.to_forecast(rows, "m").collect()} == {0.0}
    bad = rows.withColumn("delta", F.array(F.array(*[F.lit(float("nan"))] * 6)))
    usable, rejected = model.split_rejects(rows.unionByName(bad))
    assert (usable.count(), rejected.count()) == (1, 1)


def test_replay_like_the_loop(spark):
    ts = pd.date_range("2024-01-01", "2024-01-12 23:00", freq="3h")
    pdf = pd.DataFrame({"station_id": "a", "ts": ts, "v": np.arange(len(ts))})
    now = pd.Timestamp("2024-01-29 05:00")
    table = pdf[["ts", "v"]].copy()
    while table["ts"].max() < now:
        last = table["ts"].max()
        back = min(pd.Timedelta(days=7), now - last)
        chunk = table[(table["ts"] > last - back) & (table["ts"] <= last)].copy()
        chunk["ts"] += back
        chunk = chunk[(chunk["ts"] <= now) & ~chunk["ts"].isin(table["ts"])]
        if chunk.empty:
            break
        table = pd.concat([table, chunk])
    want = table.iloc[len(pdf):].sort_values("ts")
    got = maintenance.replay_extend(frame(spark, pdf), str(now)).orderBy("ts").toPandas()
    assert got["ts"].tolist() == want["ts"].tolist() and got["v"].tolist() == want["v"].tolist()


def test_continuity_and_bridge(spark):
    marks = list(pd.date_range("2024-01-30 20:00", periods=10, freq="h")) + list(pd.date_range("2024-02-01 12:00", periods=3, freq="h"))
    forecast = frame(spark, pd.DataFrame({"station_id": "a", "ts": marks}))
    tel = frame(spark, pd.DataFrame({"station_id": "a", "ts": pd.to_datetime(["2024-02-01 16:20"])}))
    plan = maintenance.bridge_plan(forecast, tel).orderBy("ts").toPandas()
    missing = pd.date_range("2024-01-31 06:00", "2024-02-01 16:00", freq="h").difference(pd.DatetimeIndex(marks))
    assert plan["ts"].tolist() == missing.tolist()


def test_latest_rows(spark):
    df = frame(spark, pd.concat([hours(40, station="a"), hours(5, station="b")], ignore_index=True))
    got = profiling.latest_rows(df, 24).groupBy("station_id").count().collect()
    assert {r.station_id: r["count"] for r in got} == {"a": 24, "b": 5}
