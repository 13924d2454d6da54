"""Moments that merge: refits, walk-forward models and errors against fits on the rows themselves."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meteospark import session
from meteospark.operators import frames, model, moments, windows
from meteospark.plans import flow
from meteospark.sources import sinks
from tests.helpers import frame, hours

INPUTS, TARGETS, LOOK, AHEAD, PENALTY = ("temp", "rh", "pres"), ("temp", "rh"), 5, 3, 1.0
SMALL = {"inputs": INPUTS, "targets": TARGETS}


def settings(**changes):
    return flow.Settings(as_of="2024-12-31 00:00:00", lookback=LOOK, horizon=AHEAD, **changes)


def series(n=24 * 100):
    rows = pd.concat([hours(n, "2024-01-20", seed=i, station=s) for i, s in enumerate("ab")], ignore_index=True)
    return rows.assign(latitude=45.0, longitude=9.0)


def samples(g):
    data, target = g[list(INPUTS)].to_numpy(), g[list(TARGETS)].to_numpy()
    n = len(g) - LOOK - AHEAD + 1
    x = np.stack([data[i : i + LOOK] for i in range(n)])
    y = np.stack([target[i + LOOK : i + LOOK + AHEAD] - target[i + LOOK - 1] for i in range(n)])
    return g["ts"].to_numpy()[LOOK - 1 : LOOK - 1 + n], x, y


def ridge(x, y):
    """weights and scalers by NumPy on stacked samples."""
    xm, xs = x.reshape(-1, x.shape[2]).mean(0), x.reshape(-1, x.shape[2]).std(0)
    ym, ys = y.reshape(-1, y.shape[2]).mean(0), y.reshape(-1, y.shape[2]).std(0)
    a = np.hstack([((x - xm) / xs).reshape(len(x), -1), np.ones((len(x), 1))])
    keep = np.eye(a.shape[1]) * PENALTY
    keep[-1, -1] = 0
    return np.linalg.solve(a.T @ a + keep, a.T @ ((y - ym) / ys).reshape(len(y), -1)), xm, xs, ym, ys


def predicted(fit, x):
    w, xm, xs, ym, ys = fit
    a = np.hstack([((x - xm) / xs).reshape(len(x), -1), np.ones((len(x), 1))])
    return (a @ w).reshape(len(x), AHEAD, -1) * ys + ym


def test_moments_merge_like_rows():
    z = np.random.default_rng(1).normal(1000, 3, (500, 7))
    z[:, 3] = 5.0
    parts = [moments.Moments.of(p) for p in (z[:1], z[1:200], z[200:])]
    total = moments.Moments.unpacked(parts[0].n, list(parts[0].mean), list(parts[0].packed()))
    for p in parts[1:]:
        total = total.plus(moments.Moments.unpacked(p.n, list(p.mean), list(p.packed())))
    assert total.n == 500 and np.allclose(total.mean, z.mean(0))
    assert np.allclose(total.scatter / 500, np.cov(z.T, bias=True), atol=1e-10) and total.scatter[3, 3] == 0


def test_error_of_the_registry_is_that_of_the_scores(spark):
    rows = frame(spark, series(24 * 50))
    fitted, scored = model.train_and_score(rows, LOOK, AHEAD, PENALTY, **SMALL)
    pairs = scored.where("NOT is_train").select("station_id", F.explode(F.arrays_zip(F.flatten("delta").alias("p"), F.flatten("y").alias("a"))).alias("v"))
    want = {r.station_id: r.mse for r in pairs.groupBy("station_id").agg(F.avg(F.pow(F.col("v.p") - F.col("v.a"), 2)).alias("mse")).collect()}
    got = {r.station_id: r.metrics_mse for r in fitted.collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_walk_forward_equals_fits_on_the_past(spark):
    pdf = series()
    days = 7
    narrow = windows.month_rows(frame(spark, pdf), LOOK, AHEAD, inputs=INPUTS, targets=TARGETS, block_days=days)
    parts = moments.month_moments(narrow, LOOK, AHEAD, block_days=days)
    begin, end = "2024-02-10 00:00:00", "2024-03-20 12:00:00"
    rows = moments.walk_forward(parts, begin, end, LOOK, AHEAD, len(INPUTS), PENALTY, days).collect()
    starts = sorted({pd.Timestamp(r._month) for r in rows})
    assert all((s - pd.Timestamp("1970-01-01")).days % days == 0 for s in starts) and starts[0] <= pd.Timestamp(begin) and len(rows) == 2 * len(starts)
    for r in rows:
        ts, x, y = samples(pdf[pdf.station_id == r.station_id])
        past = ts + np.timedelta64(AHEAD, "h") < np.datetime64(r._month)
        w, xm, _, _, ys = ridge(x[past], y[past])
        assert r.n_samples == past.sum()
        assert np.allclose(np.array(r.weights).reshape(w.shape), w, atol=1e-7) and np.allclose(r.x_mean, xm) and np.allclose(r.y_scale, ys)


def test_backtest_uses_the_model_of_its_block(spark):
    pdf = series(24 * 40)
    s = settings()
    got = flow.backtest(
        frame(spark, pdf[["station_id", "ts", *[c for c in ("temp", "rh", "pres", "wind", "solar", "rain")]]]).withColumn("temp", F.col("temp")),
        frame(spark, pd.DataFrame({"station_id": ["a", "b"], "latitude": 45.0, "longitude": 9.0})),
        "2024-02-10 00:00:00", "2024-02-25 00:00:00", 24, s, session.run_folder(spark), 7, **SMALL,
    ).collect()
    blocks = {(r.station_id, pd.Timestamp(r.ts_ref)): r.model_version for r in got}
    assert len(got) == 2 * 15
    for (_, at), version in blocks.items():
        start = pd.Timestamp("1970-01-01") + pd.Timedelta(days=(at - pd.Timestamp("1970-01-01")).days // 7 * 7)
        assert version == f"ridge_{start:%Y_%m_%d}"


def test_refit_reads_the_changed_month_only(spark, monkeypatch):
    pdf, s, folder = series(24 * 150), settings(), session.run_folder(spark)
    features, parts = f"{folder}/features", f"{folder}/moments"
    sinks.upsert(spark, frame(spark, pdf), features, ["station_id", "ts"], unique=True)
    flow.all_moments(spark, features, parts, s, **SMALL)
    month = "2024-03"
    changed = (pdf.ts >= "2024-03-01") & (pdf.ts < "2024-04-01")
    pdf.loc[changed, "temp"] += np.arange(changed.sum()) % 5
    sinks.upsert(spark, frame(spark, pdf[changed]), features, ["station_id", "ts"], unique=True)
    plans = {}
    write = sinks.materialise
    monkeypatch.setattr(sinks, "materialise", lambda df, folder, name: (plans.update({name: df._jdf.queryExecution().executedPlan().toString()}), write(df, folder, name))[1])
    flow.update_moments(spark, features, parts, month, s, **SMALL)
    monkeypatch.undo()
    scan = plans["moments"]
    assert scan.count("FileScan") == 1 and "month#" in scan.split("PartitionFilters: [")[1].split("]")[0] and "GreaterThanOrEqual(ts" in scan
    read = sinks.read_table(spark, features).where("month between '2024-02' and '2024-04'")
    reach = pd.Timedelta(hours=LOOK + AHEAD)
    inside = read.where((F.col("ts") >= F.lit(pd.Timestamp("2024-03-01") - reach)) & (F.col("ts") < F.lit(pd.Timestamp("2024-04-01") + reach)))
    assert inside.count() == 2 * (31 * 24 + 2 * (LOOK + AHEAD))  # the month and the edges of its neighbours

    split = "2024-05-01"
    got = {r.station_id: r for r in flow.refit(spark, parts, s, split, len(INPUTS)).collect()}
    for station, g in pdf.groupby("station_id"):
        ts, x, y = samples(g)
        past = ts + np.timedelta64(AHEAD, "h") < np.datetime64(split)
        fit = ridge(x[past], y[past])
        r = got[station]
        assert r.n_samples == past.sum() and np.allclose(np.array(r.weights).reshape(fit[0].shape), fit[0], atol=1e-7)
        assert r.metrics_mse == pytest.approx(((predicted(fit, x[~past]) - y[~past]) ** 2).mean(), rel=1e-8)


def test_months_are_cut_out_of_batches_and_need_no_call_each(spark):
    rows = pd.concat([hours(24 * 40, station=s, seed=i) for i, s in enumerate("abc")])
    narrow = windows.month_rows(frame(spark, rows), 3, 2, inputs=("temp", "rh"), targets=("temp",))
    found = {}
    for size in ("7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        parts = moments.month_moments(narrow, 3, 2)
        found[size] = sorted((r.station_id, r.block, r.kind, r.n, r.mean, r.scatter) for r in parts.collect())
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found["7"] == found["10000"] and sum(r[3] for r in found["7"]) == 3 * (24 * 40 - 4)
    assert "FlatMapGroups" not in parts._jdf.queryExecution().toString()


def test_narrow_samples_give_the_moments_of_wide_ones(spark, monkeypatch):
    narrow = windows.month_rows(frame(spark, hours(24 * 40)), 2, 1, inputs=("temp", "rh"), targets=("temp",))
    rows = narrow.orderBy("station_id", "_month", "ts").toArrow()
    w = frames.StationMonths(rows, 2, 1)
    order, first = np.arange(len(w.refs)), np.array([0, 100, 101])
    at_once = moments._sums(w, order, first)
    monkeypatch.setattr(moments, "_NARROW", 0)
    for a, b in zip(at_once, moments._sums(w, order, first), strict=True):
        assert np.allclose(a, b, rtol=1e-12, atol=1e-9)
