"""Normal equations of the ridge model as moments of station months that merge.

A sample is one vector z = (window of inputs, deltas of targets). A station month gives its count, its mean
and its scatter matrix around that mean; two of them merge exactly, whatever the scalers will be. So one
pass over the rows serves scalers, weights and validation errors, a changed month replaces its own rows
only, and a model as of any month is an ordered sum over the months before it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meteospark.functions import times
from meteospark.operators.frames import StationMonths, in_station_months, listed, matrix, per_month

#: block: the month, or span of days, of the reference time. kind: `head` for windows that begin in the
#: block before, `tail` for futures that end in the next one, `inner` for the rest. is_train: NULL without a cut.
MOMENTS = "station_id string, block timestamp_ntz, kind string, is_train boolean, n double, mean array<double>, scatter array<double>"
MODEL = (
    "station_id string, n_samples double, weights array<double>, x_mean array<double>, x_scale array<double>, "
    "y_mean array<double>, y_scale array<double>, metrics_mse double"
)
_KINDS = ("inner", "head", "tail")
#: Samples of up to so many numbers are summed for many station months at once.
_NARROW = 16


class Moments:
    """Count, mean and scatter (sum of squares and products around the mean) of vectors."""

    def __init__(self, n: float, mean: np.ndarray, scatter: np.ndarray):
        self.n, self.mean, self.scatter = n, mean, scatter

    @classmethod
    def of(cls, z: np.ndarray) -> Moments:
        """Of rows; differences to the first one, so constants have no scatter at all."""
        d = z - z[0]
        mean = d.mean(axis=0)
        d = d - mean
        return cls(float(len(z)), z[0] + mean, d.T @ d)

    def plus(self, other: Moments) -> Moments:
        n = self.n + other.n
        apart = other.mean - self.mean
        scatter = self.scatter + other.scatter + np.outer(apart, apart) * (self.n * other.n / n)
        return Moments(n, self.mean + apart * (other.n / n), scatter)

    @classmethod
    def total(cls, n: np.ndarray, mean: np.ndarray, scatter: np.ndarray) -> Moments:
        """Of many moments (a row each, scatter packed) at once."""
        share = n / n.sum()
        center = mean[0] + share @ (mean - mean[0])
        apart = mean - center
        whole = cls.unpacked(float(n.sum()), center, scatter.sum(axis=0))
        whole.scatter += (apart * n[:, None]).T @ apart
        return whole

    def packed(self) -> np.ndarray:
        return self.scatter[np.triu_indices(len(self.mean))]

    @classmethod
    def unpacked(cls, n: float, mean: list, scatter: list) -> Moments:
        size = len(mean)
        full = np.zeros((size, size))
        full[np.triu_indices(size)] = scatter
        return cls(n, np.array(mean, float), full + np.triu(full, 1).T)


def month_moments(
    narrow: DataFrame, lookback: int, horizon: int, step_minutes: int = 60, cut: DataFrame | None = None, block_days: int | None = None
) -> DataFrame:
    """The moments of each station month (or block of days) of `narrow`, by kind and, with a cut, by side of it.

    narrow: `windows.month_rows` with the same blocks. cut: station_id, cut_ts (NULL: nothing trains).
    Each row has p * (p + 1) / 2 numbers for p = lookback * inputs + horizon * targets.
    """
    step = np.timedelta64(step_minutes, "m")

    def build(rows: pa.Table, until) -> pa.Table:
        """Of whole station months that lie in order."""
        w = StationMonths(rows, lookback, horizon, block_days)
        kind = np.where(w.ts + horizon * step >= w.end, 2, np.where(w.ts - (lookback - 1) * step < w.start, 1, 0))
        train = np.full(len(kind), 2) if until is False else (w.ts <= np.datetime64(until)) * 1 if until else np.zeros(len(kind), int)
        code = (w.group * 3 + kind) * 3 + train
        order = np.argsort(code, kind="stable")
        code = code[order]
        first = np.flatnonzero(np.diff(code, prepend=-1))
        n, mean, scatter = _sums(w, order, first)
        kind, train = code[first] // 3 % 3, code[first] % 3
        where = pa.array(w.refs[order[first]])
        flags = pa.array(train == 1, mask=train == 2)
        out = [rows["station_id"].combine_chunks().take(where), pa.array(w.start[order[first]]), pa.array(_KINDS).take(pa.array(kind)), flags]
        names = ["station_id", "block", "kind", "is_train", "n", "mean", "scatter"]
        return pa.table([*out, pa.array(n), listed(mean), listed(scatter)], names=names)

    if cut is None:
        return in_station_months(narrow, lambda rows: build(rows, False), MOMENTS)
    known = lambda rows, side: build(rows.sort_by("ts"), side["cut_ts"][0].as_py() if len(side) else None)
    return per_month(narrow, cut).applyInArrow(known, MOMENTS)


def _sums(w: StationMonths, order: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, mean and packed scatter of each run of samples; a run starts at each `first` of `order`.

    Narrow samples of all runs are summed at once, a pair of columns at a time; for wide ones a product of
    matrices a run is faster.
    """
    n = np.diff(first, append=len(order)).astype(float)
    p = w.width
    mean, scatter = np.empty((len(n), p)), np.empty((len(n), p * (p + 1) // 2))
    if p > _NARROW:
        for i, (lo, count) in enumerate(zip(first, n.astype(int))):
            m = Moments.of(w.samples(order[lo : lo + count]))
            mean[i], scatter[i] = m.mean, m.packed()
    elif len(n):
        z, run = w.samples(order), np.repeat(np.arange(len(n)), n.astype(int))
        base = z[first]
        d = z - base[run]
        apart = np.add.reduceat(d, first, axis=0) / n[:, None]
        mean = base + apart
        d = np.ascontiguousarray((d - apart[run]).T)
        for k, (i, j) in enumerate(zip(*np.triu_indices(p))):
            scatter[:, k] = np.add.reduceat(d[i] * d[j], first)
    return n, mean, scatter


def solved(total: Moments, lookback: int, horizon: int, width: int, penalty: float) -> dict:
    """Scalers and ridge weights (intercept unpenalised) from the moments of the training samples.

    width: inputs of one step. A scaler's mean and population deviation run over all steps of all windows;
    a deviation of zero, or lost in rounding, gives scale 1.
    """
    p = lookback * width
    mean, spread = total.mean, np.diag(total.scatter) / total.n

    def scaler(mean: np.ndarray, spread: np.ndarray):
        center = mean.mean(axis=0)
        variance = (spread + (mean - center) ** 2).mean(axis=0)
        noise = (1e-12 * np.abs(mean).max(axis=0)) ** 2
        scale = np.sqrt(np.where(variance > noise, variance, 1.0))
        return center, scale, (mean - center).ravel(), np.tile(scale, len(mean))

    x_mean, x_scale, dx, sx = scaler(mean[:p].reshape(lookback, -1), spread[:p].reshape(lookback, -1))
    y_mean, y_scale, dy, sy = scaler(mean[p:].reshape(horizon, -1), spread[p:].reshape(horizon, -1))
    both = np.empty((p + 1, p + 1))
    both[:p, :p] = (total.scatter[:p, :p] + total.n * np.outer(dx, dx)) / np.outer(sx, sx)
    both[:p, p] = both[p, :p] = total.n * dx / sx
    both[p, p] = total.n
    right = np.vstack([(total.scatter[:p, p:] + total.n * np.outer(dx, dy)) / np.outer(sx, sy), total.n * dy / sy])
    ridge = np.eye(p + 1) * penalty
    ridge[p, p] = 0.0
    weights = np.linalg.solve(both + ridge, right)
    return {"weights": weights, "x_mean": x_mean, "x_scale": x_scale, "y_mean": y_mean, "y_scale": y_scale}


def mean_square_error(model: dict, held: Moments, lookback: int, horizon: int) -> float:
    """Of the predicted deltas over all samples of the moments; no sample is scored."""
    p = lookback * len(model["x_mean"])
    sx, sy = np.tile(model["x_scale"], lookback), np.tile(model["y_scale"], horizon)
    slope = model["weights"][:p] / sx[:, None] * sy
    still = np.tile(model["y_mean"], horizon) + model["weights"][p] * sy
    shift = held.mean[p:] - still - (held.mean[:p] - np.tile(model["x_mean"], lookback)) @ slope
    xx, xy, yy = held.scatter[:p, :p], held.scatter[:p, p:], np.diag(held.scatter)[p:]
    square = yy - 2 * (slope * xy).sum(axis=0) + (slope * (xx @ slope)).sum(axis=0) + held.n * shift**2
    return float(np.maximum(square, 0).mean() / held.n)


def _in_order(table: pa.Table) -> pa.Table:
    """A station's moments in the order of their blocks, so sums are the same on every run."""
    return table.sort_by([(c, "ascending") for c in ("block", "kind", "is_train")])


def _rows(table: pa.Table) -> list[dict]:
    return _in_order(table).to_pylist()


def _sum(total: Moments | None, row: dict) -> Moments:
    more = Moments.unpacked(row["n"], row["mean"], row["scatter"])
    return more if total is None else total.plus(more)


def fit(moments: DataFrame, lookback: int, horizon: int, width: int, penalty: float = 1.0, split=None) -> DataFrame:
    """One model a station with its validation error, from the sum of its moments alone.

    Training samples are those of `is_train`, or, with a split (a time, the start of a block), those whose
    future ends before it; the error is over the others, over all samples where none are left. A group
    holds one row for each block, kind and side of a station.
    """
    split = None if split is None else np.datetime64(split, "us")
    names = [c.split()[0] for c in MODEL.split(", ")]

    def run(table: pa.Table) -> pa.Table:
        table = _in_order(table)
        block = table["block"].to_numpy()
        if split is None:
            before = table["is_train"].fill_null(False).to_numpy()
        else:
            before = block < split
            if before.any():
                tail = np.array(table["kind"].to_pylist()) == "tail"
                before = before & ~((block == block[before].max()) & tail)
        n, mean, scatter = table["n"].to_numpy(), matrix(table["mean"]), matrix(table["scatter"])
        train, held = [Moments.total(n[side], mean[side], scatter[side]) if side.any() else None for side in (before, ~before)]
        out = []
        if train is not None:
            model = solved(train, lookback, horizon, width, penalty)
            error = mean_square_error(model, held or train, lookback, horizon)
            out.append((table["station_id"][0].as_py(), train.n, model["weights"].ravel(), *[model[c] for c in names[3:7]], error))
        return _models(out, names)

    return moments.groupBy("station_id").applyInArrow(run, MODEL)


def _models(out: list, names: list[str], extra: tuple = ()) -> pa.Table:
    kinds = [pa.string(), pa.float64(), *[pa.list_(pa.float64())] * 5, pa.float64(), *extra]
    columns = list(zip(*out)) or [[]] * len(names)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def walk_forward(
    moments: DataFrame, begin, end, lookback: int, horizon: int, width: int, penalty: float = 1.0, block_days: int = 7, name: str = "ridge"
) -> DataFrame:
    """A model for each station and block of days in [begin, end), from what lies before the block.

    Blocks are added up once, in order; a model is solved where the sum stands. Samples whose future ends
    in the block itself come in with the next one. Returns a model's columns, `_month` (the block it is for)
    and model_version.
    """
    days = np.timedelta64(block_days, "D")
    first = np.datetime64(begin, "D").astype(int) // block_days * block_days
    starts = np.arange(np.datetime64(int(first), "D"), np.datetime64(end, "us"), days)
    names = [*[c.split()[0] for c in MODEL.split(", ")], "_month", "model_version"]

    def run(table: pa.Table) -> pa.Table:
        rows, total, at, out = _rows(table), None, 0, []
        waiting: list[dict] = []
        for start in starts:
            while at < len(rows) and np.datetime64(rows[at]["block"]) < start:
                r = rows[at]
                at += 1
                if r["kind"] == "tail" and np.datetime64(r["block"]) + days >= start:
                    waiting.append(r)  # its future ends in this block
                else:
                    total = _sum(total, r)
            if total is not None:
                model = solved(total, lookback, horizon, width, penalty)
                error = mean_square_error(model, total, lookback, horizon)
                version = f"{name}_{str(start.astype('datetime64[D]')).replace('-', '_')}"
                out.append(
                    (rows[0]["station_id"], total.n, model["weights"].ravel(), *[model[c] for c in names[3:7]], error, start.astype("datetime64[us]"), version)
                )
            for r in waiting:
                total = _sum(total, r)
            waiting = []
        return _models(out, names, (pa.timestamp("us"), pa.string()))

    return moments.groupBy("station_id").applyInArrow(run, MODEL + ", _month timestamp_ntz, model_version string")


def changed(moments: DataFrame, month: str) -> DataFrame:
    """Of moments computed from one month and the rows around it, those that are whole: the month's own, the
    tails of the month before and the heads of the next one."""
    start = times.instant(f"{month}-01 00:00:00")
    next_start = start + F.expr("INTERVAL '1' MONTH")
    before = start - F.expr("INTERVAL '1' MONTH")
    block, kind = F.col("block"), F.col("kind")
    return moments.where((block == start) | ((block == before) & (kind == "tail")) | ((block == next_start) & (kind == "head")))
