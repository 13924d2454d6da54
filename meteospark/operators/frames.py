"""Windows over the rows of a station month, as NumPy views inside one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def matrix(column) -> np.ndarray:
    """A list column as a matrix, NULL as NaN."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(flat), -1)


def nested(values: np.ndarray) -> pa.Array:
    """An (n, steps, features) block as lists of lists."""
    n, steps, width = values.shape
    inner = pa.ListArray.from_arrays(pa.array(np.arange(0, n * steps * width + 1, width, dtype=np.int32)), pa.array(values.ravel()))
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * steps + 1, steps, dtype=np.int32)), inner)


def listed(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, max(width, 1), dtype=np.int32)[: n + 1]), pa.array(values.ravel()))


def _group_starts(table: pa.Table) -> np.ndarray:
    """Where the station months of ordered rows begin."""
    station = table["station_id"].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    new = (np.diff(station, prepend=-2) != 0) | (np.diff(table["_month"].to_numpy(), prepend=np.datetime64(0, "us")) != np.timedelta64(0))
    new[:1] = True
    return np.flatnonzero(new)


def in_station_months(narrow: DataFrame, build: Callable[[pa.Table], pa.Table], shape: str) -> DataFrame:
    """Applies `build` to tables of whole station months (or blocks of days), each in the order of its times.

    Rows are dealt by station and month and sorted, and a table holds all months that a batch of them
    completes: a month costs its rows, no call of its own, and a task holds a batch and a month.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if kept is None else pa.concat_tables([kept, table])
            last = int(_group_starts(table)[-1]) if len(table) else 0
            if last:
                yield from build(table.slice(0, last)).to_batches()
            kept = table.slice(last)
        if kept is not None and len(kept):
            yield from build(kept).to_batches()

    ordered = narrow.repartition("station_id", "_month").sortWithinPartitions("station_id", "_month", "ts")
    return ordered.mapInArrow(run, shape)


class StationMonths:
    """The samples of whole station months that lie in order: the row of each reference time (`refs`), its
    time, the bounds of its month and the number of its station month."""

    def __init__(self, table: pa.Table, lookback: int, horizon: int, block_days: int | None = None):
        ts, month = table["ts"].to_numpy(), table["_month"].to_numpy().astype("datetime64[us]")
        first = _group_starts(table) if len(table) else np.zeros(0, int)
        size = np.diff(first, append=len(table))
        group, place = np.repeat(np.arange(len(first)), size), np.arange(len(table)) - np.repeat(first, size)
        following = month.astype("datetime64[M]") + 1 if block_days is None else month + np.timedelta64(block_days, "D")
        following = following.astype("datetime64[us]")
        whole = (place >= lookback - 1) & (place + horizon < np.repeat(size, size))
        self.refs = np.flatnonzero(whole & (ts >= month) & (ts < following))
        self.ts, self.start, self.end, self.group = ts[self.refs], month[self.refs], following[self.refs], group[self.refs]
        self.lookback, self.horizon = lookback, horizon
        given = lambda c: len(self.refs) and c in table.column_names
        self.given, self.out = (matrix(table[c]) if given(c) else np.zeros((0, 0)) for c in ("_in", "_out"))
        self.width = lookback * self.given.shape[1] + horizon * self.out.shape[1]

    def samples(self, which: np.ndarray) -> np.ndarray:
        """A row for each sample: its window of inputs, then the deltas of its targets."""
        at = self.refs[which]
        x = self.given[at[:, None] + np.arange(1 - self.lookback, 1)]
        y = self.out[at[:, None] + np.arange(1, self.horizon + 1)] - self.out[at][:, None]
        return np.hstack([x.reshape(len(at), -1), y.reshape(len(at), -1)])


def sample_totals(rows: DataFrame, lookback: int, horizon: int, step_minutes: int, inputs, targets, block_days: int) -> DataFrame:
    """What is asked of whole samples, without a nested array for each: station_id, ts_ref, the sum of every input
    over the window (`past_<input>`, in order of time; NULL, if a value is) and the change of every target up to
    the last step (`delta_<target>`). A row goes as plain columns to the blocks of days whose windows need it."""
    from meteospark.operators.windows import month_rows

    used = list(dict.fromkeys([*inputs, *targets]))
    narrow = month_rows(rows, lookback, horizon, step_minutes, inputs, targets, used, block_days).drop("_in", "_out")
    columns = [*[f"past_{c}" for c in inputs], *[f"delta_{c}" for c in targets]]
    schema = pa.schema([("station_id", pa.string()), ("ts_ref", pa.timestamp("us")), *[(c, pa.float64()) for c in columns]])

    def build(table: pa.Table) -> pa.Table:
        w = StationMonths(table, lookback, horizon, block_days)
        values = {c: table[c].to_numpy().astype(float) for c in used}
        found = []
        for c in inputs:
            total = np.zeros(len(w.refs))
            for back in reversed(range(lookback)):
                total += values[c][w.refs - back]
            found.append(total)
        found += [values[c][w.refs + horizon] - values[c][w.refs] for c in targets]
        station = table["station_id"].combine_chunks().take(pa.array(w.refs))
        numbers = [pa.array(v, from_pandas=True) for v in found]
        return pa.Table.from_arrays([station, pa.array(w.ts).cast(pa.timestamp("us")), *numbers], schema=schema)

    shape = "station_id string, ts_ref timestamp_ntz, " + ", ".join(f"{c} double" for c in columns)
    return in_station_months(narrow, build, shape)


class MonthWindows:
    """The windows of one station month (or block of days) as strided views over its rows: x (n, L, inputs),
    last and, with a horizon, y (n, H, targets). Nothing is repeated but what NumPy works on."""

    def __init__(self, table: pa.Table, lookback: int, horizon: int, block_days: int | None = None):
        table = table.sort_by("ts")
        ts = table["ts"].to_numpy()
        self.start = np.datetime64(table["_month"][0].as_py(), "us")
        month = self.start.astype("datetime64[M]")
        self.end = (month + 1 if block_days is None else self.start + np.timedelta64(block_days, "D")).astype("datetime64[us]")
        refs = np.arange(lookback - 1, len(ts) - horizon)
        self.refs = refs[(ts[refs] >= self.start) & (ts[refs] < self.end)]
        self.table, self.ts = table, ts[self.refs]
        out = matrix(table["_out"])
        self.last = out[self.refs]
        if len(self.refs):
            views = np.lib.stride_tricks.sliding_window_view(matrix(table["_in"]), lookback, axis=0)
            self.x = views[self.refs - lookback + 1].transpose(0, 2, 1)
            if horizon:
                self.y = np.stack([out[self.refs + h] - self.last for h in range(1, horizon + 1)], axis=1)

    def column(self, name: str) -> pa.Array:
        return self.table[name].combine_chunks().take(pa.array(self.refs))


def per_month(narrow: DataFrame, per_station: DataFrame):
    """Station months beside what is known of their station, or of that month where it has `_month`."""
    months = narrow.select("station_id", "_month").distinct()
    on = [c for c in ("station_id", "_month") if c in per_station.columns]
    wanted = months.join(per_station, on).withColumnsRenamed({"station_id": "_station", "_month": "_when"})
    return narrow.groupBy("station_id", "_month").cogroup(wanted.groupBy("_station", "_when"))
