"""Operators that keep state between micro-batches and are driven by event time.

A watermark says how far time has come; state behind it is dropped, so its size follows the delay, not the
history. What arrives behind the watermark is never lost: `split_late` sends it another way, and the
handlers of `jobs.py` recompute what it touches from stored rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor

from meteospark.functions import times
from meteospark.operators import evaluation, matching, resample, staging
from meteospark.sources import sinks

#: The state store that keyed state with timers needs.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

ALARMS = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("gap_start", T.LongType()),
        T.StructField("gap_end", T.LongType()),
        T.StructField("is_open", T.BooleanType()),
    ]
)


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state with timers is kept in RocksDB; queries started later use it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class _Silence(StatefulProcessor):
    """Per station: the last minute that is settled, and those the watermark has not passed yet.

    Minutes settle in order once the watermark is behind them; two settled ones too far apart are a gap. A
    timer goes off when the watermark is `limit` minutes past the newest minute: the station is silent, an
    open gap begins after its last minute, and it is closed by the next minute that settles.
    """

    def __init__(self, limit: int, max_step_minutes: float):
        self.limit, self.max_step = limit, max_step_minutes

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "minute long")
        self.waiting = handle.getListState("waiting", "minute long")

    def _settle(self, upto: int) -> tuple[list, int | None]:
        """Gaps between minutes settled now, and the newest minute known."""
        waiting = sorted({m for (m,) in self.waiting.get()})
        last = self.last.get()[0] if self.last.exists() else None
        rows, keep = [], []
        newest = last
        for m in waiting:
            newest = m if newest is None else max(newest, m)
            if m > upto:
                keep.append(m)
            elif last is None or m > last:
                if last is not None and m - last > self.max_step:
                    rows.append((last + 1, m - 1, False))
                last = m
        if last is not None:
            self.last.update((last,))
        if keep:
            self.waiting.put([(m,) for m in keep])
        else:
            self.waiting.clear()
        return rows, newest

    def _rows(self, key, rows: list) -> Iterator[pd.DataFrame]:
        if rows:
            out = pd.DataFrame(rows, columns=["gap_start", "gap_end", "is_open"]).astype({"gap_start": "int64", "gap_end": "Int64"})
            out.insert(0, "station_id", key[0])
            yield out

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        for part in rows:
            minutes = (part["ts"].astype("int64") // self._unit(part["ts"])).unique()
            self.waiting.appendList([(int(m),) for m in minutes])
        found, newest = self._settle(timerValues.getCurrentWatermarkInMs() // 60_000)
        for at in self.handle.listTimers():
            self.handle.deleteTimer(at)
        if newest is not None:
            self.handle.registerTimer((newest + self.limit) * 60_000)
        yield from self._rows(key, found)

    @staticmethod
    def _unit(ts: pd.Series) -> int:
        """Ticks of a minute in the column's own resolution."""
        per_second = {"s": 1, "ms": 10**3, "us": 10**6, "ns": 10**9}
        return 60 * per_second[getattr(ts.dtype, "unit", "ns")]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        found, _ = self._settle(timerValues.getCurrentWatermarkInMs() // 60_000)
        found.append((self.last.get()[0] + 1, None, True))
        yield from self._rows(key, found)

    def close(self) -> None:
        pass


def silence_alarms(
    stream: DataFrame, delay: str = "10 minutes", limit: int = 15, max_step_minutes: float = 1.5
) -> DataFrame:
    """Gaps of each station as event time passes them: station_id, gap_start, gap_end, missing_min, is_open.

    A station that falls silent gives an open gap (no end) once the watermark, which other stations push
    on, is `limit` minutes behind its last minute: no row of its own is needed. Its next minute closes the
    gap with a row of the same start. Minutes behind the watermark aren't seen here; `split_late` and
    `jobs.gap_arrivals` see to those. State is one minute a station and what the delay holds back.
    """
    minutes = stream.where(F.col("station_id").isNotNull()).select("station_id", F.col("ts").cast("timestamp").alias("ts"))
    found = (
        minutes.withWatermark("ts", delay)
        .groupBy("station_id")
        .transformWithStateInPandas(_Silence(limit, max_step_minutes), ALARMS, "Append", "EventTime")
    )
    at = lambda c: times.from_epoch(F.col(c) * 60).alias(c)
    missing = (F.col("gap_end") - F.col("gap_start") + 1).cast("int").alias("missing_min")
    return found.select("station_id", at("gap_start"), at("gap_end"), missing, "is_open")


def keep_alarms(spark: SparkSession, path: str):
    """Handler: stores alarms; a closed gap replaces the open one of the same start."""

    def handle(batch: DataFrame, _: int) -> None:
        closed_last = (~F.col("is_open")).alias("_closed")
        rows = staging.last_row(batch.select("*", closed_last), ["station_id", "gap_start"], ["_closed"]).drop("_closed")
        sinks.upsert(spark, rows, path, ["station_id", "gap_start"], at="gap_start", unique=True)

    return handle


def split_late(spark: SparkSession, near_path: str, late_path: str, delay_minutes: int, slot_minutes: int = 60, at: str = "ts"):
    """Handler: parts a stream at the mark, `delay_minutes` before the newest time of all earlier batches,
    rounded down to a slot. Rows from the mark on go to `near_path`, those behind it to `late_path`, each in
    a folder of their batch, so a batch that runs again writes the same rows again.

    A watermark of the delay and one slot more over the near rows drops none of them, as it is never
    ahead of the mark. Rows without a time are late. The marks are a small table beside the near rows,
    one row a batch.
    """
    marks_path = f"{near_path}-marks"

    def handle(batch: DataFrame, number: int) -> None:
        newest = None
        if sinks.path_exists(spark, marks_path):
            newest = spark.read.parquet(marks_path).where(F.col("batch") < number).agg(F.max("newest")).first()[0]
        mark = times.floor_slot(F.lit(newest).cast("timestamp_ntz") - times.minutes(delay_minutes), slot_minutes)
        near = F.lit(True) if newest is None else F.col(at) >= mark
        near = F.coalesce(near & F.col(at).isNotNull(), F.lit(False))
        by_month = batch.withColumn("month", times.month_of(F.col(at)))
        for rows, path in ((by_month.where(near), near_path), (by_month.where(~near), late_path)):
            rows.write.mode("overwrite").partitionBy("month").parquet(f"{path}/batch={number}")
        own = batch.agg(F.max(at).alias("newest"), F.count_if(~near).alias("late"))
        own.write.mode("overwrite").parquet(f"{marks_path}/batch={number}")

    return handle


def late_count(spark: SparkSession, near_path: str) -> int:
    """How many rows have come behind their mark."""
    return spark.read.parquet(f"{near_path}-marks").agg(F.sum("late")).first()[0] or 0


def near_hours(stream: DataFrame, identity, delay_minutes: int, step_minutes: int = 60, features=None) -> DataFrame:
    """Hourly means of near rows by windowed state: repeated readings of the near past count once.

    For `split_late` with the same delay: no row is behind this watermark. Slots come out whenever they
    change, and their state goes when the watermark has passed them. `features`: by default those of a
    station (rain is a maximum).
    """
    from meteospark.catalog import FEATURES

    features = FEATURES if features is None else features
    marked = stream.withColumn("_at", F.col("ts").cast("timestamp"))
    once = marked.withWatermark("_at", f"{delay_minutes + step_minutes} minutes").dropDuplicates([*identity, "_at"])
    aggs = [(F.max if f == "rain" else F.avg)(f).alias(f) for f in features]
    slots = once.groupBy("station_id", F.window("_at", f"{step_minutes} minutes").alias("_slot")).agg(*aggs)
    return slots.select("station_id", F.col("_slot.start").cast("timestamp_ntz").alias("ts"), *features)


def late_hours(
    spark: SparkSession, near_path: str, late_path: str, hours_path: str, schema, identity, step_minutes: int = 60, features=None
):
    """Handler for the late rows of `split_late`: resamples the slots they fall into from all rows of both
    folders, of their months alone. To run once `near_hours` has taken in what came before them; it never
    gives those slots again, as they lie behind the mark.
    """
    from meteospark.catalog import FEATURES

    features = FEATURES if features is None else features

    def handle(batch: DataFrame, _: int) -> None:
        batch = batch.select(*[c for c in batch.columns if c not in ("batch", "month")]).withColumn("month", times.month_of(F.col("ts")))
        months = sinks.touched_months(batch)
        slot = F.window("ts", f"{step_minutes} minutes").start.alias("_slot")
        touched = batch.select("station_id", slot).distinct()
        read = lambda path: spark.read.schema(schema).parquet(path).where(sinks.in_months(months)).select(*batch.columns)
        both = read(near_path).unionAll(read(late_path)).drop("month")
        once = staging.first_row(both, identity, [c for c in both.columns if c not in identity])
        stored = once.select("*", slot).join(touched, ["station_id", "_slot"], "left_semi").drop("_slot")
        hours = resample.resample(stored, step_minutes, features=features)
        sinks.upsert(spark, hours, hours_path, ["station_id", "ts"], months=months, unique=True)

    return handle


def paired_forecasts(forecasts: DataFrame, observed: DataFrame, delay: str = "6 hours") -> DataFrame:
    """Stream of forecasts with the matched observation of their hour, `obs` (a struct, or null).

    A left outer join of two streams on station and hour, with watermarks on both sides: a forecast comes
    out as soon as its observation does, or without one once the watermark has passed its hour. Both
    sides' state goes at that point. Observations behind the watermark are for `jobs.reconcile_arrivals`.
    """
    left = forecasts.withColumn("_at", F.col("ts").cast("timestamp")).withWatermark("_at", delay)
    rest = F.struct(*observed.columns).alias("obs")
    right = observed.select(F.col("station_id").alias("_station"), F.col("ts").cast("timestamp").alias("_hour"), rest)
    right = right.withWatermark("_hour", delay)
    on = (F.col("station_id") == F.col("_station")) & (F.col("_at") == F.col("_hour"))
    return left.join(right, on, "leftOuter").select(*forecasts.columns, "obs")


def keep_paired(spark: SparkSession, forecast_path: str, bias_path: str | None, key):
    """Handler: reconciles what `paired_forecasts` gives and stores it; without an observation a forecast is
    stored as it came."""

    def handle(batch: DataFrame, _: int) -> None:
        hours = batch.where("obs IS NOT NULL").select("obs.*")
        matches = staging.first_row(hours, ["station_id", "ts"], [c for c in hours.columns if c.endswith("_eco")])
        bias = matching.bias_table(matches) if bias_path is None else sinks.read_table(spark, bias_path)
        sinks.upsert(spark, evaluation.reconcile(batch.drop("obs"), matches, bias), forecast_path, key)

    return handle


def run_stateful(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> list[dict]:
    """Runs a stateful stream over what has arrived and hands on its results; returns each batch's progress."""
    query = stream.writeStream.foreachBatch(handle).outputMode(mode).option("checkpointLocation", checkpoint)
    started = query.trigger(availableNow=True).start()
    started.awaitTermination()
    return [dict(p) for p in started.recentProgress]
