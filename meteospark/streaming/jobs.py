"""Incremental forms of the batch operators on Structured Streaming.

A micro-batch is handed to a batch operator that recomputes what the batch touches from stored rows.
Late and repeated rows so count as they do in a batch run, and open slots are shown. Handlers may run again
on the same batch. Every query gets its checkpoint folder from the caller; `maxFilesPerTrigger` on the
source bounds a batch. Operators with keyed state and watermarks are in `state.py`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from meteospark.functions import times
from meteospark.operators import evaluation, matching, resample, staging
from meteospark.session import run_folder
from meteospark.sources import sinks


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hands each micro-batch to a batch operator; handlers must be repeatable.

    Handlers read their batch several times, so it lies in the shared folder until they are done: a lost
    executor costs nothing.
    """

    def kept(batch: DataFrame, number: int) -> None:
        path = f"{run_folder(batch.sparkSession)}/batch"
        batch.write.parquet(path)
        handle(batch.sparkSession.read.schema(batch.schema).parquet(path), number)
        sinks.drop_table(batch.sparkSession, path)

    query = stream.writeStream.foreachBatch(kept).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()


def _months(batch: DataFrame, at: str = "ts") -> tuple[DataFrame, list[str | None]]:
    batch = batch.withColumn("month", times.month_of(F.col(at)))
    return batch, sinks.touched_months(batch)


def _same(key, left: DataFrame, right: DataFrame):
    """Equal keys, null and null as well."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in key])


def dedup_arrivals(spark: SparkSession, path: str, key, order):
    """Handler: one row per key, the smallest by `order` of all that has arrived."""

    def handle(batch: DataFrame, _: int) -> None:
        _, months = _months(batch)
        best = staging.first_row(batch, key, order)
        if sinks.table_exists(spark, path):
            held = sinks.read_table(spark, path, months).drop("month")
            known = held.join(best, _same(key, held, best), "left_semi")
            best = staging.first_row(known.unionByName(best, allowMissingColumns=True), key, order)
        sinks.upsert(spark, best, path, key, months=months, unique=True)

    return handle


def hourly_arrivals(spark: SparkSession, readings_path: str, hours_path: str, identity, step_minutes: int = 60):
    """Handler: stores new readings and resamples the slots they fall into from all stored readings.

    `identity` are the columns that make a reading one reading, so a repeated file counts once. A slot
    lies in the month of its readings, so the batch names the months that are read and written.
    """

    def handle(batch: DataFrame, _: int) -> None:
        rest = [c for c in batch.columns if c not in identity]
        _, months = _months(batch)
        sinks.append_new(spark, batch, readings_path, identity, rest, months=months)
        slot = F.window("ts", f"{step_minutes} minutes").start.alias("_slot")
        touched = batch.select("station_id", slot).distinct()
        stored = sinks.read_table(spark, readings_path, months).drop("month")
        stored = stored.select("*", slot).join(touched, ["station_id", "_slot"], "left_semi").drop("_slot")
        hours = resample.resample(stored, step_minutes)
        sinks.upsert(spark, hours, hours_path, ["station_id", "ts"], months=months, unique=True)

    return handle


def gap_arrivals(spark: SparkSession, minutes_path: str, gaps_path: str, max_step_minutes: float = 1.5):
    """Handler: stores new minutes and finds the gaps around them anew.

    A table beside the minutes, `{minutes_path}-ends`, holds the first and last minute of each station and
    month. A batch changes gaps inside its own station months and from those to the nearest minutes of
    other months, which that table knows: only the batch's months of minutes, and the months of gaps
    between those ends, are read.
    """
    key = ["station_id", "ts"]
    ends_path = f"{minutes_path}-ends"

    def handle(batch: DataFrame, _: int) -> None:
        folder = run_folder(spark)
        minutes = batch.select("station_id", times.floor_minute(F.col("ts")).alias("ts"))
        minutes = minutes.where(F.col("station_id").isNotNull() & F.col("ts").isNotNull())
        minutes, months = _months(minutes.distinct())
        sinks.append_new(spark, minutes.drop("month"), minutes_path, key, [], months=months)
        touched = minutes.select("station_id", "month").distinct()
        stored = sinks.read_table(spark, minutes_path, months).join(touched, ["station_id", "month"], "left_semi")
        own = stored.groupBy("station_id", "month").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
        own = sinks.materialise(own, folder, "own")
        sinks.upsert(spark, own.drop("month"), ends_path, ["station_id"], at="first_ts", months=months, unique=True)
        # the nearest minutes of other months, one row for each station month of the batch
        others = sinks.read_table(spark, ends_path).select("station_id", F.col("first_ts").alias("_f"), F.col("last_ts").alias("_l"))
        around = own.join(others, "station_id", "left").groupBy("station_id", "month").agg(
            F.max(F.when(F.col("_l") < F.col("first_ts"), F.col("_l"))).alias("_from"),
            F.min(F.when(F.col("_f") > F.col("last_ts"), F.col("_f"))).alias("_to"),
            F.first("first_ts").alias("_first"),
            F.first("last_ts").alias("_last"),
        )
        around = sinks.materialise(around, folder, "around")
        edges = around.select("station_id", F.explode(F.array("_from", "_to")).alias("ts")).where(F.col("ts").isNotNull())
        near = stored.select(*key).unionByName(edges).distinct()
        # two months of a batch may be far apart: steps between them that neither month knows of are no steps
        steps = staging.gaps(near, max_step_minutes)
        reach = around.select(
            "station_id",
            F.coalesce("_from", "_first").alias("_from"),
            F.coalesce("_to", "_last").alias("_to"),
            "_first",
            "_last",
        )
        inside = (F.col("gap_start") > F.col("_from")) & (F.col("gap_end") < F.col("_to"))
        # an old gap may have gone past several months that now have minutes
        across = (F.col("gap_start") <= F.col("_last")) & (F.col("gap_end") >= F.col("_first"))
        within = lambda gaps, which: gaps.join(reach, "station_id").where(which).select(*gaps.columns).distinct()
        gone = None
        if sinks.table_exists(spark, gaps_path):
            # a gap begins in the month of the minute before it or in the next one
            step = F.expr("INTERVAL '1' MINUTE")
            begins = around.select(
                F.explode(F.array_distinct(F.array(*[times.month_of(F.col(c) + step) for c in ("_from", "_first", "_last")], "month"))).alias("month")
            )
            old = sinks.read_table(spark, gaps_path, sinks.touched_months(begins))
            gone = within(old.select("station_id", "gap_start", "gap_end", "month"), inside | across).drop("gap_end")
        sinks.replace_rows(spark, gaps_path, gone, within(steps, inside), ["station_id", "gap_start"], at="gap_start")

    return handle


def rematch_late_grid(
    spark: SparkSession,
    hourly_path: str,
    grid_path: str,
    stations: DataFrame,
    matches_path: str,
    forecast_path: str | None = None,
    forecast_key=None,
):
    """Handler: late reanalysis re-matches the station hours it covers, hour by hour, and reconciles the
    forecasts of those hours, whose bias was unknown until then. Other hours and months stay as they are."""

    def handle(batch: DataFrame, _: int) -> None:
        hours = batch.select(F.col("valid_time").alias("ts")).where(F.col("ts").isNotNull()).distinct()
        hours, months = _months(sinks.materialise(hours, run_folder(spark), "hours"))
        if not months:
            return
        of = lambda path, at: sinks.read_table(spark, path, months).drop("month").join(
            hours.select(F.col("ts").alias(at)), at, "left_semi"
        )
        fresh = matching.match(of(hourly_path, "ts"), of(grid_path, "valid_time"), stations)
        fresh = sinks.materialise(fresh, run_folder(spark), "rematch")
        sinks.replace_rows(spark, matches_path, hours, fresh, ["ts"])
        if forecast_path is not None:
            closed = evaluation.reconcile(of(forecast_path, "ts"), fresh, matching.bias_table(fresh))
            sinks.upsert(spark, closed, forecast_path, forecast_key, months=months)

    return handle


def reconcile_arrivals(spark: SparkSession, forecast_path: str, bias_path: str, key):
    """Handler: newly arrived matched observations close the forecasts of their hours."""

    def handle(batch: DataFrame, _: int) -> None:
        batch = batch.withColumn("month", times.month_of(F.col("ts")))
        months = sinks.touched_months(batch)
        if not months:
            return
        hours = batch.select("station_id", "ts").distinct()
        forecast = sinks.read_table(spark, forecast_path, months).drop("month")
        forecast = forecast.join(hours, ["station_id", "ts"], "left_semi")
        bias = sinks.read_table(spark, bias_path, months)
        first = staging.first_row(batch, ["station_id", "ts"], [c for c in batch.columns if c.endswith("_eco")])
        closed = evaluation.reconcile(forecast, first, bias)
        sinks.upsert(spark, closed, forecast_path, key, months=months)

    return handle


def consensus_arrivals(spark: SparkSession, forecast_path: str, stats_path: str):
    """Handler: new forecast runs re-aggregate exactly the targets they touch.

    Every run counts as a vote, so a touched target is recomputed from the stored history,
    which must already hold the batch.
    """

    def handle(batch: DataFrame, _: int) -> None:
        batch = batch.withColumn("month", times.month_of(F.col("ts")))
        months = sinks.touched_months(batch)
        if not months:
            return
        key = ["station_id", "model_version", "ts"]
        history = sinks.read_table(spark, forecast_path, months)
        touched = history.join(batch.select(*key).distinct(), key, "left_semi")
        sinks.upsert(spark, evaluation.consensus(touched), stats_path, key, months=months, unique=True)

    return handle
