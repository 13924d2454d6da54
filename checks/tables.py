"""Driver tables as telemetry, reanalysis grid, stations and forecasts.

Measures are multiples of a power of two, so sums are exact in any order and the two engines
can be compared to the last digit before quantisation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from meteospark import session
from meteospark.catalog import FEATURES
from meteospark.operators import matching, model, resample
from meteospark.sources import sinks

READING = r"(\d+)"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def readings(events: DataFrame, station: str) -> DataFrame:
    """Sensor readings from rows of the events table."""
    u = F.floor(F.col("value") / 8).cast("double")
    v = F.floor(F.col("value") * 16) / 16.0
    k = F.get_json_object("props", "$.k").cast("int")
    base = events.select(
        F.col(station).cast("string").alias("station_id"),
        "ts",
        "event_id",
        u.alias("u"),
        v.alias("v"),
        k.alias("k"),
    )
    u, v, k = F.col("u"), F.col("v"), F.col("k")
    return base.select(
        "station_id",
        "ts",
        "event_id",
        (u - 4).alias("temp"),
        k.cast("double").alias("rh"),
        (k + 950.0).alias("pres"),
        (v / 16).alias("wind"),
        F.when(k >= 5, k * 10.0).alias("solar"),
        F.when(k <= 95, F.greatest(v - 100, F.lit(0.0)) / 8).alias("rain"),
    )


def telemetry(spark: SparkSession, sf: str, station: str = "event_type") -> DataFrame:
    """Readings by `event_type`, few busy stations, or by `user_id`, a sparse fleet."""
    return readings(table(spark, sf, "events"), station)


def fleet(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry(spark, sf, "user_id")


def stations(spark: SparkSession, sf: str) -> DataFrame:
    """One station per customer; user ids are customer keys."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("station_id"),
        (40 + F.floor("c_acctbal") / 4096.0).alias("latitude"),
        (5 + F.col("c_nationkey") / 8.0).alias("longitude"),
    )


def busy_stations(spark: SparkSession, sf: str) -> DataFrame:
    """Coordinates of the busy stations: those of the customer who reported first."""
    first = (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("station_id"))
        .agg(F.min_by("user_id", "event_id").cast("string").alias("reporter"))
    )
    places = stations(spark, sf).withColumnRenamed("station_id", "reporter")
    return first.join(places, "reporter").drop("reporter")


def grid(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly reanalysis grid of 10 x 10 cells; cell hours without an event are missing."""
    k = F.get_json_object("props", "$.k").cast("int")
    v = F.floor(F.col("value") * 16) / 16.0
    cells = table(spark, sf, "events").select(
        F.window("ts", "60 minutes").start.alias("valid_time"),
        (40 + F.floor(k / 10) / 4.0).alias("latitude"),
        (5 + (k - 10 * F.floor(k / 10)) / 4.0).alias("longitude"),
        F.floor(F.col("value") / 8).cast("double").alias("u"),
        v.alias("v"),
        k.alias("k"),
    )
    return cells.groupBy("valid_time", "latitude", "longitude").agg(
        (F.avg("u") + 270).alias("t2m"),
        (F.avg("u") / 2 + 268).alias("d2m"),
        (F.avg("k") * 100 + 95000).alias("sp"),
        (F.avg("v") / 32).alias("u10"),
        (F.max("v") / 64).alias("v10"),
        (F.avg("k") * 36000).alias("ssrd"),
        (F.max("v") / 65536).alias("tp"),
    )


def hourly(spark: SparkSession, sf: str, station: str = "event_type") -> DataFrame:
    return resample.clean_hourly(telemetry(spark, sf, station))


def hourly_table(spark: SparkSession, sf: str, station: str = "event_type") -> DataFrame:
    """The hourly series as the pipeline's table, for queries that read it several times."""
    return sinks.materialise(hourly(spark, sf, station), session.run_folder(spark), "hourly")


def baselines(hours: DataFrame) -> DataFrame:
    """Baseline forecasts; means are rounded, as the order in which they were summed must not decide a comparison."""
    rows = model.baseline_forecasts(hours)
    mean = F.col("model_version") == "climatology"
    near = lambda c: F.when(mean, F.floor(F.col(c) * 1e6 + 0.5) / 1e6).otherwise(F.col(c))
    return rows.withColumns({f"pred_{f}": near(f"pred_{f}") for f in FEATURES})


def matches(spark: SparkSession, sf: str, station: str = "event_type", hours: DataFrame | None = None) -> DataFrame:
    places = busy_stations(spark, sf) if station == "event_type" else stations(spark, sf)
    hours = hourly_table(spark, sf, station) if hours is None else hours
    return matching.match(hours, grid(spark, sf), places)
