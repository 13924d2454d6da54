"""Station dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meteospark.catalog import NOMINAL_SPECS
from meteospark.functions import cleaning, times


def dimension(config: DataFrame, as_of) -> DataFrame:
    """Station rows from configuration text.

    Height is the elevation when positive, 2 m at or below ground floor, else 3 m per floor
    plus 1.5. Blank text counts as missing.
    """
    number = cleaning.blank_to_number
    elevation, floor = number("elevation"), F.coalesce(number("floor"), F.lit(0.0))
    # halves away from zero, as the SQL round does
    height = (
        F.when(elevation > 0, F.floor(elevation))
        .when(floor <= 0, F.lit(2))
        .otherwise(F.floor(floor * 3.0 + 1.5 + 0.5))
        .cast("int")
    )
    return config.select(
        "station_id",
        F.coalesce(F.nullif(F.trim("station_name"), F.lit("")), F.lit("Default Station")).alias("station_name"),
        F.coalesce(number("latitude"), F.lit(0.0)).alias("latitude"),
        F.coalesce(number("longitude"), F.lit(0.0)).alias("longitude"),
        height.alias("elevation_m"),
        height.alias("height_above_ground_m"),
        F.coalesce(number("min_training_days"), F.lit(14)).cast("int").alias("min_training_days"),
        F.coalesce(number("retrain_window_days"), F.lit(30)).cast("int").alias("retrain_window_days"),
        times.instant(as_of).alias("updated_at"),
    )


def with_defaults(stations: DataFrame, specs=NOMINAL_SPECS) -> DataFrame:
    """Station metadata as read by the pipeline: gaps filled, spec text parsed."""
    fill = {
        "station_name": "Local Home Weather Station",
        "elevation_m": 0.0,
        "min_training_days": 14,
        "retrain_window_days": 30,
    }
    return stations.fillna(fill).withColumn("sensor_specs", cleaning.parse_specs(F.col("sensor_specs"), specs))


def resolution_of(feature: str, specs: str = "sensor_specs", default=NOMINAL_SPECS) -> Column:
    """Resolution of a feature in a row's spec map."""
    entry = F.try_element_at(F.col(specs), F.lit(f"ecowitt_{feature}"))
    return F.coalesce(entry["resolution"], F.lit(default[feature][0]))
