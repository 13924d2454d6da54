"""Reanalysis grid to stations, matched table, bias tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from meteospark.catalog import BIAS_LIMITS, FEATURES, GRID_KEY
from meteospark.functions import cleaning, physics, times
from meteospark.operators import spans


def merge_grids(parts: list[DataFrame], key=GRID_KEY) -> DataFrame:
    """Merges partial grids; where two hold the same variable the earlier part wins."""

    def merge(left: DataFrame, right: DataFrame) -> DataFrame:
        shared = [c for c in right.columns if c in left.columns and c not in key]
        right = right.withColumnsRenamed({c: f"_r_{c}" for c in shared})
        both = left.join(right, list(key), "full")
        merged = {c: F.coalesce(c, f"_r_{c}") for c in shared}
        return both.withColumns(merged).drop(*[f"_r_{c}" for c in shared]) if shared else both

    return reduce(merge, parts)


def period_completeness(grid: DataFrame) -> DataFrame:
    """A month is final when the grid reaches its last day."""
    month = times.month_of(F.col("valid_time"))
    last = F.col("last_time")
    return (
        grid.groupBy(month.alias("month"))
        .agg(F.max("valid_time").alias("last_time"))
        .select("month", "last_time", (F.dayofmonth(last) == F.dayofmonth(F.last_day(last))).alias("is_final"))
    )


def grid_profile(grid: DataFrame, variables: list[str], as_of) -> DataFrame:
    """One row per variable: range, mean, missing values, coordinate extent, latency in days."""
    names = ("n", "n_null", "min_value", "max_value", "mean_value")
    aggs = []
    for v in variables:
        x = F.col(v)
        measures = (F.count("*"), F.count_if(x.isNull()), F.min(x), F.max(x), F.avg(x))
        aggs.append(F.struct(F.lit(v).alias("variable"), *[m.alias(n) for m, n in zip(measures, names)]))
    profile = grid.agg(
        F.array(*aggs).alias("vars"),
        F.count_distinct("valid_time").alias("n_times"),
        F.count_distinct("latitude").alias("n_lat"),
        F.count_distinct("longitude").alias("n_lon"),
        F.min("latitude").alias("lat_min"),
        F.max("latitude").alias("lat_max"),
        F.min("longitude").alias("lon_min"),
        F.max("longitude").alias("lon_max"),
        F.max("valid_time").alias("last_time"),
    )
    latency = F.timestamp_diff("DAY", F.col("last_time"), times.instant(as_of))
    return profile.withColumn("latency_days", latency).select(
        F.inline("vars"),
        "n_times",
        "n_lat",
        "n_lon",
        "lat_min",
        "lat_max",
        "lon_min",
        "lon_max",
        "last_time",
        "latency_days",
    )


#: Distinct latitudes or longitudes up to which a grid's axis is one sorted array (a global grid of 0.1 degrees
#: has 3,600); irregular grids with more are laid out in slices.
AXIS_VALUES = 1 << 16


def nearest_cells(stations: DataFrame, grid: DataFrame) -> DataFrame:
    """Nearest grid latitude and, independently, longitude per station; ties go to the larger.

    The axes of a grid are short, which is checked: each is an array that a station's coordinate is sought
    in by halving, and no station is shuffled. `grid` may be any table with the grid's coordinates, best a
    small one kept beside it.
    """
    axes = ("latitude", "longitude")
    sizes = grid.agg(*[F.approx_count_distinct(a).alias(a) for a in axes]).first()
    if max(sizes) > AXIS_VALUES // 2:  # the estimate is off by a few hundredths
        return nearest_cells_sliced(stations, grid)
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(AXIS_VALUES.bit_length()))])
    out = stations
    for a in axes:
        values = grid.agg(F.array_sort(F.collect_set(a))).scalar()
        out = out.withColumn("_axis", values)
        found = F.aggregate(halves, F.lit(0), lambda at, step: F.when(F.get("_axis", at + step - 1) <= F.col(a), at + step).otherwise(at))
        out = out.withColumn("_at", found)
        below, above, x = F.get("_axis", F.col("_at") - 1), F.get("_axis", F.col("_at")), F.col(a)
        pick = F.when(above.isNull() | (x - below < above - x), below).otherwise(above)
        out = out.withColumn(f"cell_{a}", F.when(x.isNotNull(), pick)).drop("_axis", "_at")
    return out


def nearest_cells_sliced(stations: DataFrame, grid: DataFrame) -> DataFrame:
    """The same for grids whose axes are too long for an array.

    Both sides are laid on one axis and each coordinate looks at its two grid neighbours, so
    no station is paired with more than two grid values. The axis is cut into slices of about as
    many points.
    """
    axes = ("latitude", "longitude")

    def points(df, value):
        coords = F.explode(F.create_map(*[x for a in axes for x in (F.lit(a), F.col(a))]))
        return df.select(coords.alias("axis", "x")).distinct().withColumn("g", value)

    on_axis = (
        points(stations, F.lit(None).cast("double"))
        .unionByName(points(grid, F.col("x")))
        .where(F.col("x").isNotNull())
        .groupBy("axis", "x")
        .agg(F.max("g").alias("g"))
    )
    on_axis = spans.value_slices(on_axis, ["axis"], "x").withColumnRenamed("_slice", spans.SPAN)
    points_near = spans.with_neighbours(
        spans.with_carry(on_axis, ["axis"], "x", ["g"]), ["axis"], "x", ["g"]
    )
    below, above, x = F.col("_prev_g"), F.col("_next_g"), F.col("x")
    pick = F.when(above.isNull() | (x - below < above - x), below).otherwise(above)
    nearest = points_near.select("axis", "x", pick.alias("cell"))
    out = stations
    for a in axes:
        side = nearest.where(F.col("axis") == a).select(F.col("x").alias(a), F.col("cell").alias(f"cell_{a}"))
        out = out.join(side, a, "left")
    return out


def convert_grid(grid: DataFrame) -> DataFrame:
    """Grid in station units, columns `{feature}_era5`."""
    units = physics.reanalysis_units(grid.columns)
    return grid.select(*GRID_KEY, *[units[f].alias(f"{f}_era5") for f in FEATURES])


def grid_cells(grid: DataFrame) -> DataFrame:
    """The cells of a grid; store it beside the grid, so that matching need not scan the grid for them."""
    return grid.select("latitude", "longitude").distinct()


def match(hourly: DataFrame, grid: DataFrame, stations: DataFrame, known_cells: DataFrame | None = None) -> DataFrame:
    """Station hours with the reanalysis of their nearest cell, missing where not yet published.

    The grid is joined by (hour, cell), not copied per station. With `known_cells` it is read once.
    """
    cells = nearest_cells(stations, grid if known_cells is None else known_cells).select("station_id", "cell_latitude", "cell_longitude")
    era5 = convert_grid(grid).withColumnsRenamed(
        {"valid_time": "ts", "latitude": "cell_latitude", "longitude": "cell_longitude"}
    )
    return (
        hourly.withColumn("ts", times.floor_hour(F.col("ts")))
        .join(cells, "station_id", "left")
        .join(era5, ["ts", "cell_latitude", "cell_longitude"], "left")
        .select(
            "station_id",
            "ts",
            *[f"{f}_era5" for f in FEATURES],
            *[F.col(f).alias(f"{f}_eco") for f in FEATURES],
        )
    )


def match_view(matches: DataFrame) -> DataFrame:
    """Matched pairs with their bias, values as they are."""
    return matches.select(
        "station_id",
        "ts",
        *[
            c
            for f in FEATURES
            for c in (f"{f}_eco", f"{f}_era5", (F.col(f"{f}_eco") - F.col(f"{f}_era5")).alias(f"bias_{f}"))
        ],
    )


def bias_table(matches: DataFrame, limits: dict[str, float] = BIAS_LIMITS) -> DataFrame:
    """Bias per feature from cleaned values, and a flag when any bias exceeds its limit."""
    kinds = dict(matches.dtypes)
    texts = [c for f in FEATURES for c in (f"{f}_eco", f"{f}_era5") if kinds[c] == "string"]
    cleaned = matches.withColumns({c: cleaning.blank_to_number(c) for c in texts}) if texts else matches
    cleaned = cleaning.nan_to_null(cleaned)
    pairs = cleaned.select(
        "station_id",
        "ts",
        *[
            c
            for f in FEATURES
            for c in (
                F.col(f"{f}_eco").alias(f"ecowitt_{f}"),
                F.col(f"{f}_era5").alias(f"era5_{f}"),
                (F.col(f"{f}_eco") - F.col(f"{f}_era5")).alias(f"bias_{f}"),
            )
        ],
    )
    over = reduce(lambda a, b: a | b, [F.abs(f"bias_{f}") > limits[f] for f in FEATURES])
    return pairs.withColumn("bias_overflow_flag", F.when(over, 1).otherwise(0))


def long_bias(bias: DataFrame, extra=()) -> DataFrame:
    """One row per feature."""
    ids = ["station_id", "ts", *extra]
    long = bias.select(*ids, *[F.col(f"bias_{f}").alias(f) for f in FEATURES])
    return long.unpivot(ids, list(FEATURES), "feature", "bias")


def monthly_bias(bias: DataFrame, month: str | None = None) -> DataFrame:
    """Mean, sample deviation and range of the bias per station, month and feature."""
    rows = bias if month is None else bias.where(times.in_month(F.col("ts"), month))
    rows = rows.withColumn("month", times.month_of(F.col("ts")))
    return (
        long_bias(rows, ["month"])
        .groupBy("station_id", "month", "feature")
        .agg(
            F.avg("bias").alias("mean_bias"),
            F.stddev_samp("bias").alias("std_bias"),
            F.min("bias").alias("min_bias"),
            F.max("bias").alias("max_bias"),
        )
    )


def mean_bias(matches: DataFrame) -> DataFrame:
    """Mean station minus reanalysis per station, over rows that have reanalysis."""
    rows = matches.dropna(subset=["temp_era5"])
    return rows.groupBy("station_id").agg(
        F.count("*").alias("n_matched"),
        *[F.avg(F.col(f"{f}_eco") - F.col(f"{f}_era5")).alias(f"mean_bias_{f}") for f in FEATURES],
    )
