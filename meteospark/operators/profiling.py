"""Sensor profiling, null audits, freshness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from meteospark.catalog import FEATURES, NOMINAL_SPECS
from meteospark.functions import cleaning
from meteospark.operators import spans


def melt(df: DataFrame, ids, features=FEATURES, value: str = "value") -> DataFrame:
    """Wide to long over the features."""
    return df.select(*ids, *features).unpivot(list(ids), list(features), "feature", value)


def null_counts(df: DataFrame, columns, by=()) -> DataFrame:
    """Rows and NULLs per column, one pass."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    )


def non_null_count(columns):
    """Number of filled columns of a row."""
    return reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in columns])


def sensor_resolution(df: DataFrame, min_rows: int = 50, features=FEATURES) -> DataFrame:
    """Most frequent step between neighbouring distinct values, the smallest on a tie.

    NULL below `min_rows` values or with fewer than two distinct ones.
    """
    keys = ["station_id", "feature"]
    counts = melt(df, ["station_id"], features).groupBy(*keys, "value").agg(F.count("*").alias("n"))
    sizes = counts.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("n_values"),
        F.count("value").alias("n_distinct"),
    )
    values = spans.value_slices(counts.where(F.col("value").isNotNull()), keys, "value")
    steps = spans.with_previous(values, keys, "value", F.col("_slice"), "_prev")
    diff = F.round(F.col("value") - F.col("_prev"), 4)
    modes = (
        steps.select(*keys, diff.alias("step"))
        .where("step > 0")
        .groupBy(*keys, "step")
        .agg(F.count("*").alias("times"))
        .groupBy(*keys)
        .agg(F.max_by("step", F.struct("times", -F.col("step"))).alias("mode_step"))
    )
    enough = (F.col("n_values") >= min_rows) & (F.col("n_distinct") >= 2)
    return sizes.join(modes, keys, "left").select(
        *keys, "n_values", "n_distinct", F.when(enough, F.round("mode_step", 4)).alias("resolution")
    )


def sensor_deadband(df: DataFrame, wind_percentile: float = 0.1) -> DataFrame:
    """Activation floor: a low percentile of positive wind, the smallest positive rain."""
    wind = spans.exact_percentile(
        df.where(F.col("wind") > 0).select("station_id", "wind"),
        ["station_id"],
        "wind",
        wind_percentile,
        "wind_deadband",
    )
    rain = df.groupBy("station_id").agg(F.min(F.when(F.col("rain") > 0, F.col("rain"))).alias("rain_deadband"))
    return rain.join(wind, "station_id", "left").select("station_id", "wind_deadband", "rain_deadband")


def resolution_status(resolution: DataFrame, specs=NOMINAL_SPECS) -> DataFrame:
    """Compares estimated resolutions with the nominal ones."""
    expected = F.create_map(*[x for f, (r, _) in specs.items() for x in (F.lit(f), F.lit(r))])
    out = resolution.withColumn("expected", F.element_at(expected, F.col("feature")))
    est, exp = F.col("resolution"), F.col("expected")
    ok = cleaning.close_to(est, exp)
    status = F.when(est.isNull(), "WARNING").when(ok, "OK").otherwise("ANOMALY")
    diagnosis = (
        F.when(est.isNull(), "insufficient variation")
        .when(ok, "nominal")
        .when(est < exp, "finer than expected")
        .otherwise("coarser than expected")
    )
    return out.withColumn("status", status).withColumn("diagnosis", diagnosis)


def profiled_specs(resolution: DataFrame, deadband: DataFrame, specs=NOMINAL_SPECS) -> DataFrame:
    """Spec map and its JSON text per station: estimates where there are any, else nominal."""
    per_feature = resolution.groupBy("station_id").agg(
        *[F.max(F.when(F.col("feature") == f, F.col("resolution"))).alias(f"res_{f}") for f in specs]
    )
    rows = per_feature.join(deadband, "station_id", "left")
    entries = []
    for f, (res, dead) in specs.items():
        floor = F.coalesce(F.col(f"{f}_deadband"), F.lit(dead)) if f in ("wind", "rain") else F.lit(dead)
        spec = F.struct(
            F.coalesce(F.col(f"res_{f}"), F.lit(res)).alias("resolution"), floor.alias("deadband")
        )
        entries += [F.lit(f"ecowitt_{f}"), spec]
    specs_map = F.create_map(*entries)
    return rows.select("station_id", specs_map.alias("sensor_specs"), F.to_json(specs_map).alias("specs_json"))


def freshness(tables: dict[str, tuple[DataFrame, str]], as_of=None) -> DataFrame:
    """First and last time and row count per table; `is_latest` marks the newest table."""
    parts = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.min(c).alias("first_ts"),
            F.max(c).alias("last_ts"),
            F.count("*").alias("n_rows"),
        )
        for name, (df, c) in tables.items()
    ]
    out = reduce(DataFrame.unionByName, parts)
    # one row per table: the unpartitioned window sees as many rows as there are tables
    newest = F.max("last_ts").over(W.partitionBy())
    return out.withColumn("is_latest", F.col("last_ts") == newest)


def stored_freshness(spark, tables: dict[str, tuple[str, str]]) -> DataFrame:
    """`freshness` of tables stored by month (path, time column), from their files' statistics.

    Rows are counted by month from the files' footers, no column is read; then the first and last month with
    rows give the ends of the time column. One row a month reaches the driver.
    """
    parts = []
    for name, (path, at) in tables.items():
        df = spark.read.parquet(path)
        months = {r["month"]: r["count"] for r in df.groupBy("month").count().collect()}
        dated = sorted(m for m in months if m is not None)
        ends = df.where(F.col("month").isin(dated[:1] + dated[-1:])).agg(F.min(at).alias("first_ts"), F.max(at).alias("last_ts"))
        counted = F.lit(sum(months.values())).cast("long").alias("n_rows")
        parts.append(ends.select(F.lit(name).alias("table_name"), "first_ts", "last_ts", counted))
    out = reduce(DataFrame.unionByName, parts)
    newest = F.max("last_ts").over(W.partitionBy())  # one row per table
    return out.withColumn("is_latest", F.col("last_ts") == newest)


def latest_rows(df: DataFrame, n: int, by=("station_id",), at: str = "ts", tie=()) -> DataFrame:
    """Last n rows per key; Spark cuts every partition to n rows per key before the shuffle."""
    w = W.partitionBy(*by).orderBy(F.col(at).desc(), *[F.col(c).asc() for c in tie])
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def latest(df: DataFrame, n: int, at: str = "ts", tie=()) -> DataFrame:
    """Last n rows of a table in chronological order."""
    ties = [F.col(c).asc() for c in tie]
    return df.orderBy(F.col(at).desc(), *ties).limit(n).orderBy(at, *ties)


def row_gate(df: DataFrame, minimum: int = 100) -> DataFrame:
    """Row count against a minimum."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("passes", F.col("n_rows") >= minimum)
