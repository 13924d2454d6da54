"""Data tests, all rules of a table in one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, functions as F

from meteospark.catalog import FEATURES
from meteospark.functions import times


def range_rules(df: DataFrame, rules: dict[str, tuple[float, float]], severity: str = "error") -> DataFrame:
    """One row per rule: rows outside the accepted range; NULL passes."""
    checks = [
        F.struct(
            F.lit(f"accepted_range_{c}").alias("rule"),
            F.lit(c).alias("column_name"),
            F.count_if(~F.col(c).between(low, high)).alias("n_failed"),
        )
        for c, (low, high) in rules.items()
    ]
    out = df.agg(F.array(*checks).alias("r")).select(F.inline("r"))
    status = F.when(F.col("n_failed") == 0, "pass").otherwise("warn" if severity == "warn" else "fail")
    return out.withColumn("status", status)


def key_rules(df: DataFrame, key) -> DataFrame:
    """not_null and unique on a key, counted from one aggregation by key."""
    null_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    counts = df.groupBy(*key).agg(F.count("*").alias("n"))
    checks = F.array(
        F.struct(
            F.lit("not_null").alias("rule"),
            F.coalesce(F.sum(F.when(null_key, F.col("n"))), F.lit(0)).alias("n_failed"),
        ),
        F.struct(
            F.lit("unique").alias("rule"), F.count_if(~null_key & (F.col("n") > 1)).alias("n_failed")
        ),
    )
    out = counts.agg(checks.alias("r")).select(F.inline("r"))
    return out.withColumn("status", F.when(F.col("n_failed") == 0, "pass").otherwise("fail"))


def sanity_failures(quality: DataFrame, as_of, benchmark_days: int = 6) -> DataFrame:
    """Quality rows that break a sanity rule.

    Missing or negative values fail at once; the reanalysis is only expected for rows older
    than its publication delay.
    """
    c = F.col
    any_of = lambda conditions: reduce(lambda a, b: a | b, conditions)
    missing = any_of(
        [c("ts").isNull()]
        + [c(f"{p}_{f}").isNull() for p in ("pred", "actual", "abs_error") for f in FEATURES]
    )
    negative = any_of(
        [c(f"abs_error_{f}") < 0 for f in FEATURES]
        + [c(f"{p}_{f}") < 0 for p in ("pred", "actual") for f in ("wind", "solar", "rain")]
    )
    impossible = any_of(
        [(c(f"{p}_pres") <= 0) | (c(f"{p}_rh") < 0) | (c(f"{p}_rh") > 100) for p in ("pred", "actual")]
    )
    due = c("ts") <= times.instant(as_of) - F.expr(f"INTERVAL '{int(benchmark_days)}' DAY")
    bad_benchmark = any_of(
        [c(f"{f}_era5").isNull() for f in FEATURES]
        + [c("pres_era5") <= 0, c("rh_era5") < 0, c("rh_era5") > 100]
        + [c(f"{f}_era5") < 0 for f in ("wind", "solar", "rain")]
    )
    return quality.where(F.coalesce(missing | negative | impossible | (due & bad_benchmark), F.lit(False)))


def require_columns(df: DataFrame, key) -> DataFrame:
    """Fails early when a join key is absent."""
    missing = [c for c in key if c not in df.columns]
    if missing:
        raise ValueError(f"missing key columns: {missing}")
    return df


def staged_metrics(ranges: dict[str, tuple[float, float]], columns=(), minimum: int | None = None) -> dict:
    """Aggregates over rows of `staging.counted_stage`, for `observed`: names of rules and what fails them.

    Every key comes once, with the number of its raw rows, so keys, ranges, NULLs and row counts are all
    told from what is being written.
    """
    keyed, copies = F.col("station_id").isNotNull() & F.col("ts").isNotNull(), F.col("_copies")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    out = {
        "rows": total(copies),
        "staged_rows": F.count_if(keyed),
        "not_null": total(F.when(~keyed, copies)),
        "unique": F.count_if(keyed & (copies > 1)),
    }
    out |= {f"accepted_range_{c}": F.count_if(keyed & ~F.col(c).between(low, high)) for c, (low, high) in ranges.items()}
    out |= {f"null_{c}": F.count_if(keyed & F.col(c).isNull()) for c in columns}
    if minimum is not None:
        out["minimum_rows"] = F.greatest(F.lit(minimum) - F.count_if(keyed), F.lit(0)).cast("long")
    return out


def observed(df: DataFrame, metrics: dict) -> tuple[DataFrame, Observation]:
    """The rows, which take the metrics along while they are written; read `observation.get` after the write.

    Attach it behind the last shuffle: a writing task that runs again counts once, while one before a
    shuffle may count twice when its output is lost.
    """
    observation = Observation()
    return df.observe(observation, *[c.alias(name) for name, c in metrics.items()]), observation


def report(spark, found: dict[str, int], informative=("rows", "staged_rows")) -> DataFrame:
    """rule, n_failed, status of observed metrics; counts that fail nothing have the status `info`."""
    rows = [(k, int(v), "info" if k in informative or k.startswith("null_") else "pass" if not v else "fail") for k, v in found.items()]
    return spark.createDataFrame(rows, "rule string, n_failed long, status string")
