"""Empty, short, hot and anomalous input; sinks; streams that stop and go on; plans."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from meteospark import session
from meteospark.catalog import FEATURES
from meteospark.functions import times
from meteospark.operators import matching, profiling, resample, staging, windows
from meteospark.sources import files, sinks
from meteospark.streaming import jobs
from tests.helpers import frame, hours, to_pandas

KEY = ["station_id", "ts"]


def test_no_data(spark):
    empty = frame(spark, hours(3)).limit(0)
    clean = resample.clean_hourly(empty)
    assert clean.count() == 0 and windows.sample_windows(clean, inputs=FEATURES).count() == 0
    assert staging.gaps(empty).count() == 0 and profiling.sensor_resolution(empty).count() == 0
    assert profiling.row_gate(empty).first().passes is False


def test_insufficient_data(spark):
    short = frame(spark, hours(20))
    assert windows.sample_windows(short, inputs=FEATURES).count() == 0
    assert {r.resolution for r in profiling.sensor_resolution(short).collect()} == {None}
    status = profiling.resolution_status(profiling.sensor_resolution(short))
    assert {r.status for r in status.collect()} == {"WARNING"}


def test_heatwave_is_flagged(spark):
    pdf = hours(60, "2026-09-01")
    for f in FEATURES:
        pdf[f"{f}_era5"], pdf[f"{f}_eco"] = pdf[f], pdf[f]
    pdf.loc[10:50, "temp_eco"] += 7.5
    flags = matching.bias_table(frame(spark, pdf.drop(columns=list(FEATURES)))).agg(F.sum("bias_overflow_flag")).first()[0]
    assert flags == 41


def test_no_interpolation_leaves_gaps(spark):
    pdf = hours(10).drop(index=[3, 4]).reset_index(drop=True)
    out = resample.clean_hourly(frame(spark, pdf), max_hours=0)
    assert out.count() == 10 and out.where("temp is null").count() == 2


def test_raw_telemetry_is_scanned_once(spark):
    path = session.run_folder(spark)
    frame(spark, hours(500)).write.parquet(path)
    df = resample.clean_hourly(spark.read.parquet(path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_range_read_prunes(spark):
    path = session.run_folder(spark)
    sinks.upsert(spark, frame(spark, hours(2000, "2024-01-01")), path, KEY)
    df = files.read_range(spark, path, ["ts", "temp"], "2024-02-03 00:00:00", "2024-02-05 00:00:00")
    plan = df._jdf.queryExecution().toString()
    assert df.count() == 49 and "PartitionFilters: [isnotnull(month" in plan and "PushedFilters: [IsNotNull(ts)" in plan


def test_upsert_keeps_other_columns_and_months(spark):
    path = session.run_folder(spark)
    sinks.upsert(spark, frame(spark, hours(100, "2024-01-30")), path, KEY)
    fresh = frame(spark, hours(10, "2024-01-31 20:00", seed=9)).select(*KEY, "temp", F.lit(1.0).alias("extra"))
    sinks.upsert(spark, fresh, path, KEY)
    out = spark.read.option("mergeSchema", True).parquet(path)
    assert out.count() == 100 and out.where("extra = 1").count() == 10 and out.where("rh is null").count() == 0
    sinks.delete_range(spark, path, "2024-01-30 00:00:00", "2024-01-31 23:00:00")
    left = spark.read.parquet(path)
    assert [r.month for r in left.select("month").distinct().collect()] == ["2024-02"] and left.count() == 52


def test_append_ignores_known_keys(spark):
    path = session.run_folder(spark)
    rows = frame(spark, hours(30))
    sinks.append_new(spark, rows, path, KEY, ["temp"])
    sinks.append_new(spark, rows.withColumn("temp", F.lit(0.0)).unionByName(frame(spark, hours(5, "2025-01-01"))), path, KEY, ["temp"])
    out = spark.read.parquet(path)
    assert out.count() == 35 and out.where("temp = 0").count() == 0


def test_database_form(spark):
    df = frame(spark, pd.DataFrame({"ts": [pd.Timestamp("2024-01-01 05:00")], "v": [1.0]})).withColumn("w", F.lit(float("nan")))
    row = sinks.for_database(df).first()
    assert row.ts == "2024-01-01 05:00:00" and row.w is None
    text = sinks.merge_statement("t", "t_stage", ["ts", "model_version", "v"], ["ts", "model_version"])
    assert text.endswith("ON CONFLICT (ts, model_version) DO UPDATE SET v = excluded.v")


def test_csv_months(spark):
    path = session.run_folder(spark)
    sinks.write_csv_months(frame(spark, hours(100, "2024-01-30")), path)
    back = spark.read.option("header", True).csv(path)
    assert back.count() == 100 and back.select("month").distinct().count() == 2


def test_late_rows_count_over_several_runs(spark):
    folder = session.run_folder(spark)
    minutes = lambda start, n: frame(spark, pd.DataFrame({"station_id": "a", "ts": pd.date_range(start, periods=n, freq="min"), "id": range(n)}))
    source = lambda: spark.readStream.schema("station_id string, ts timestamp_ntz, id bigint").parquet(f"{folder}/in")
    parts = [minutes("2024-01-31 23:57", 3), minutes("2024-02-01 00:05", 3), minutes("2024-02-01 00:02", 1), minutes("2024-01-31 23:57", 3)]
    seen = []
    for part in parts:  # the third lies inside a gap already announced, the fourth repeats the first
        part.write.mode("append").parquet(f"{folder}/in")
        jobs.run_batches(source(), jobs.gap_arrivals(spark, f"{folder}/minutes", f"{folder}/gaps"), f"{folder}/cp-gaps")
        jobs.run_batches(source(), jobs.dedup_arrivals(spark, f"{folder}/out", KEY, ["id"]), f"{folder}/cp")
        seen.append([(r.gap_start.minute, r.missing_min) for r in spark.read.parquet(f"{folder}/gaps").orderBy("gap_start").collect()])
    assert seen == [[], [(0, 5)], [(0, 2), (3, 2)], [(0, 2), (3, 2)]]
    out = spark.read.parquet(f"{folder}/out")
    assert out.count() == out.select(*KEY).distinct().count() == 7


def test_hot_station(spark):
    """One station holds most of the telemetry, much of it in one minute."""
    base = spark.range(60000).select(
        F.when(F.col("id") < 40000, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 50).cast("string"))).alias("station_id"),
        F.when(F.col("id") < 30000, F.lit(0)).otherwise(F.col("id") * 60).alias("e"),
        (F.col("id") % 7).cast("double").alias("v"),
    )
    rows = base.withColumns({"ts": times.epoch_to_minute(F.col("e")), "epoch_timestamp": F.col("e"), **{c: F.col("v") for c in ("outdoor_temperature_c", "outdoor_humidity", "abs_pressure_hpa", "wind_m_s", "solar_rad_w_m2", "hourly_rain_mm")}})
    staged = staging.stage(rows)
    assert staged.count() == rows.select("station_id", "ts").distinct().count()
    assert staged.where("station_id = 'hot' and ts = '1970-01-01 00:00:00'").first().temperature == 0.0


def test_grid_merge_prefers_the_earlier_part(spark):
    key = "valid_time timestamp_ntz, latitude double, longitude double"
    t = pd.Timestamp("2024-01-01").to_pydatetime()
    a = spark.createDataFrame([(t, 1.0, 1.0, 5.0), (t, 2.0, 1.0, None)], key + ", t2m double")
    b = spark.createDataFrame([(t, 1.0, 1.0, 7.0, 1.0), (t, 2.0, 1.0, 8.0, 2.0), (t, 3.0, 1.0, 9.0, 3.0)], key + ", t2m double, tp double")
    got = {r.latitude: (r.t2m, r.tp) for r in matching.merge_grids([a, b]).collect()}
    assert got == {1.0: (5.0, 1.0), 2.0: (8.0, 2.0), 3.0: (9.0, 3.0)}
    assert to_pandas(matching.convert_grid(a.withColumns({"d2m": F.lit(270.0), "sp": F.lit(1e5)})), ["latitude"])["rain_era5"].tolist() == [0.0, 0.0]


@pytest.mark.parametrize("name", ["gap_report", "dedup_staging", "nearest_grid", "clean_hourly", "sensor_resolution", "registry_active", "replay_extend", "long_history_interpolation"])
def test_registered_query_matches_sql(spark, name):
    from checks.compare import compare, database

    sf = "/root/testdata/sf0.001"
    assert compare(spark, database(sf), sf, name).startswith("OK")


def test_gaps_are_filled_in_as_many_tasks_as_a_shuffle_has(spark):
    """Few rows far apart become many: adaptive execution must not put them into one task, nor broadcast them."""
    rows = frame(spark, hours(24 * 40).iloc[[0, 200, 500, -1]])
    dense = resample.interpolate(rows, max_hours=None)
    assert dense.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    dense.collect()
    assert "BroadcastHashJoin" not in dense._jdf.queryExecution().executedPlan().toString()
