"""Keyed tables whose first update is empty, and updates with repeated and null keys."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from meteospark import session
from meteospark.sources import sinks
from meteospark.streaming import jobs
from tests.helpers import frame, hours

KEY = ["station_id", "ts"]
BOUNDS = ("2024-01-31 20:00:00", "2024-02-01 03:00:00")


def rows(spark, path):
    return sorted(map(tuple, sinks.read_table(spark, path).select(*KEY, "temp").collect()), key=str)


def plain(df):
    return sorted(map(tuple, df.select(*KEY, "temp").collect()), key=str)


WRITES = {
    "upsert": lambda spark, df, path: sinks.upsert(spark, df, path, KEY),
    "append_new": lambda spark, df, path: sinks.append_new(spark, df, path, KEY, ["temp"]),
    "replace_range": lambda spark, df, path: sinks.replace_range(spark, df, path, "2024-01-01 00:00:00", "2024-12-31 00:00:00"),
    "replace_rows": lambda spark, df, path: sinks.replace_rows(spark, path, None, df, KEY),
    "dedup_arrivals": lambda spark, df, path: jobs.dedup_arrivals(spark, path, KEY, ["temp"])(df, 0),
}


@pytest.mark.parametrize("name", WRITES)
def test_empty_first_write(spark, name):
    path, df = session.run_folder(spark), frame(spark, hours(30, "2024-01-31 10:00"))
    write = WRITES[name]
    write(spark, df.limit(0), path)
    assert spark.read.parquet(path).count() == 0 and set(df.columns) < set(spark.read.parquet(path).columns)
    sinks.delete_range(spark, path, *BOUNDS)
    write(spark, df, path)
    write(spark, df.limit(0), path) if name != "replace_range" else None
    assert rows(spark, path) == plain(df)


def test_no_table_to_delete_from(spark):
    path = session.run_folder(spark)
    sinks.delete_range(spark, path, *BOUNDS)
    assert not sinks.table_exists(spark, path)


def test_emptied_months_keep_the_table(spark):
    path, df = session.run_folder(spark), frame(spark, hours(30, "2024-01-31 10:00"))
    sinks.upsert(spark, df, path, KEY)
    sinks.delete_range(spark, path, "2024-01-01 00:00:00", "2024-12-31 00:00:00")
    assert rows(spark, path) == []
    sinks.upsert(spark, df, path, KEY)
    sinks.replace_range(spark, df.limit(0), path, "2024-01-01 00:00:00", "2024-01-31 23:59:59")
    assert {r[1].month for r in rows(spark, path)} == {2}
    everything = sinks.read_table(spark, path)
    sinks.replace_rows(spark, path, everything.select(*KEY, "month"), df.limit(0), KEY)
    assert rows(spark, path) == []


def test_repeated_and_null_keys(spark):
    """An update with two rows of a key and keys without a station or time, applied three times."""
    at = pd.to_datetime(["2024-01-31 23:00"] * 3 + [None, None] + ["2024-02-01 01:00"] * 2)
    update = pd.DataFrame({"station_id": ["a", "a", None, "a", "a", None, None], "ts": at, "run": [2, 1, 1, 1, 2, 1, 1], "temp": [1.0, 9.0, 2.0, 3.0, 4.0, 5.0, 6.0]})
    df = frame(spark, update)
    path = session.run_folder(spark)
    for _ in range(3):
        sinks.upsert(spark, df, path, KEY, order=["run"])
    got = sinks.read_table(spark, path).select(*KEY, "run", "temp").collect()
    assert {(r.station_id, r.ts and r.ts.hour, r.run, r.temp) for r in got if r.station_id} == {("a", 23, 2, 1.0), ("a", None, 2, 4.0)}
    assert {(r.ts.hour, r.temp) for r in got if r.station_id is None} == {(23, 2.0), (1, 6.0)} and len(got) == 4
    sinks.upsert(spark, df.select(*KEY, F.lit(None).cast("double").alias("temp")), path, KEY)
    got = sinks.read_table(spark, path).collect()
    assert len(got) == 4 and {r.temp for r in got} == {None} and {r.run for r in got} == {1, 2}


def test_append_of_null_keys_happens_once(spark):
    df = frame(spark, pd.DataFrame({"station_id": [None, "a", None], "ts": pd.to_datetime(["2024-01-01"] * 3), "temp": [1.0, 2.0, 3.0]}))
    path = session.run_folder(spark)
    for _ in range(2):
        sinks.append_new(spark, df, path, KEY, ["temp"])
    assert sorted((r[0] or "", r[2]) for r in rows(spark, path)) == [("", 1.0), ("a", 2.0)]


def test_gaps_across_months_of_one_batch(spark):
    """Two months come at once inside an old gap that reaches past both; others stay as they are."""
    folder = session.run_folder(spark)
    handle = jobs.gap_arrivals(spark, f"{folder}/minutes", f"{folder}/gaps")
    at = lambda *t: frame(spark, pd.DataFrame({"station_id": "a", "ts": pd.to_datetime(list(t))}))
    batches = [
        ("2024-01-10 00:00", "2024-06-10 00:00"),
        ("2024-03-05 00:00", "2024-04-05 00:00"),
        ("2023-12-31 23:59", "2024-06-10 00:01", "2024-04-05 00:01"),
        ("2024-01-09 23:59",),
    ]
    from meteospark.operators import staging

    seen = []
    for k, batch in enumerate(batches):
        seen += batch
        handle(at(*batch), k)
        want = sorted(map(tuple, staging.gaps(at(*seen)).collect()))
        assert sorted(map(tuple, sinks.read_table(spark, f"{folder}/gaps").drop("month").collect())) == want


def test_checks_ride_on_the_write(spark):
    """Keys, ranges, NULLs and counts of a staged write equal those of separate scans; one job scans once."""
    from meteospark.catalog import SCHEMES, STAGING_RANGES
    from meteospark.operators import profiling, quality, staging

    folder = session.run_folder(spark)
    pdf = hours(300, "2024-01-25", nulls=0.1)
    rows = pd.concat([pdf, pdf.iloc[:20], pdf.iloc[:5]], ignore_index=True)
    rows.loc[200:203, "ts"] = pd.NaT
    rows.loc[210:211, "station_id"] = None
    rows.loc[220:230, "rh"] = 500.0
    raw = frame(spark, rows.rename(columns=SCHEMES["raw"])).withColumn("epoch_timestamp", F.unix_seconds(F.col("ts").cast("timestamp")))
    raw.write.parquet(f"{folder}/raw")
    raw = spark.read.parquet(f"{folder}/raw")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("checked", "checked")
    found = sinks.write_staged(spark, raw, f"{folder}/staged", STAGING_RANGES, 1_000)
    jobs_run = len(tracker.getJobIdsForGroup("checked"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    staged = staging.stage(raw).where("station_id IS NOT NULL").cache()
    keys = {r.rule: r.n_failed for r in quality.key_rules(raw, KEY).collect()}
    assert {k: found[k] for k in keys} == keys and found["rows"] == raw.count() and found["staged_rows"] == staged.count()
    assert {r.rule: r.n_failed for r in quality.range_rules(staged, STAGING_RANGES).collect()} == {k: v for k, v in found.items() if k.startswith("accepted")}
    values = [c for c in staged.columns if c not in KEY]
    nulls = profiling.null_counts(staged, values).first()
    assert {c: found[f"null_{c}"] for c in values} == {c: nulls[f"null_{c}"] for c in values}
    assert found["minimum_rows"] == 1_000 - staged.count()
    table = sinks.read_table(spark, f"{folder}/staged")
    assert table.count() == staged.count()
    plan = quality.observed(staging.counted_stage(raw), {"n": F.count("*")})[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan
    assert jobs_run <= 4  # the empty first file, and one write (adaptive execution runs a stage as a job)
    staged.unpersist()


def files_of(spark, path):
    """Data files of a table and when they were written."""
    return {r.f: r.t for r in spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_modification_time").alias("t")).distinct().collect()}


def test_an_update_rewrites_its_buckets_only(spark):
    path, stations = session.run_folder(spark), [f"s{k:02d}" for k in range(24)]
    everyone = frame(spark, pd.concat([hours(60, "2024-01-30 12:00", seed=k, station=s) for k, s in enumerate(stations)], ignore_index=True))
    sinks.upsert(spark, everyone, path, KEY, buckets=8)
    before = files_of(spark, path)
    update = everyone.where("station_id IN ('s03', 's17') AND ts >= '2024-02-01'").withColumn("temp", F.lit(-5.0))
    sinks.upsert(spark, update, path, KEY, buckets=8)
    after = files_of(spark, path)
    hit = {r.b for r in update.select(F.pmod(F.xxhash64("station_id"), F.lit(8)).cast("int").alias("b")).distinct().collect()}
    changed = {f for f in before if f not in after}
    assert changed and len(changed) < len(before) / 2
    assert all("month=2024-02" in f and int(f.split("bucket=")[1].split("/")[0]) in hit for f in changed)
    got = sinks.read_table(spark, path)
    assert got.count() == everyone.count() and got.where("temp = -5").count() == update.count()

    sinks.replace_range(spark, everyone.where("station_id = 's05' AND ts < '2024-01-31 06:00'"), path, "2024-01-31 00:00:00", "2024-01-31 23:00:00", stations=["s05"], buckets=8)
    late = files_of(spark, path)
    (own,) = [r[0] for r in spark.range(1).select(F.pmod(F.xxhash64(F.lit("s05")), F.lit(8)).cast("int")).collect()]
    assert all(f"month=2024-01/bucket={own}/" in f for f in after if f not in late)
    assert sinks.read_table(spark, path).count() == everyone.count() - 18
    with pytest.raises(ValueError):
        sinks.upsert(spark, update, path, KEY)


def test_freshness_reads_no_column_but_the_ends(spark, monkeypatch):
    from meteospark.operators import profiling

    path = session.run_folder(spark)
    sinks.upsert(spark, frame(spark, hours(24 * 120, "2024-01-10")), path, KEY)
    plans = []
    frame_type = type(spark.range(0))
    collect = frame_type.collect
    monkeypatch.setattr(frame_type, "collect", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), collect(df))[1])
    row = profiling.stored_freshness(spark, {"hours": (path, "ts")}).collect()[0]
    assert (str(row.first_ts), str(row.last_ts), row.n_rows) == ("2024-01-10 00:00:00", "2024-05-08 23:00:00", 24 * 120)
    count, ends = plans[0], plans[-1]
    assert "ReadSchema: struct<>" in count
    assert "ReadSchema: struct<ts:timestamp_ntz>" in ends and "month#" in ends.split("PartitionFilters: [")[1].split("]")[0]


def test_stations_far_apart_in_one_range(spark):
    path = session.run_folder(spark)
    df = frame(spark, pd.concat([hours(40, "2024-01-31", station=s) for s in "ab"], ignore_index=True))
    sinks.upsert(spark, df, path, KEY)
    sinks.replace_range(spark, df.limit(0), path, "2024-01-01 00:00:00", "2024-12-31 00:00:00", stations=["a"])
    assert {r[0] for r in rows(spark, path)} == {"b"} and len(rows(spark, path)) == 40


def test_columns_come_from_one_folder(spark):
    """New columns of an update, and tables that others have written, keep every column; NULL where a file has none."""
    path = session.run_folder(spark)
    df = frame(spark, hours(40, "2024-01-31"))
    df.withColumn("month", F.date_format("ts", "yyyy-MM")).write.partitionBy("month").parquet(path)
    sinks.upsert(spark, df.limit(3).select(*KEY, F.lit(1.0).alias("extra")), path, KEY)
    sinks.upsert(spark, df.where("ts > '2024-02-01'").select(*KEY, F.lit("x").alias("note")), path, KEY)
    table = sinks.read_table(spark, path)
    assert set(table.columns) == {*df.columns, "extra", "note", "month"}
    assert table.count() == 40 and table.where("extra = 1").count() == 3 and table.where("note = 'x'").count() == 15
    assert table.where("temp IS NULL").count() == 0
