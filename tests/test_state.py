"""Keyed state, timers and watermarks over several micro-batches, against batch results."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from meteospark import session
from meteospark.operators import resample, staging
from meteospark.sources import sinks
from meteospark.streaming import jobs, state
from tests.helpers import frame

SCHEMA = "station_id string, ts timestamp_ntz, id bigint, temp double, rain double"


def minutes(station, start, n, first=0):
    at = pd.date_range(start, periods=n, freq="min")
    ids = range(first, first + n)
    return pd.DataFrame({"station_id": station, "ts": at, "id": ids, "temp": [float(i % 8) for i in ids], "rain": [float(i % 5) for i in ids]})


def send(spark, folder, *parts):
    rows = frame(spark, pd.concat(parts)).select("station_id", "ts", F.col("id").cast("bigint").alias("id"), "temp", "rain")
    rows.coalesce(1).write.mode("append").parquet(f"{folder}/in")


def source(spark, folder, name="in", schema=SCHEMA):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/{name}")


@pytest.fixture
def rocksdb(spark):
    state.use_rocksdb(spark)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_silence_alone_raises_an_alarm(spark, rocksdb):
    folder = session.run_folder(spark)
    send(spark, folder, minutes("a", "2024-01-31 23:40", 10), minutes("b", "2024-01-31 23:40", 10))
    send(spark, folder, minutes("b", "2024-01-31 23:50", 40), minutes("a", "2024-01-31 23:53", 1))  # a falls silent at 23:53
    send(spark, folder, minutes("b", "2024-02-01 00:30", 30))
    path = f"{folder}/alarms"

    def run():
        alarms = state.silence_alarms(source(spark, folder), delay="5 minutes", limit=15)
        state.run_stateful(alarms, state.keep_alarms(spark, path), f"{folder}/cp")
        rows = sinks.read_table(spark, path).orderBy("station_id", "gap_start").collect()
        return [(r.station_id, f"{r.gap_start:%H:%M}", r.gap_end and f"{r.gap_end:%H:%M}", r.missing_min, r.is_open) for r in rows]

    # no row of station a has come since 23:53; the third file has none of it either
    assert run() == [("a", "23:50", "23:52", 3, False), ("a", "23:54", None, None, True)]
    send(spark, folder, minutes("a", "2024-02-01 01:02", 5), minutes("b", "2024-02-01 01:00", 30))
    send(spark, folder, minutes("a", "2024-02-01 01:29", 11), minutes("b", "2024-02-01 01:30", 30))
    send(spark, folder, minutes("a", "2024-02-01 01:40", 10), minutes("b", "2024-02-01 02:00", 5))
    closed = [r for r in run() if not r[4]]
    stored = spark.read.parquet(f"{folder}/in")
    gaps = staging.gaps(stored).orderBy("station_id", "gap_start").collect()
    assert closed == [(r.station_id, f"{r.gap_start:%H:%M}", f"{r.gap_end:%H:%M}", r.missing_min, False) for r in gaps]
    assert [r[:3] for r in run() if r[4]] == []


def test_state_of_silence_is_bounded(spark, rocksdb):
    folder = session.run_folder(spark)
    for hour in range(6):
        send(spark, folder, *[minutes(s, f"2024-01-01 {hour:02d}:00", 60) for s in "abc"])
    alarms = state.silence_alarms(source(spark, folder), delay="5 minutes", limit=15)
    progress = state.run_stateful(alarms, state.keep_alarms(spark, f"{folder}/alarms"), f"{folder}/cp")
    held = [op["numRowsTotal"] for p in progress for op in p["stateOperators"]]
    assert len(held) >= 6 and max(held[2:]) <= 3 * 150 and sinks.read_table(spark, f"{folder}/alarms").count() == 0


def test_near_state_and_late_path_lose_no_row(spark):
    folder = session.run_folder(spark)
    day = minutes("a", "2024-01-01 00:00", 600)
    late = day.iloc[100:140]
    for part in (day.iloc[:100], day.iloc[140:300], day.iloc[250:420], day.iloc[420:], late, late.iloc[:5]):
        send(spark, folder, part)
    near, behind, hours = f"{folder}/near", f"{folder}/late", f"{folder}/hours"
    features = ("temp", "rain")
    jobs.run_batches(source(spark, folder), state.split_late(spark, near, behind, 30), f"{folder}/cp-split")
    schema = SCHEMA + ", batch int, month string"
    read = lambda path: spark.read.schema(schema).parquet(path)
    sent = spark.read.parquet(f"{folder}/in").count()
    assert read(near).count() + read(behind).count() == sent == 655
    assert state.late_count(spark, near) == read(behind).count() >= 45

    identity = ["station_id", "ts", "id"]
    found = state.near_hours(source(spark, folder, "near", schema).drop("batch", "month"), identity, 30, features=features)
    keep = lambda batch, _: sinks.upsert(spark, batch, hours, ["station_id", "ts"])
    progress = state.run_stateful(found, keep, f"{folder}/cp-near", "update")
    dropped = [op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"]]
    held = [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in progress]
    assert sum(dropped) == 0 and max(held) < 500 and held[-1] < 300

    mend = state.late_hours(spark, near, behind, hours, schema, identity, features=features)
    jobs.run_batches(source(spark, folder, "late", schema), mend, f"{folder}/cp-late")
    want = resample.resample(spark.read.parquet(f"{folder}/in").distinct(), features=features).select("station_id", "ts", *features)
    got = sinks.read_table(spark, hours).select("station_id", "ts", *features)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_sending_is_the_work_of_many_tasks(spark):
    from checks import streams

    seen = []
    look = lambda batch, _: seen.append(batch.select(F.input_file_name().alias("f")).agg(F.count("*"), F.count_distinct("f")).first()[:])
    arriving = streams._arriving(spark, "/root/testdata/sf0.001", session.run_folder(spark))
    jobs.run_batches(arriving, look, f"{session.run_folder(spark)}/cp")
    sent = spark.read.parquet("/root/testdata/sf0.001/events.parquet").groupBy(F.expr("event_id % 3")).count()
    n = {r[0]: r[1] for r in sent.collect()}
    assert [rows for rows, _ in seen] == [n[0], n[1], n[2], n[1]]
    assert min(files for _, files in seen) > 1


def test_gap_alarms_store_a_batch_as_times_only(spark, monkeypatch):
    from checks.compare import compare, database

    seen, real = [], jobs.gap_arrivals

    def spied(*args):
        handle = real(*args)

        def both(batch, number):
            seen.append(batch.columns)
            handle(batch, number)

        return both

    monkeypatch.setattr(jobs, "gap_arrivals", spied)
    sf = "/root/testdata/sf0.001"
    assert compare(spark, database(sf), sf, "stream_gap_alarm").startswith("OK")
    assert seen == [["station_id", "ts"]] * 4
