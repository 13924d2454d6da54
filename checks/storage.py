"""Registered queries that go through files: readers, keyed sinks, snapshots, long histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import oracle as o
from checks import tables as t
from checks.queries import OUTSIDE, RANGE, RAW, SERIES, STAGED, STD, _raw, _samples, register, rounded
from meteospark import session
from meteospark.catalog import CSV_COLUMNS, FEATURES, SCHEMES, rename_features
from meteospark.functions import times
from meteospark.operators import frames, profiling, resample, staging
from meteospark.plans import flow
from meteospark.sources import files, sinks

STAGED_SELECT = f"SELECT station_id, ts, {o.rounded(STD)} FROM staged"


@register(o.query([*o.tel(), RAW, STAGED], STAGED_SELECT))
def csv_roundtrip(spark, sf):
    """Monthly CSV export with its header names, read back, staged."""
    folder = session.run_folder(spark)
    headers = {v: k for k, v in CSV_COLUMNS.items()}
    raw = _raw(spark, sf).drop("ts")
    named = [F.col(c).alias(headers.get(c, c)) for c in raw.columns if c != "event_id"]
    raw.select(*named, F.lit("x").alias("Firmware")).write.option("header", True).partitionBy("station_id").csv(
        f"{folder}/export"
    )
    csv = files.read_station_csv(spark, f"{folder}/export/*", CSV_COLUMNS)
    station = F.regexp_extract(F.input_file_name(), "station_id=([^/]+)", 1)
    return rounded(staging.stage(files.telemetry_from_csv(csv, station)))


@register(o.query([*o.tel(), RAW, STAGED], STAGED_SELECT.replace(o.r(STD[-1]), f"CASE WHEN station_id < 'e' THEN {o.r(STD[-1]).split(' AS ')[0]} END AS {STD[-1]}")))
def csv_mixed_headers(spark, sf):
    """Monthly files of which some lack a sensor and order their columns otherwise."""
    folder = session.run_folder(spark)
    headers = {v: k for k, v in CSV_COLUMNS.items()}
    raw = _raw(spark, sf).drop("ts")
    rain = SCHEMES["raw"]["rain"]
    columns = [c for c in raw.columns if c not in ("event_id", "station_id")]
    named = lambda names: [F.col(c).alias(headers.get(c, c)) for c in names]
    full, fewer = columns, [c for c in reversed(columns) if c != rain]
    fewer = sorted(fewer, key=lambda c: c not in ("epoch_timestamp", "ts_label"))
    full = sorted(full, key=lambda c: c not in ("epoch_timestamp", "ts_label"))
    for own, names in ((F.col("station_id") < "e", full), (F.col("station_id") >= "e", fewer)):
        part = raw.where(own).select("station_id", *named(names))
        part.write.mode("append").option("header", True).partitionBy("station_id").csv(f"{folder}/export")
    csv = files.read_station_csv(spark, f"{folder}/export/*", CSV_COLUMNS)
    station = F.regexp_extract("file", "station_id=([^/]+)", 1)
    return rounded(staging.stage(files.telemetry_from_csv(csv, station)))


@register(o.query([o.GRID], "SELECT strftime(valid_time, '%Y-%m-%d') AS day, count(*) AS n, count(t2m) AS n_t2m FROM grid GROUP BY 1"))
def grid_fallback(spark, sf):
    """A grid that lies at its second path, as CSV."""
    folder = session.run_folder(spark)
    t.grid(spark, sf).select(*[f.name for f in files.GRID_SCHEMA]).write.option("header", True).csv(f"{folder}/grid")
    grid = files.read_grid(spark, f"{folder}/missing", f"{folder}/grid", "csv")
    return grid.groupBy(F.date_format("valid_time", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("n"), F.count("t2m").alias("n_t2m")
    )


@register(o.query(o.hourly(), SERIES + "clean"))
def csv_checkpoint(spark, sf):
    """Hours written as CSV by month and read back."""
    path = f"{session.run_folder(spark)}/csv"
    hours = t.hourly(spark, sf)
    sinks.write_csv_months(hours, path)
    back = spark.read.schema(hours.schema).option("header", True).csv(f"{path}/*")
    return rounded(back)


@register(o.query([*o.features(), o.REFS], "SELECT station_id, strftime(ts_ref, '%Y-%m') AS month, count(*) AS n FROM refs GROUP BY 1, 2"))
def samples_store(spark, sf):
    """Samples written by month; a row holds its window, targets and reference time."""
    path = f"{session.run_folder(spark)}/samples"
    sinks.write_samples(_samples(spark, sf), path)
    back = spark.read.parquet(path).where((F.size("x") == 24) & (F.size("y") == 6))
    return back.groupBy("station_id", "month").agg(F.count("*").alias("n"))


@register(
    o.query(
        [o.GRID],
        "SELECT valid_time, latitude, longitude, "
        + o.rounded(["t2m", "sp"])
        + " FROM grid WHERE valid_time BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-19 12:00:00'",
    )
)
def range_scan(spark, sf):
    """Columns of a stored grid in a time range."""
    folder = session.run_folder(spark)
    grid = t.grid(spark, sf).withColumn("month", times.month_of(F.col("valid_time")))
    grid.write.partitionBy("month").parquet(f"{folder}/grid")
    columns = ["valid_time", "latitude", "longitude", "t2m", "sp"]
    bounds = ("2024-01-05 00:00:00", "2024-01-19 12:00:00")
    return rounded(files.read_range(spark, f"{folder}/grid", columns, *bounds, at="valid_time"))


@register(o.query([*o.tel(), RAW, STAGED], STAGED_SELECT))
def sink_append_new(spark, sf):
    """The same telemetry appended twice, the second time ignored; first write wins."""
    path = f"{session.run_folder(spark)}/telemetry"
    rows = rename_features(_raw(spark, sf), "raw", "standard").select("station_id", "ts", "epoch_timestamp", *STD)
    order = ["epoch_timestamp", *STD]
    for _ in range(2):
        sinks.append_new(spark, rows, path, ["station_id", "ts"], order)
    return rounded(spark.read.parquet(path).select("station_id", "ts", *STD))


@register(
    o.query(
        o.hourly("user_id"),
        f"SELECT station_id, ts, {o.r('CASE WHEN r.given THEN r.temp ELSE c.temp END', 'temp')}, "
        + ", ".join(o.r(f"c.{f}", f) for f in FEATURES[1:])
        + " FROM clean c LEFT JOIN (SELECT station_id, ts, temp, true AS given FROM res) r USING (station_id, ts)",
    )
)
def sink_upsert(spark, sf):
    """Stored hours updated in one column; the other columns keep their values."""
    path = f"{session.run_folder(spark)}/hours"
    sinks.upsert(spark, t.hourly(spark, sf, "user_id"), path, ["station_id", "ts"])
    fresh = resample.resample(resample.apply_offset(t.fleet(spark, sf))).select("station_id", "ts", "temp")
    sinks.upsert(spark, fresh, path, ["station_id", "ts"])
    return rounded(spark.read.parquet(path).select("station_id", "ts", *FEATURES))


@register(
    o.query(
        o.hourly("user_id"),
        SERIES + f"(SELECT * FROM clean WHERE {OUTSIDE} UNION ALL SELECT * FROM res WHERE NOT ({OUTSIDE}))",
    )
)
def sink_replace_range(spark, sf):
    path = f"{session.run_folder(spark)}/hours"
    sinks.upsert(spark, t.hourly(spark, sf, "user_id"), path, ["station_id", "ts"])
    fresh = resample.resample(resample.apply_offset(t.fleet(spark, sf)))
    sinks.replace_range(spark, fresh, path, *RANGE)
    return rounded(spark.read.parquet(path).drop("month"))


@register(o.query(o.hourly("user_id"), SERIES + f"clean WHERE {OUTSIDE}"))
def sink_delete_range(spark, sf):
    path = f"{session.run_folder(spark)}/hours"
    sinks.upsert(spark, t.hourly(spark, sf, "user_id"), path, ["station_id", "ts"])
    sinks.delete_range(spark, path, *RANGE)
    return rounded(spark.read.parquet(path).drop("month"))


@register(o.query(o.hourly("user_id"), SERIES + "clean"))
def snapshot_publish(spark, sf):
    """Two published snapshots; readers see the newer one."""
    root = f"{session.run_folder(spark)}/public"
    sinks.publish_snapshot(resample.resample(t.fleet(spark, sf)), root, "20240130T2300")
    sinks.publish_snapshot(t.hourly(spark, sf, "user_id"), root, "20240131T0000")
    return rounded(sinks.read_snapshot(spark, root))


# --- histories over many months -----------------------------------------------------------

LINES = """tel AS (SELECT l_suppkey::varchar AS station_id, l_shipdate AS ts, l_quantity AS temp,
  l_linenumber::double AS rh, floor(l_discount * 100 + 0.5) AS pres, CASE WHEN l_quantity > 10 THEN l_quantity END AS wind,
  CASE WHEN l_returnflag = 'R' THEN l_quantity END AS solar, CASE WHEN l_linenumber > 3 THEN l_quantity END AS rain FROM lineitem)"""
DAYS = "res AS (SELECT station_id, ts, " + ", ".join(
    f"{'max' if f == 'rain' else 'avg'}({f}) AS {f}" for f in FEATURES
) + " FROM tel GROUP BY 1, 2)"


def _daily(spark, sf):
    """Shipments per supplier as a daily series over seven years."""
    quantity = F.col("l_quantity")
    rows = t.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("station_id"),
        F.col("l_shipdate").alias("ts"),
        quantity.alias("temp"),
        F.col("l_linenumber").cast("double").alias("rh"),
        F.floor(F.col("l_discount") * 100 + 0.5).cast("double").alias("pres"),
        F.when(quantity > 10, quantity).alias("wind"),
        F.when(F.col("l_returnflag") == "R", quantity).alias("solar"),
        F.when(F.col("l_linenumber") > 3, quantity).alias("rain"),
    )
    return resample.resample(rows, 1440)


def _days(sql: str) -> str:
    return sql.replace("INTERVAL 1 HOUR", "INTERVAL 1 DAY")


@register(
    o.query(
        [LINES, DAYS, _days(o.dense()), o.near(), o.interp(limit=5 * 86400)],
        SERIES + "interp",
    )
)
def long_history_interpolation(spark, sf):
    """Five-day interpolation over histories of eighty months, so neighbours cross many spans."""
    return rounded(resample.interpolate(_daily(spark, sf), max_hours=120, step_minutes=1440))


@register(
    o.query(
        [LINES, DAYS, _days(o.dense()), o.near(), o.interp(limit=None)],
        f"""SELECT station_id, ts, {', '.join(o.r(f'sum({f}) OVER p', f'past_{f}') for f in ('rh', 'temp'))},
  {o.r('temp_ahead - temp', 'delta_temp')}, {o.r('rh_ahead - rh', 'delta_rh')}
FROM (SELECT *, lead(temp, 10) OVER w AS temp_ahead, lead(rh, 10) OVER w AS rh_ahead, row_number() OVER w AS i,
        max(ts) OVER (PARTITION BY station_id) AS last_ts FROM interp
      WINDOW w AS (PARTITION BY station_id ORDER BY ts))
WINDOW p AS (PARTITION BY station_id ORDER BY ts ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
QUALIFY i >= 30 AND ts <= last_ts - INTERVAL 10 DAY""",
    )
)
def long_history_windows(spark, sf):
    """Windows of thirty days and targets ten days ahead: every window reaches another month."""
    rows = resample.interpolate(_daily(spark, sf), max_hours=None, step_minutes=1440)
    samples = frames.sample_totals(rows, 30, 10, 1440, ("rh", "temp"), ("rh", "temp"), block_days=320)
    return rounded(
        samples.select("station_id", F.col("ts_ref").alias("ts"), "past_rh", "past_temp", "delta_rh", "delta_temp")
    )


LATE_MONTH, SPLIT = "1995-03", "1997-01-01"
Z = "(CASE WHEN s{0} > 0 THEN s{0} ELSE 1 END)".format


@register(
    o.query(
        [
            LINES,
            DAYS,
            _days(o.dense()),
            o.near(),
            o.interp(limit=None),
            f"feat AS (SELECT station_id, ts, temp + (strftime(ts, '%Y-%m') = '{LATE_MONTH}')::int AS temp, rh FROM interp)",
            f"""smp AS (SELECT * FROM (SELECT *, lead(temp) OVER (PARTITION BY station_id ORDER BY ts) - temp AS y FROM feat)
  WHERE y IS NOT NULL AND ts + INTERVAL 1 DAY < TIMESTAMP '{SPLIT}')""",
            """scl AS (SELECT station_id, count(*) AS n, avg(temp) AS m1, avg(rh) AS m2, avg(y) AS m3, stddev_pop(temp) AS s1,
  stddev_pop(rh) AS s2, stddev_pop(y) AS s3 FROM smp GROUP BY 1)""",
            f"""std AS (SELECT station_id, (temp - m1) / {Z(1)} AS x1, (rh - m2) / {Z(2)} AS x2, (y - m3) / {Z(3)} AS d FROM smp JOIN scl USING (station_id))""",
            """sums AS (SELECT station_id, sum(x1 * x1) + 1 AS a, sum(x1 * x2) AS b, sum(x2 * x2) + 1 AS c, sum(x1 * d) AS e, sum(x2 * d) AS f FROM std GROUP BY 1)""",
        ],
        f"""SELECT station_id, n::double AS n_samples, {o.r('m1', 'mean_temp')}, {o.r('s3', 'scale_delta')},
  {o.r('(c * e - b * f) / (a * c - b * b)', 'w_temp')}, {o.r('(a * f - b * e) / (a * c - b * b)', 'w_rh')} FROM sums JOIN scl USING (station_id)""",
    )
)
def refit_late_month(spark, sf):
    """Models over eighty months, refitted after one of them has changed: that month's moments are replaced,
    the others are only added up."""
    folder = session.run_folder(spark)
    features, parts = f"{folder}/features", f"{folder}/moments"
    s = flow.Settings(as_of="1999-01-01", step_minutes=1440, lookback=1, horizon=1)
    small = {"inputs": ("temp", "rh"), "targets": ("temp",)}
    rows = resample.interpolate(_daily(spark, sf), max_hours=None, step_minutes=1440).select("station_id", "ts", "temp", "rh")
    sinks.upsert(spark, rows, features, ["station_id", "ts"], unique=True, gather=True)
    flow.all_moments(spark, features, parts, s, **small)
    late = sinks.read_table(spark, features, [LATE_MONTH]).select("station_id", "ts", (F.col("temp") + 1).alias("temp"))
    sinks.upsert(spark, late, features, ["station_id", "ts"])
    flow.update_moments(spark, features, parts, LATE_MONTH, s, **small)
    w = F.col("weights")
    return rounded(
        flow.refit(spark, parts, s, SPLIT, 2).select(
            "station_id", "n_samples", F.col("x_mean")[0].alias("mean_temp"), F.col("y_scale")[0].alias("scale_delta"), w[0].alias("w_temp"), w[1].alias("w_rh")
        )
    )


@register(
    o.query(
        [
            *o.tel("user_id"),
            """up AS (SELECT CASE WHEN event_id % 7 = 0 THEN NULL ELSE station_id END AS station_id,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE date_trunc('hour', ts) END AS ts, event_id AS run, temp, rh FROM tel)""",
        ],
        f"SELECT station_id, ts, run, {o.rounded(['temp', 'rh'])} FROM up QUALIFY row_number() OVER (PARTITION BY station_id, ts ORDER BY run DESC) = 1",
    )
)
def sink_upsert_repeated(spark, sf):
    """An update with repeated keys and keys without a station or time, applied three times: the last run of
    each key stays, once."""
    path = f"{session.run_folder(spark)}/hours"
    part = lambda c, n: F.when(F.col("event_id") % n != 0, c)
    rows = t.fleet(spark, sf).select(
        part(F.col("station_id"), 7).alias("station_id"), part(times.floor_hour(F.col("ts")), 11).alias("ts"), F.col("event_id").alias("run"), "temp", "rh"
    )
    for _ in range(3):
        sinks.upsert(spark, rows, path, ["station_id", "ts"], order=["run"])
    return rounded(sinks.read_table(spark, path).drop("month"))


@register(
    o.query(
        [],
        """SELECT *, last_ts = max(last_ts) OVER () AS is_latest FROM (SELECT 'events' AS table_name, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_rows FROM events
  UNION ALL SELECT 'orders', min(o_orderdate), max(o_orderdate), count(*) FROM orders
  UNION ALL SELECT 'lineitem', min(l_shipdate), max(l_shipdate), count(*) FROM lineitem)""",
    ).removeprefix("WITH \n")
)
def freshness_stored(spark, sf):
    """First and last times and row counts of stored tables: footers give the counts, two months the times."""
    folder = session.run_folder(spark)
    names = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}
    for name, at in names.items():
        rows = t.table(spark, sf, name).select(at, times.month_of(F.col(at)).alias("month"))
        rows.repartition("month").write.partitionBy("month").parquet(f"{folder}/{name}")
    return profiling.stored_freshness(spark, {name: (f"{folder}/{name}", at) for name, at in names.items()})


@register(
    o.query(
        o.hourly("user_id"),
        f"""SELECT station_id, ts, {o.r("CASE WHEN station_id IN (SELECT DISTINCT station_id FROM clean ORDER BY 1 LIMIT 10) THEN temp + 1 ELSE temp END", "temp")},
  {o.rounded(FEATURES[1:])} FROM clean""",
    )
)
def sink_buckets(spark, sf):
    """Hours by month and bucket of stations; an update of ten stations rewrites their buckets."""
    path = f"{session.run_folder(spark)}/hours"
    sinks.upsert(spark, t.hourly(spark, sf, "user_id"), path, ["station_id", "ts"], unique=True, buckets=16)
    few = sinks.read_table(spark, path).select("station_id").distinct().orderBy("station_id").limit(10)
    fresh = sinks.read_table(spark, path).join(few, "station_id").select("station_id", "ts", (F.col("temp") + 1).alias("temp"))
    sinks.upsert(spark, fresh, path, ["station_id", "ts"], buckets=16)
    return rounded(sinks.read_table(spark, path).select("station_id", "ts", *FEATURES))
