"""Registered queries: each runs a library operator over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import oracle as o
from checks import tables as t
from meteospark.catalog import (
    AUX_FEATURES,
    BIAS_RANGES,
    FEATURES,
    INPUT_FEATURES,
    SCHEMES,
    STAGING_RANGES,
    rename_features,
)
from meteospark.functions import cleaning, physics, times
from meteospark.operators import (
    evaluation,
    maintenance,
    matching,
    model,
    profiling,
    quality,
    resample,
    serving,
    staging,
    stations,
    windows,
)
from meteospark import session
from meteospark.plans import flow
from meteospark.sources import sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
ZONE = "Europe/Paris"
AS_OF = "2024-01-30 23:00:00"


def register(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Rounds floating columns, as the SQL counterpart does."""
    doubles = [c for c, kind in df.dtypes if kind == "double"]
    unit = 10.0**digits
    return df.withColumns({c: F.floor(F.col(c) * unit + 0.5) / unit for c in doubles}) if doubles else df


FEATS = o.rounded(FEATURES)
SERIES = f"SELECT station_id, ts, {FEATS} FROM "

# --- hourly series ------------------------------------------------------------------------


@register(o.query([*o.tel("user_id"), o.HOURLY], SERIES + "res"))
def hourly_resample(spark, sf):
    return rounded(resample.resample(resample.apply_offset(t.fleet(spark, sf))))


@register(o.query([*o.tel("user_id"), o.HOURLY, o.dense()], SERIES + "dense"))
def dense_grid(spark, sf):
    return rounded(resample.densify(resample.resample(resample.apply_offset(t.fleet(spark, sf)))))


@register(o.query([*o.tel("user_id"), o.HOURLY, o.dense(), o.near(), o.interp()], SERIES + "interp"))
def bounded_interpolation(spark, sf):
    hourly = resample.resample(resample.apply_offset(t.fleet(spark, sf)))
    return rounded(resample.interpolate(hourly, max_hours=2))


@register(
    o.query(
        [*o.tel("user_id"), o.HOURLY, o.dense(), o.near()],
        "SELECT station_id, ts, "
        + ", ".join(o.r(f"coalesce({o.line(f, None)}, {f}_n)", f) for f in FEATURES)
        + ", ("
        + " OR ".join(f"{f} IS NULL" for f in FEATURES)
        + ") AS filled FROM near",
    )
)
def linear_fill_edges(spark, sf):
    hourly = resample.resample(resample.apply_offset(t.fleet(spark, sf)))
    return rounded(resample.interpolate_all(hourly))


@register(
    o.query(
        [*o.tel("user_id"), o.HOURLY, o.dense(), o.near()],
        "SELECT station_id, ts, "
        + ", ".join(o.r(f"coalesce({f}_p, {f}_n)", f) for f in FEATURES)
        + " FROM near",
    )
)
def forward_backward_fill(spark, sf):
    return rounded(resample.fill_edges(resample.resample(resample.apply_offset(t.fleet(spark, sf)))))


@register(o.query(o.hourly("user_id"), SERIES + "clean"))
def clean_hourly(spark, sf):
    return rounded(resample.clean_hourly(t.fleet(spark, sf)))


@register(o.query(o.hourly(), SERIES + "clean"))
def clean_hourly_busy(spark, sf):
    return rounded(t.hourly(spark, sf))


# --- staging ------------------------------------------------------------------------------

MINUTES = "minutes AS (SELECT DISTINCT station_id, date_trunc('minute', ts) AS ts FROM tel)"
GAPS = """gaps AS (
  SELECT station_id, prev + INTERVAL 1 MINUTE AS gap_start, ts - INTERVAL 1 MINUTE AS gap_end,
         round_even(epoch(ts - prev) / 60 - 1, 0)::int AS missing_min
  FROM (SELECT *, lag(ts) OVER (PARTITION BY station_id ORDER BY ts) AS prev FROM minutes)
  WHERE epoch(ts - prev) / 60 > 1.5)"""


def _minutes(spark, sf):
    return t.telemetry(spark, sf).withColumn("ts", times.floor_minute(F.col("ts")))


@register(o.query([*o.tel(), MINUTES, GAPS], "SELECT * FROM gaps"))
def gap_report(spark, sf):
    return staging.gaps(_minutes(spark, sf))


@register(
    o.query(
        [*o.tel(), MINUTES, GAPS],
        f"""SELECT station_id, first_ts, last_ts, coalesce(missing, 0) AS missing, coalesce(n_gaps, 0) AS n_gaps,
  coalesce(n_reported, 0) AS n_reported, coalesce(longest, 0) AS longest, expected,
  {o.r('coalesce(missing, 0) / expected', 'missing_ratio')},
  coalesce(missing, 0) / expected > 0.02 OR coalesce(longest, 0) > 180 AS is_breach
FROM (SELECT station_id, min(ts) AS first_ts, max(ts) AS last_ts,
        (epoch(max(ts) - min(ts)) / 60)::bigint + 1 AS expected FROM minutes GROUP BY 1)
LEFT JOIN (SELECT station_id, sum(missing_min)::bigint AS missing, count(*) AS n_gaps,
        count(*) FILTER (missing_min >= 2) AS n_reported, max(missing_min) AS longest FROM gaps GROUP BY 1) USING (station_id)""",
    )
)
def gap_summary(spark, sf):
    return rounded(staging.gap_summary(_minutes(spark, sf)))


def _raw(spark, sf):
    epoch = times.seconds_between(F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    rows = rename_features(t.telemetry(spark, sf), "feature", "raw")
    return staging.with_utc_minutes(rows.withColumn("epoch_timestamp", epoch))


RAW = (
    "raw AS (SELECT station_id, date_trunc('minute', ts) AS ts, floor(epoch(ts))::bigint AS epoch_timestamp, "
    + ", ".join(f"{f} AS {SCHEMES['standard'][f]}" for f in FEATURES)
    + " FROM tel)"
)
STD = [SCHEMES["standard"][f] for f in FEATURES]
STAGED = (
    f"staged AS (SELECT station_id, ts, {', '.join(STD)} FROM raw QUALIFY row_number() OVER (PARTITION BY station_id, ts "
    f"ORDER BY epoch_timestamp, {', '.join(c + ' NULLS FIRST' for c in STD)}) = 1)"
)


@register(o.query([*o.tel(), RAW, STAGED], f"SELECT station_id, ts, {o.rounded(STD)} FROM staged"))
def dedup_staging(spark, sf):
    return rounded(staging.stage(_raw(spark, sf)))


@register(
    o.query(
        [*o.tel(), RAW, STAGED, "old AS (SELECT * FROM staged WHERE ts < TIMESTAMP '2024-01-16')"],
        f"""SELECT station_id, ts, epoch_timestamp, {o.rounded(STD)} FROM raw r
WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.station_id = r.station_id AND old.ts = r.ts)
QUALIFY row_number() OVER (PARTITION BY station_id, ts
  ORDER BY epoch_timestamp, {', '.join(c + ' NULLS FIRST' for c in STD)}) = 1""",
    )
)
def insert_or_ignore(spark, sf):
    new = rename_features(_raw(spark, sf), "raw", "standard").select("station_id", "ts", "epoch_timestamp", *STD)
    known = staging.stage(_raw(spark, sf)).where(F.col("ts") < times.instant("2024-01-16"))
    return rounded(staging.insert_or_ignore(known, new, ["station_id", "ts"], ["epoch_timestamp", *STD]))


@register(
    o.query(
        o.tel(),
        """SELECT station_id, count(*) AS n_rows, count(*) FILTER (label <> local) AS n_mismatch
FROM (SELECT station_id, date_trunc('minute', ts) + INTERVAL 1 HOUR AS local,
        date_trunc('minute', ts) + CASE WHEN rh < 50 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS label FROM tel)
GROUP BY 1""",
    )
)
def epoch_label_check(spark, sf):
    epoch = times.seconds_between(F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    minute = times.floor_minute(F.col("ts"))
    label = F.when(F.col("rh") < 50, minute + times.minutes(60)).otherwise(minute)
    rows = t.telemetry(spark, sf).withColumn("epoch_timestamp", epoch).withColumn("ts_label", label)
    return staging.label_check(rows, ZONE)


@register(
    """SELECT event_id, try_cast(reading AS double) AS number,
  try_cast(nullif(trim(reading), '') AS double) AS cleaned, trim(reading) = '' AS is_blank
FROM (SELECT event_id, CASE WHEN k < 10 THEN '  ' WHEN k < 20 THEN 'n/a' ELSE ' ' || k::varchar || '.5 ' END AS reading
  FROM (SELECT event_id, regexp_extract(props, '([0-9]+)', 1)::int AS k FROM events))"""
)
def coercing_cast(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    reading = (
        F.when(k < 10, "  ").when(k < 20, "n/a").otherwise(F.concat(F.lit(" "), k.cast("string"), F.lit(".5 ")))
    )
    rows = t.table(spark, sf, "events").select("event_id", reading.alias("reading"))
    return rows.select(
        "event_id",
        cleaning.to_number("reading").alias("number"),
        cleaning.blank_to_number("reading").alias("cleaned"),
        (F.trim("reading") == "").alias("is_blank"),
    )


# --- physics ------------------------------------------------------------------------------


@register(
    o.query(
        [o.GRID, o.ERA5],
        "SELECT valid_time, latitude, longitude, " + o.rounded([f"{f}_era5" for f in FEATURES]) + " FROM era5",
    )
)
def unit_conversion(spark, sf):
    return rounded(matching.convert_grid(t.grid(spark, sf)))


@register(
    o.query(
        o.tel(),
        f"SELECT event_id, {o.r(o.RH('temp', 'temp - (100 - rh) / 5'), 'rh_magnus')} FROM tel",
    )
)
def relative_humidity(spark, sf):
    dew = F.col("temp") - (100 - F.col("rh")) / 5
    rows = t.telemetry(spark, sf)
    return rounded(rows.select("event_id", physics.relative_humidity(F.col("temp"), dew).alias("rh_magnus")))


@register(
    o.query(
        [*o.tel("user_id"), o.STATIONS],
        f"""SELECT event_id, {o.r(o.sky('ts', 'latitude', 'longitude'), 'clear_sky')},
  {o.r(o.sky('ts', 'latitude', 'longitude', 'rh'), 'theo_solar')} FROM tel JOIN stations USING (station_id)""",
    )
)
def solar_theoretical(spark, sf):
    rows = t.fleet(spark, sf).join(t.stations(spark, sf), "station_id")
    sky = lambda rh=None: physics.clear_sky_radiation(F.col("ts"), F.col("latitude"), F.col("longitude"), rh)
    return rounded(rows.select("event_id", sky().alias("clear_sky"), sky(F.col("rh")).alias("theo_solar")))


@register(
    "SELECT event_id, "
    + o.rounded(AUX_FEATURES[:4])
    + f" FROM (SELECT event_id, {o.cyclic('ts')} FROM events)"
)
def cyclic_time(spark, sf):
    rows = t.table(spark, sf, "events")
    return rounded(rows.select("event_id", *[c.alias(n) for n, c in times.cyclic(F.col("ts")).items()]))


@register(
    o.query(o.tel(), "SELECT event_id, " + ", ".join(o.r(o.guard(f, f), f) for f in FEATURES) + " FROM tel")
)
def guardrail_feature(spark, sf):
    rows = t.telemetry(spark, sf)
    return rounded(rows.select("event_id", *[physics.guard_feature(f, F.col(f)).alias(f) for f in FEATURES]))


def _guard_batch_sql(f: str) -> str:
    x = f"({f} * 1.3 - 20)"
    if f in ("wind", "solar", "rain"):
        x = f"CASE WHEN {x} IS NOT NULL THEN greatest({x}, 0) END"
    elif f == "rh":
        x = f"CASE WHEN {x} IS NOT NULL THEN least(greatest({x}, 0), 100) END"
    if f == "solar":
        x = f"CASE WHEN sky <= 0 THEN CASE WHEN solar IS NOT NULL THEN 0 END WHEN solar IS NOT NULL THEN least({x}, sky) END"
    if f in ("wind", "solar", "rain"):
        x = f"CASE WHEN ({x}) < {o.RES[f]}::double / 2 THEN 0 ELSE ({x}) END"
    return f"round_even(({x}) * 10, 0) / 10" if f in ("temp", "rh", "pres") else o.quantise(x, o.RES[f])


@register(
    o.query(
        [
            *o.tel("user_id"),
            o.STATIONS,
            f"lit AS (SELECT *, {o.sky('ts', 'latitude', 'longitude')} AS sky FROM tel JOIN stations USING (station_id))",
        ],
        "SELECT event_id, " + ", ".join(o.r(_guard_batch_sql(f), f) for f in FEATURES) + " FROM lit",
    )
)
def guardrail_batch(spark, sf):
    rows = t.fleet(spark, sf).join(t.stations(spark, sf), "station_id")
    sky = physics.clear_sky_radiation(F.col("ts"), F.col("latitude"), F.col("longitude"))
    rows = rows.withColumns({"sky": sky, **{f: F.col(f) * 1.3 - 20 for f in FEATURES}})
    preds = physics.guard_forecast({f: F.col(f) for f in FEATURES}, F.col("sky"))
    return rounded(rows.select("event_id", *[preds[f].alias(f) for f in FEATURES]))


# --- grid and matching --------------------------------------------------------------------


@register(
    o.query(
        [o.GRID, o.STATIONS, o.cells("stations")],
        "SELECT station_id, latitude, longitude, cell_latitude, cell_longitude FROM cells",
    )
)
def nearest_grid(spark, sf):
    return matching.nearest_cells(t.stations(spark, sf), t.grid(spark, sf)).select(
        "station_id", "latitude", "longitude", "cell_latitude", "cell_longitude"
    )


GRID_VARS = ["t2m", "d2m", "sp", "u10", "v10", "ssrd", "tp"]


@register(
    o.query(
        [o.GRID],
        "\nUNION ALL ".join(
            f"""SELECT '{v}' AS variable, count(*) AS n, count(*) FILTER ({v} IS NULL) AS n_null,
  {o.r(f'min({v})', 'min_value')}, {o.r(f'max({v})', 'max_value')}, {o.r(f'avg({v})', 'mean_value')},
  count(DISTINCT valid_time) AS n_times, count(DISTINCT latitude) AS n_lat, count(DISTINCT longitude) AS n_lon,
  min(latitude) AS lat_min, max(latitude) AS lat_max, min(longitude) AS lon_min, max(longitude) AS lon_max,
  max(valid_time) AS last_time, floor(epoch(TIMESTAMP '2024-02-05 00:00:00' - max(valid_time)) / 86400)::bigint AS latency_days
FROM grid"""
            for v in GRID_VARS
        ),
    )
)
def grid_profile(spark, sf):
    return rounded(matching.grid_profile(t.grid(spark, sf), GRID_VARS, "2024-02-05 00:00:00"))


@register(
    o.query(
        [o.GRID],
        """SELECT valid_time, latitude, longitude, """
        + o.rounded(GRID_VARS)
        + """ FROM (SELECT valid_time, latitude, longitude, coalesce(a.t2m, b.t2m + 1) AS t2m, a.d2m, a.sp, b.u10, b.v10, b.ssrd, b.tp
FROM (SELECT * FROM grid WHERE ssrd < 2000000) a FULL JOIN (SELECT * FROM grid WHERE v10 < 1) b USING (valid_time, latitude, longitude))""",
    )
)
def grid_merge(spark, sf):
    g = t.grid(spark, sf)
    key = ("valid_time", "latitude", "longitude")
    instant = g.where("ssrd < 2000000").select(*key, "t2m", "d2m", "sp")
    accumulated = g.where("v10 < 1").select(*key, (F.col("t2m") + 1).alias("t2m"), "u10", "v10", "ssrd", "tp")
    return rounded(matching.merge_grids([instant, accumulated]).select(*key, *GRID_VARS))


@register(
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, max(o_orderdate) AS last_time,
  day(max(o_orderdate)) = day(last_day(max(o_orderdate))) AS is_final FROM orders GROUP BY 1"""
)
def period_completeness(spark, sf):
    return matching.period_completeness(t.table(spark, sf, "orders").withColumnRenamed("o_orderdate", "valid_time"))


MATCH_COLS = [f"{f}_era5" for f in FEATURES] + [f"{f}_eco" for f in FEATURES]


@register(o.query(o.matches("user_id"), f"SELECT station_id, ts, {o.rounded(MATCH_COLS)} FROM matches"))
def match_reanalysis(spark, sf):
    return rounded(t.matches(spark, sf, "user_id"))


@register(
    o.query(
        o.matches("user_id"),
        "SELECT station_id, ts, "
        + ", ".join(
            o.r(e, n)
            for f in FEATURES
            for e, n in ((f"{f}_eco",) * 2, (f"{f}_era5",) * 2, (f"{f}_eco - {f}_era5", f"bias_{f}"))
        )
        + " FROM matches",
    )
)
def match_view(spark, sf):
    return rounded(matching.match_view(t.matches(spark, sf, "user_id")))


@register(
    o.query(
        [*o.matches("user_id"), o.BIAS],
        f"SELECT station_id, ts, {o.rounded(o.BIAS_COLS)}, bias_overflow_flag FROM bias",
    )
)
def bias_table(spark, sf):
    return rounded(matching.bias_table(t.matches(spark, sf, "user_id")))


@register(
    o.query(
        [*o.matches("user_id"), o.BIAS],
        "\nUNION ALL ".join(
            f"""SELECT station_id, strftime(ts, '%Y-%m') AS month, '{f}' AS feature, {o.r(f'avg(bias_{f})', 'mean_bias')},
  {o.r(f'stddev_samp(bias_{f})', 'std_bias')}, {o.r(f'min(bias_{f})', 'min_bias')}, {o.r(f'max(bias_{f})', 'max_bias')}
FROM bias GROUP BY 1, 2"""
            for f in FEATURES
        ),
    )
)
def bias_monthly(spark, sf):
    return rounded(matching.monthly_bias(matching.bias_table(t.matches(spark, sf, "user_id"))))


@register(
    o.query(
        o.matches("user_id"),
        "SELECT station_id, count(*) AS n_matched, "
        + ", ".join(o.r(f"avg({f}_eco - {f}_era5)", f"mean_bias_{f}") for f in FEATURES)
        + " FROM matches WHERE temp_era5 IS NOT NULL GROUP BY 1",
    )
)
def bias_mean_report(spark, sf):
    return rounded(matching.mean_bias(t.matches(spark, sf, "user_id")))


# --- the pipeline -------------------------------------------------------------------------


@register(
    o.query(
        o.public(),
        f"SELECT station_id, ts, created_at, model_version, {', '.join(o.r(c) for c in o.PUBLIC)} FROM public",
    )
)
def pipeline_public(spark, sf):
    """From telemetry and grid to the public table by the flow's own steps."""
    folder, s = session.run_folder(spark), flow.Settings(as_of="2024-02-29 00:00:00")
    grid = sinks.materialise(t.grid(spark, sf), folder, "grid")
    cells = sinks.materialise(matching.grid_cells(grid), folder, "grid_cells")
    ready = flow.prepare(t.telemetry(spark, sf), grid, t.busy_stations(spark, sf), s, folder, cells)
    forecast = sinks.materialise(t.baselines(ready["hourly"]), folder, "forecast")
    marts = flow.evaluate(forecast, ready["hourly"], ready["matches"], ready["bias"], s)
    return rounded(marts["public"].select("station_id", "ts", "created_at", "model_version", *o.PUBLIC))


@register(
    o.query(
        [*o.tel(), o.HOURLY],
        """SELECT station_id, ts, ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01' AND ts <= TIMESTAMP '2024-01-20 05:00:00' AS in_month,
  ts >= TIMESTAMP '2024-01-31 00:00:00' AND ts < TIMESTAMP '2024-03-01 06:00:00' AS in_extended,
  ts >= TIMESTAMP '2024-01-06 12:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00' AS in_trailing,
  strftime(ts, '%Y-%m') AS month, (SELECT max(ts) FROM res r WHERE r.station_id = res.station_id) AS last_ts FROM res""",
    )
)
def time_filters(spark, sf):
    """Month up to a time, month with its surroundings, trailing days, month names, newest hour."""
    hours = resample.resample(resample.apply_offset(t.telemetry(spark, sf)))
    last = maintenance.last_staged(hours, AS_OF, ["station_id"])
    ts = F.col("ts")
    return hours.join(last, "station_id").select(
        "station_id",
        "ts",
        times.in_month(ts, "2024-01", as_of="2024-01-20 05:00:00").alias("in_month"),
        times.in_extended_month(ts, "2024-02", 24, 6).alias("in_extended"),
        times.trailing(ts, "2024-01-20 12:00:00", 14).alias("in_trailing"),
        cleaning.month_key(F.date_format(ts, "yyyy_MM_dd")).alias("month"),
        "last_ts",
    )


@register(
    """SELECT s_suppkey::varchar AS station_id, CASE WHEN s_suppkey % 3 = 0 THEN 'Local Home Weather Station' ELSE s_name END AS station_name,
  CASE WHEN s_suppkey % 2 = 0 THEN 0 ELSE s_acctbal END AS elevation_m, 14 AS min_training_days, 30 AS retrain_window_days,
  CASE WHEN s_suppkey % 4 = 0 THEN 0.5 ELSE 1 END::double AS rh_resolution, 0.1::double AS temp_resolution FROM supplier"""
)
def station_metadata(spark, sf):
    """Metadata with gaps filled; spec text is parsed, missing or broken text gives the nominal specs."""
    k = F.col("s_suppkey")
    specs = F.lit('{"ecowitt_rh": {"resolution": 0.5, "deadband": 0.0}}')
    rows = t.table(spark, sf, "supplier").select(
        k.cast("string").alias("station_id"),
        F.when(k % 3 != 0, F.col("s_name")).alias("station_name"),
        F.when(k % 2 != 0, F.col("s_acctbal")).alias("elevation_m"),
        F.lit(None).cast("int").alias("min_training_days"),
        F.lit(None).cast("int").alias("retrain_window_days"),
        F.when(k % 4 == 0, specs).when(k % 4 == 1, "no json").alias("sensor_specs"),
    )
    return stations.with_defaults(rows).select(
        "station_id",
        "station_name",
        "elevation_m",
        "min_training_days",
        "retrain_window_days",
        stations.resolution_of("rh").alias("rh_resolution"),
        stations.resolution_of("temp").alias("temp_resolution"),
    )


# --- profiling ----------------------------------------------------------------------------

LONG = (
    "long AS ("
    + " UNION ALL ".join(f"SELECT station_id, '{f}' AS feature, {f} AS value FROM tel" for f in FEATURES)
    + ")"
)
RESOLUTION = [
    LONG,
    "sizes AS (SELECT station_id, feature, count(value) AS n_values, count(DISTINCT value) AS n_distinct FROM long GROUP BY ALL)",
    """steps AS (SELECT station_id, feature, round(value - lag(value) OVER (PARTITION BY station_id, feature ORDER BY value), 4) AS step
  FROM (SELECT DISTINCT station_id, feature, value FROM long WHERE value IS NOT NULL))""",
    """modes AS (SELECT station_id, feature, step FROM (SELECT station_id, feature, step, count(*) AS n FROM steps WHERE step > 0 GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY station_id, feature ORDER BY n DESC, step) = 1)""",
    """resolution AS (SELECT station_id, feature, n_values, n_distinct,
  CASE WHEN n_values >= 50 AND n_distinct >= 2 THEN step END AS resolution FROM sizes LEFT JOIN modes USING (station_id, feature))""",
]


@register(
    o.query(
        [*o.tel(), *RESOLUTION],
        f"SELECT station_id, feature, n_values, n_distinct, {o.r('resolution')} FROM resolution",
    )
)
def sensor_resolution(spark, sf):
    return rounded(profiling.sensor_resolution(t.telemetry(spark, sf)))


DEADBAND = """deadband AS (SELECT station_id, quantile_cont(wind, 0.1) FILTER (wind > 0) AS wind_deadband,
  min(rain) FILTER (rain > 0) AS rain_deadband FROM tel GROUP BY 1)"""


@register(
    o.query([*o.tel(), DEADBAND], f"SELECT station_id, {o.rounded(['wind_deadband', 'rain_deadband'])} FROM deadband")
)
def sensor_deadband(spark, sf):
    return rounded(profiling.sensor_deadband(t.telemetry(spark, sf)))


STATUS = """CASE WHEN resolution IS NULL THEN '{0}' WHEN abs(resolution - expected) <= 1e-4 + 1e-5 * abs(expected) THEN '{1}'
  WHEN resolution < expected THEN '{2}' ELSE '{3}' END"""


@register(
    o.query(
        [*o.tel(), *RESOLUTION],
        f"""SELECT station_id, feature, n_values, n_distinct, {o.r('resolution')}, expected,
  {STATUS.format('WARNING', 'OK', 'ANOMALY', 'ANOMALY')} AS status,
  {STATUS.format('insufficient variation', 'nominal', 'finer than expected', 'coarser than expected')} AS diagnosis
FROM (SELECT *, CASE feature WHEN 'rh' THEN 1 ELSE 0.1 END::double AS expected FROM resolution)""",
    )
)
def resolution_status(spark, sf):
    return rounded(profiling.resolution_status(profiling.sensor_resolution(t.telemetry(spark, sf))))


@register(
    o.query(
        [
            *o.tel(),
            *RESOLUTION,
            DEADBAND,
            "nominal AS (SELECT unnest(['temp', 'rh', 'pres', 'wind', 'solar', 'rain']) AS feature, "
            "unnest([0.1, 1.0, 0.1, 0.1, 0.1, 0.1])::double AS res, unnest([0.0, 0.0, 0.0, 0.2, 0.0, 0.2])::double AS dead)",
        ],
        f"""SELECT station_id, 'ecowitt_' || feature AS sensor, {o.r('coalesce(resolution, res)', 'resolution')},
  {o.r("coalesce(CASE feature WHEN 'wind' THEN wind_deadband WHEN 'rain' THEN rain_deadband END, dead)", 'deadband')}
FROM resolution JOIN nominal USING (feature) LEFT JOIN deadband USING (station_id)""",
    )
)
def sensor_specs_json(spark, sf):
    tel = t.telemetry(spark, sf)
    specs = profiling.profiled_specs(profiling.sensor_resolution(tel), profiling.sensor_deadband(tel))
    parsed = specs.select("station_id", cleaning.parse_specs(F.col("specs_json")).alias("m"))
    return rounded(
        parsed.select("station_id", F.explode("m").alias("sensor", "s")).select(
            "station_id", "sensor", "s.resolution", "s.deadband"
        )
    )


@register(
    o.query(
        o.hourly("user_id"),
        "SELECT station_id, count(*) AS n_rows, "
        + o.each("count(*) FILTER (# IS NULL) AS null_#")
        + " FROM clean GROUP BY 1",
    )
)
def null_audit(spark, sf):
    return profiling.null_counts(t.hourly(spark, sf, "user_id"), FEATURES, ["station_id"])


# --- samples ------------------------------------------------------------------------------


def _features(spark, sf):
    """Feature rows as a table: windows, scalers and cuts all read them."""
    rows = flow.training_rows(t.hourly_table(spark, sf), t.busy_stations(spark, sf))
    return sinks.materialise(rows, session.run_folder(spark), "features")


def _samples(spark, sf):
    return windows.sample_windows(_features(spark, sf), keep=("latitude", "longitude"))


@register(
    o.query(o.features(), f"SELECT station_id, ts, {o.rounded(INPUT_FEATURES)}, filled FROM feat")
)
def feature_rows(spark, sf):
    return rounded(_features(spark, sf).drop("latitude", "longitude"))


@register(
    o.query(
        [*o.features(), o.REFS],
        f"""SELECT station_id, ts_ref, 24 - (epoch(ts_ref - ts) / 3600)::int AS step, {o.rounded(INPUT_FEATURES)}
FROM refs JOIN feat USING (station_id) WHERE ts BETWEEN ts_ref - INTERVAL 23 HOUR AND ts_ref""",
    )
)
def sample_windows(spark, sf):
    rows = _samples(spark, sf).select("station_id", "ts_ref", F.posexplode("x").alias("step", "v"))
    return rounded(
        rows.select(
            "station_id",
            "ts_ref",
            (F.col("step") + 1).alias("step"),
            *[F.col("v")[j].alias(f) for j, f in enumerate(INPUT_FEATURES)],
        )
    )


DELTAS = f"""deltas AS (SELECT station_id, ts_ref, (epoch(n.ts - ts_ref) / 3600)::int AS horizon, {o.each('n.# - b.# AS #')}
  FROM refs JOIN feat b USING (station_id) JOIN feat n USING (station_id)
  WHERE b.ts = ts_ref AND n.ts > ts_ref AND n.ts <= ts_ref + INTERVAL 6 HOUR)"""


@register(
    o.query([*o.features(), o.REFS, DELTAS], f"SELECT station_id, ts_ref, horizon, {o.rounded(FEATURES)} FROM deltas")
)
def delta_targets(spark, sf):
    rows = _samples(spark, sf).select("station_id", "ts_ref", F.posexplode("y").alias("h", "v"))
    return rounded(
        rows.select(
            "station_id",
            "ts_ref",
            (F.col("h") + 1).alias("horizon"),
            *[F.col("v")[j].alias(f) for j, f in enumerate(FEATURES)],
        )
    )


SPLIT = """split AS (SELECT station_id, count(*) AS n_samples, floor(count(*) * 0.8::double)::bigint AS n_train,
  min(ts_ref) + INTERVAL 1 HOUR * (floor(count(*) * 0.8::double)::bigint - 1) AS cut_ts FROM refs GROUP BY 1)"""


@register(o.query([*o.features(), o.REFS, SPLIT], "SELECT * FROM split"))
def chrono_split(spark, sf):
    return windows.split_point(_samples(spark, sf))


def _scale_sql(f: str, where: str) -> str:
    return f"""SELECT station_id, '{f}' AS feature, count(*)::double AS n, {o.r(f'avg({f})', 'mean')},
  {o.r(f'CASE WHEN stddev_pop({f}) > 0 THEN stddev_pop({f}) ELSE 1 END', 'scale')} FROM {where} GROUP BY 1"""


STEPS = """covered AS (SELECT f.* FROM refs JOIN split USING (station_id) JOIN feat f USING (station_id)
  WHERE ts_ref <= cut_ts AND ts BETWEEN ts_ref - INTERVAL 23 HOUR AND ts_ref)"""


@register(
    o.query(
        [*o.features(), o.REFS, SPLIT, STEPS],
        "\nUNION ALL ".join(_scale_sql(f, "covered") for f in INPUT_FEATURES),
    )
)
def scaler_stats(spark, sf):
    rows = _features(spark, sf)
    cut = windows.split_point(windows.sample_windows(rows)).select("station_id", "cut_ts")
    return rounded(windows.scaler_stats(rows, until=cut))


@register(
    o.query(
        [*o.features(), o.REFS, SPLIT, STEPS],
        f"""SELECT station_id, ts, {o.r('(temp - m1) / CASE WHEN s1 > 0 THEN s1 ELSE 1 END', 'scaled_temp')},
  {o.r('(rh - m2) / CASE WHEN s2 > 0 THEN s2 ELSE 1 END', 'scaled_rh')}, {o.r('temp')} FROM feat JOIN (
  SELECT station_id, avg(temp) AS m1, stddev_pop(temp) AS s1, avg(rh) AS m2, stddev_pop(rh) AS s2 FROM covered GROUP BY 1) USING (station_id)""",
    )
)
def scale_transform(spark, sf):
    """Inputs scaled by the stored statistics, and scaled back."""
    rows, names = _features(spark, sf), ("temp", "rh")
    cut = windows.split_of_rows(rows, 24, 6).select("station_id", "cut_ts")
    stats = windows.stats_arrays(windows.scaler_stats(rows, inputs=names, until=cut), names, "x")
    mean, scale = F.col("x_mean"), F.col("x_scale")
    scaled = rows.join(stats, "station_id").withColumn("v", windows.scale_vector(F.array(*names), mean, scale))
    back = windows.unscale_vector(F.col("v"), mean, scale)
    return rounded(
        scaled.select("station_id", "ts", F.col("v")[0].alias("scaled_temp"), F.col("v")[1].alias("scaled_rh"), back[0].alias("temp"))
    )


@register(
    o.query([*o.features(), o.REFS, DELTAS], "\nUNION ALL ".join(_scale_sql(f, "deltas") for f in FEATURES))
)
def target_scaler_stats(spark, sf):
    return rounded(windows.target_stats(_samples(spark, sf)))


@register(
    o.query(
        [*o.features(), o.REFS],
        """SELECT station_id, strftime(ts_ref, '%Y-%m') AS month, count(*) AS n_samples, 24 AS x_steps_min, 24 AS x_steps_max,
  11 AS x_width_min, 11 AS x_width_max, 6 AS y_steps_min, 6 AS y_steps_max, 6 AS y_width_min, 6 AS y_width_max,
  0::bigint AS n_null_x, true AS is_valid FROM refs GROUP BY 1, 2""",
    )
)
def feature_contract(spark, sf):
    return windows.feature_contract(_samples(spark, sf))


# --- model --------------------------------------------------------------------------------


def _settings(**changes):
    return flow.Settings(as_of=AS_OF, **changes)


def _trained(spark, sf):
    hours, folder = t.hourly_table(spark, sf), session.run_folder(spark)
    return flow.train(hours, t.busy_stations(spark, sf), _settings(), folder)


@register()
def ridge_fit_metrics(spark, sf):
    return rounded(model.rmse(_trained(spark, sf)["scored"], ["is_train", "horizon", "feature"]), 3)


@register()
def ridge_forecast(spark, sf):
    """Forecasts from every origin, the newest ones included, by stored models."""
    fit, places, s = _trained(spark, sf), t.busy_stations(spark, sf), _settings()
    observed = flow.observed_hours(t.telemetry(spark, sf), places, s)
    return rounded(flow.predict(observed, places, fit["models"], fit["registry"], s, F.lit(True))["forecast"], 3)


BACKTEST = ("2024-01-20 00:00:00", "2024-01-29 00:00:00", 6)


@register()
def backtest_origins(spark, sf):
    places = t.busy_stations(spark, sf)
    return rounded(
        flow.backtest_forecasts(t.telemetry(spark, sf), places, *BACKTEST, _settings(), session.run_folder(spark)), 3
    )


# A system small enough for SQL: one hour of temperature and humidity predicts the next step of temperature.
SMALL = {"inputs": ("temp", "rh"), "targets": ("temp",)}


def _small_sql(rows: str, suffix: str = "") -> list[str]:
    """Samples, scalers, weights and scores of the small system over gap-free rows, in closed form."""
    z = "(CASE WHEN s{0} > 0 THEN s{0} ELSE 1 END)".format
    return [
        f"""smp{suffix} AS (SELECT *, ts <= min(ts) OVER s + INTERVAL 1 HOUR * (floor(count(*) OVER s * 0.8::double)::bigint - 1) AS is_train
  FROM (SELECT station_id, ts, temp, rh, lead(temp) OVER (PARTITION BY station_id ORDER BY ts) - temp AS y FROM {rows})
  WHERE y IS NOT NULL WINDOW s AS (PARTITION BY station_id))""",
        f"""scl{suffix} AS (SELECT station_id, count(*) AS n, avg(temp) AS m1, avg(rh) AS m2, avg(y) AS m3, stddev_pop(temp) AS s1,
  stddev_pop(rh) AS s2, stddev_pop(y) AS s3 FROM smp{suffix} WHERE is_train GROUP BY 1)""",
        f"""std{suffix} AS (SELECT station_id, ts, y, is_train, (temp - m1) / {z(1)} AS x1, (rh - m2) / {z(2)} AS x2, (y - m3) / {z(3)} AS d
  FROM smp{suffix} JOIN scl{suffix} USING (station_id))""",
        f"""sums{suffix} AS (SELECT station_id, sum(x1 * x1) + 1 AS a, sum(x1 * x2) AS b, sum(x2 * x2) + 1 AS c, sum(x1 * d) AS e,
  sum(x2 * d) AS f FROM std{suffix} WHERE is_train GROUP BY 1)""",
        f"""wgt{suffix} AS (SELECT station_id, (c * e - b * f) / (a * c - b * b) AS w1, (a * f - b * e) / (a * c - b * b) AS w2 FROM sums{suffix})""",
        f"""scr{suffix} AS (SELECT station_id, ts, is_train, y, (x1 * w1 + x2 * w2) * {z(3)} + m3 AS delta
  FROM std{suffix} JOIN wgt{suffix} USING (station_id) JOIN scl{suffix} USING (station_id))""",
    ]


def _small(spark, sf, hours=None):
    s = _settings(lookback=1, horizon=1)
    hours = t.hourly_table(spark, sf) if hours is None else hours
    return flow.train(hours, t.busy_stations(spark, sf), s, session.run_folder(spark), **SMALL)


@register(
    o.query(
        [*o.features(), *_small_sql("feat")],
        f"""SELECT station_id, n::double AS n_samples, {o.r('w1', 'w_temp')}, {o.r('w2', 'w_rh')}, 0::double AS intercept,
  {o.r('m1', 'mean_temp')}, {o.r('s2', 'scale_rh')}, {o.r('s3', 'scale_delta')} FROM wgt JOIN scl USING (station_id)""",
    )
)
def ridge_closed_form(spark, sf):
    w = F.col("weights")
    return rounded(
        _small(spark, sf)["models"].select(
            "station_id",
            "n_samples",
            w[0].alias("w_temp"),
            w[1].alias("w_rh"),
            w[2].alias("intercept"),
            F.col("x_mean")[0].alias("mean_temp"),
            F.col("x_scale")[1].alias("scale_rh"),
            F.col("y_scale")[0].alias("scale_delta"),
        )
    )


@register(
    o.query(
        [*o.features(), *_small_sql("feat")],
        f"""SELECT station_id, ts AS ts_ref, is_train, {o.r('y')}, {o.r('delta')}, {o.r('rmse')} FROM scr
JOIN (SELECT station_id, is_train, sqrt(avg((delta - y) * (delta - y))) AS rmse FROM scr GROUP BY 1, 2) USING (station_id, is_train)""",
    )
)
def ridge_scores(spark, sf):
    """Every sample with its predicted delta, and the root mean square error of its split."""
    scored = sinks.materialise(_small(spark, sf)["scored"], session.run_folder(spark), "scored")
    errors = model.rmse(scored, ["station_id", "is_train"]).drop("n")
    rows = scored.select("station_id", "ts_ref", "is_train", F.col("y")[0][0].alias("y"), F.col("delta")[0][0].alias("delta"))
    return rounded(rows.join(errors, ["station_id", "is_train"]))


VERSION = "'ridge_' || strftime({0}, '%Y_%m') || '_20240130_2300'"


@register(
    o.query(
        [*o.features(), *_small_sql("feat")],
        f"""SELECT station_id, {VERSION.format('last_ts')} AS model_version, TIMESTAMP '{AS_OF}' AS trained_at, last_ts,
  (SELECT count(*) FROM smp WHERE is_train AND smp.station_id = b.station_id) AS train_samples_count, {o.r('mse', 'metrics_mse')}, 1 AS is_active
FROM (SELECT station_id, max(ts) AS last_ts FROM feat GROUP BY 1) b
JOIN (SELECT station_id, avg((delta - y) * (delta - y)) AS mse FROM scr WHERE NOT is_train GROUP BY 1) USING (station_id)""",
    )
)
def registry_from_fit(spark, sf):
    return rounded(_small(spark, sf)["registry"])


OBSERVED = "obs AS (SELECT station_id, ts, temp, " + o.guard("rh", "rh") + " AS rh FROM res)"
KNOWN = """past AS (SELECT g.station_id, g.ts, last_value(temp IGNORE NULLS) OVER w AS temp, last_value(rh IGNORE NULLS) OVER w AS rh
  FROM (SELECT station_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM obs GROUP BY 1) g
  LEFT JOIN obs USING (station_id, ts) WINDOW w AS (PARTITION BY station_id ORDER BY ts ROWS UNBOUNDED PRECEDING))"""


def _small_forecast_sql(chosen: str, suffix: str = "") -> str:
    z = "(CASE WHEN s{0} > 0 THEN s{0} ELSE 1 END)".format
    return f"""SELECT station_id, ts AS created_at, ts + INTERVAL 1 HOUR AS ts,
  {o.r(f'temp + ((temp - m1) / {z(1)} * w1 + (rh - m2) / {z(2)} * w2) * {z(3)} + m3', 'pred_temp')}
FROM past JOIN wgt{suffix} USING (station_id) JOIN scl{suffix} USING (station_id) WHERE temp IS NOT NULL AND rh IS NOT NULL AND {chosen}"""


def _small_forecast(spark, sf, fit, origins=None, until=None):
    s = _settings(lookback=1, horizon=1)
    tel, places = t.telemetry(spark, sf), t.busy_stations(spark, sf)
    tel = tel if until is None else tel.where(F.col("ts") < times.instant(until))
    s.as_of = "2100-01-01 00:00:00"  # the SQL side takes all there is, or up to `until`
    rows = flow.known_rows(flow.observed_hours(tel, places, s), places, s)
    scored = model.infer(rows, fit["models"], fit["registry"], 1, origins=origins, **SMALL)
    usable, _ = model.split_rejects(scored)
    return rounded(
        usable.select(
            "station_id",
            F.col("ts_ref").alias("created_at"),
            F.timestamp_add("HOUR", F.lit(1), "ts_ref").alias("ts"),
            (F.col("last_actual")[0] + F.col("delta")[0][0]).alias("pred_temp"),
        )
    )


@register(
    o.query(
        [*o.features(), *_small_sql("feat"), OBSERVED, KNOWN],
        _small_forecast_sql("ts = (SELECT max(ts) FROM past p WHERE p.station_id = past.station_id)"),
    )
)
def forecast_latest(spark, sf):
    """The next hour of every station from its newest hour, by the stored model."""
    return _small_forecast(spark, sf, _small(spark, sf))


@register(
    o.query(
        [
            *o.tel(),
            f"tel_fit AS (SELECT * FROM tel WHERE ts < TIMESTAMP '{BACKTEST[0]}')",
            o.HOURLY.replace("res AS", "res_fit AS").replace("FROM tel", "FROM tel_fit"),
            o.dense("res_fit", "dense_fit"),
            o.near("dense_fit", "near_fit"),
            o.interp("near_fit", "interp_fit"),
            o.CLEAN.replace("clean AS", "clean_fit AS").replace("FROM interp", "FROM interp_fit"),
            o.near("clean_fit", "near2_fit"),
            "gap_fit AS (SELECT station_id, ts, " + ", ".join(f"coalesce({o.line(f, None)}, {f}_n) AS {f}" for f in ("temp", "rh")) + " FROM near2_fit)",
            *_small_sql("gap_fit", "_fit"),
            o.HOURLY,
            OBSERVED,
            KNOWN,
        ],
        _small_forecast_sql(
            f"ts >= TIMESTAMP '{BACKTEST[0]}' AND ts < TIMESTAMP '{BACKTEST[1]}' AND "
            f"(epoch(ts - TIMESTAMP '{BACKTEST[0]}') / 3600)::bigint % {BACKTEST[2]} = 0",
            "_fit",
        ),
    )
)
def backtest_small(spark, sf):
    """Origins every six hours by a model that saw only what lies before the first of them."""
    early = t.telemetry(spark, sf).where(F.col("ts") < times.instant(BACKTEST[0]))
    hours = sinks.materialise(resample.clean_hourly(early), session.run_folder(spark), "hourly")
    return _small_forecast(spark, sf, _small(spark, sf, hours), model.backtest_origins(*BACKTEST), BACKTEST[1])


EARLIER = "2024-01-25 12:30:00"
OFFSET = "CASE WHEN station_id < 'e' THEN 0.5 WHEN station_id >= 'p' THEN -3.0 END"
TEL_THEN = f"""tel AS (SELECT station_id, ts, event_id, temp + 1.5 + coalesce({OFFSET}, -1.5)::double AS temp, rh, pres, wind, solar, rain
  FROM all_tel WHERE ts <= TIMESTAMP '{EARLIER}')"""


@register(
    o.query(
        [*o.tel(name="all_tel"), TEL_THEN, *[c for c in o.features() if not c.startswith("tel AS")], *_small_sql("feat"), OBSERVED, KNOWN],
        _small_forecast_sql("ts = (SELECT max(ts) FROM past p WHERE p.station_id = past.station_id)"),
    )
)
def forecast_as_of(spark, sf):
    """Training and prediction as of an earlier time, with stations of different sensor offsets: rows that
    came later change nothing, and both sides use a station's own offset."""
    s, tel = flow.Settings(as_of=EARLIER, lookback=1, horizon=1), t.telemetry(spark, sf)
    places = t.busy_stations(spark, sf).withColumn("temp_offset", F.expr(OFFSET).cast("double"))
    known, offset = flow.as_known(tel, places, s)
    folder = session.run_folder(spark)
    fit = flow.train(sinks.materialise(resample.clean_hourly(known, offset), folder, "hourly"), places, s, folder, **SMALL)
    rows = flow.known_rows(flow.observed_hours(tel, places, s), places, s)
    return _next_hour(model.infer(rows, fit["models"], fit["registry"], 1, **SMALL))


def _next_hour(scored):
    usable, _ = model.split_rejects(scored)
    return rounded(
        usable.select(
            "station_id",
            F.col("ts_ref").alias("created_at"),
            F.timestamp_add("HOUR", F.lit(1), "ts_ref").alias("ts"),
            (F.col("last_actual")[0] + F.col("delta")[0][0]).alias("pred_temp"),
        )
    )


FRESH, STALE = "station_id < 'd'", "station_id >= 'd' AND station_id < 'q'"


@register(
    o.query(
        [
            *o.tel(name="all_tel"),
            f"tel AS (SELECT * FROM all_tel WHERE ts <= TIMESTAMP '{AS_OF}')",
            *[c for c in o.features() if not c.startswith("tel AS")],
            *_small_sql("feat"),
            OBSERVED,
            KNOWN,
            "run AS (" + _small_forecast_sql("ts = (SELECT max(ts) FROM past p WHERE p.station_id = past.station_id)") + ")",
            "newest AS (SELECT station_id, max(ts) AS last_ts FROM feat GROUP BY 1)",
        ],
        f"""SELECT r.station_id, r.created_at, r.ts, CASE WHEN r.{FRESH} THEN {o.r('p.temp', 'x').removesuffix(' AS x')} ELSE pred_temp END AS pred_temp,
  CASE WHEN r.{FRESH} THEN 'ridge_old' ELSE {VERSION.format('last_ts')} END AS model_version,
  CASE WHEN r.{FRESH} THEN 'too_recent' WHEN r.{STALE.replace('AND ', 'AND r.')} THEN 'newer_period' ELSE 'no_model' END AS reason
FROM run r JOIN past p ON p.station_id = r.station_id AND p.ts = r.created_at JOIN newest n ON n.station_id = r.station_id""",
    )
)
def retrain_and_publish(spark, sf):
    """A scheduled run: which stations are due, their fit, the registry, forecasts by the active models, and
    the snapshot that readers get. One station's model is too young, one is outdated, the others have none."""
    s, folder = _settings(lookback=1, horizon=1), session.run_folder(spark)
    places = t.busy_stations(spark, sf).withColumn("min_training_days", F.lit(7))
    at = lambda day: F.lit(day).cast("timestamp_ntz")
    held = places.where(f"{FRESH} OR ({STALE})").select(
        "station_id",
        F.lit("ridge_old").alias("model_version"),
        F.when(F.expr(FRESH), at("2024-01-28 00:00:00")).otherwise(at("2023-12-21 00:00:00")).alias("trained_at"),
        at("2023-12-20 00:00:00").alias("last_ts"),
        F.lit(10).cast("long").alias("train_samples_count"),
        F.lit(0.0).alias("metrics_mse"),
        F.lit(1).alias("is_active"),
    )
    flat = lambda *values: F.array(*[F.lit(float(v)) for v in values])
    still = held.select(  # no change is predicted
        "station_id", F.lit(10.0).alias("n_samples"), flat(0, 0, 0).alias("weights"), flat(0, 0).alias("x_mean"), flat(1, 1).alias("x_scale"),
        flat(0).alias("y_mean"), flat(1).alias("y_scale"), "model_version",
    )
    held, still = sinks.materialise(held, folder, "held"), sinks.materialise(still, folder, "still")
    done = flow.run_due(t.telemetry(spark, sf), places, held, still, s, folder, **SMALL)
    usable, _ = model.split_rejects(done["scored"])
    ahead = usable.select(
        "station_id",
        F.col("ts_ref").alias("created_at"),
        F.timestamp_add("HOUR", F.lit(1), "ts_ref").alias("ts"),
        (F.col("last_actual")[0] + F.col("delta")[0][0]).alias("pred_temp"),
        "model_version",
    )
    public = rounded(ahead.join(done["due"].select("station_id", "reason"), "station_id"))
    sinks.publish_snapshot(public.limit(0), f"{folder}/public", "20240130T2200")
    sinks.publish_snapshot(public, f"{folder}/public", "20240130T2300")
    return sinks.read_snapshot(spark, f"{folder}/public")


WEEK = "TIMESTAMP '1970-01-01' + INTERVAL 7 DAY * floor(epoch(ts) / 604800)::int"
WALK = [
    *o.tel(name="all_tel"),
    f"tel AS (SELECT * FROM all_tel WHERE ts < TIMESTAMP '{BACKTEST[1]}')",
    o.HOURLY,
    OBSERVED,
    KNOWN,
    "whole AS (SELECT station_id, ts, temp, rh FROM past WHERE temp IS NOT NULL AND rh IS NOT NULL)",
    f"""origin AS (SELECT *, {WEEK} AS block FROM whole WHERE ts >= TIMESTAMP '{BACKTEST[0]}'
  AND (epoch(ts - TIMESTAMP '{BACKTEST[0]}') / 3600)::bigint % {BACKTEST[2]} = 0)""",
    """smp_w AS (SELECT w.station_id || '@' || block AS station_id, ts, temp, rh, y, true AS is_train
  FROM (SELECT *, lead(temp) OVER (PARTITION BY station_id ORDER BY ts) - temp AS y FROM whole) w
  JOIN (SELECT DISTINCT station_id, block FROM origin) b ON w.station_id = b.station_id AND w.ts + INTERVAL 1 HOUR < b.block WHERE y IS NOT NULL)""",
    *_small_sql("", "_w")[1:],
    "here AS (SELECT station_id AS own, station_id || '@' || block AS station_id, ts, temp, rh FROM origin)",
]


@register(o.query(WALK, _small_forecast_sql("true", "_w").replace("SELECT station_id", "SELECT own AS station_id", 1).replace("FROM past", "FROM here")))
def backtest_walk(spark, sf):
    """Walk-forward: each week's origins by a model of all weeks before it, from one ordered sum of moments."""
    s, places = _settings(lookback=1, horizon=1), t.busy_stations(spark, sf)
    return _next_hour(flow.backtest(t.telemetry(spark, sf), places, *BACKTEST, s, session.run_folder(spark), 7, **SMALL))


FORECAST_COLS = "station_id, ts, model_version, created_at, ts_window_start, ts_window_stop, horizon"


@register(o.query(o.forecast(), f"SELECT {FORECAST_COLS}, {o.rounded(o.PRED)} FROM forecast"))
def baseline_forecasts(spark, sf):
    return rounded(_forecast(spark, sf))


def _forecast(spark, sf):
    return t.baselines(t.hourly_table(spark, sf))


REGISTRY = """registry AS (SELECT *, (row_number() OVER (PARTITION BY station_id ORDER BY trained_at DESC, model_version DESC) = 1)::int AS is_active
  FROM (SELECT o_custkey::varchar AS station_id, o_orderdate AS trained_at, o_orderdate - INTERVAL 40 DAY AS last_ts,
    'ridge_' || strftime(o_orderdate, '%Y_%m') || '_' || strftime(o_orderdate, '%Y%m%d_%H%M') || '_' || o_orderkey AS model_version FROM orders))"""


def _registry(spark, sf):
    at = F.col("trained_at")
    orders = t.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("station_id"),
        F.col("o_orderdate").alias("trained_at"),
        (F.col("o_orderdate") - F.expr("INTERVAL 40 DAYS")).alias("last_ts"),
        "o_orderkey",
    )
    name = model.version_name("ridge", F.date_format(at, "yyyy_MM"), at)
    rows = orders.withColumn("model_version", F.concat_ws("_", name, F.col("o_orderkey"))).drop("o_orderkey")
    cut = times.instant("1999-01-01")
    old = rows.where(at < cut).withColumn("is_active", F.lit(1))
    return model.register(old, rows.where(at >= cut))


@register(
    o.query([REGISTRY], "SELECT station_id, trained_at, last_ts, model_version, is_active FROM registry WHERE is_active = 1")
)
def registry_active(spark, sf):
    active = model.active_models(_registry(spark, sf))
    return active.select("station_id", "trained_at", "last_ts", "model_version", "is_active")


@register(
    o.query(
        [
            REGISTRY,
            """due AS (SELECT c_custkey::varchar AS station_id, 14 AS min_training_days, trained_at, last_ts, last_period,
  floor(epoch(TIMESTAMP '2001-08-05' - trained_at) / 86400)::bigint AS age_days
FROM customer LEFT JOIN (SELECT * FROM registry WHERE is_active = 1) g ON g.station_id = c_custkey::varchar
LEFT JOIN (SELECT o_custkey, strftime(max(o_orderdate), '%Y-%m') AS last_period FROM orders GROUP BY 1) ON o_custkey = c_custkey)""",
            """why AS (SELECT *, CASE WHEN trained_at IS NULL THEN 'no_model' WHEN age_days < min_training_days THEN 'too_recent'
  WHEN last_period > strftime(last_ts, '%Y-%m') THEN 'newer_period' ELSE 'up_to_date' END AS reason FROM due)""",
        ],
        "SELECT *, reason IN ('no_model', 'newer_period') AS is_due FROM why",
    )
)
def retrain_due(spark, sf):
    known = t.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("station_id"), F.lit(14).alias("min_training_days")
    )
    periods = (
        t.table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").cast("string").alias("station_id"))
        .agg(times.month_of(F.max("o_orderdate")).alias("last_period"))
    )
    return model.retrain_due(known, _registry(spark, sf), periods, "2001-08-05 00:00:00")


# --- evaluation ---------------------------------------------------------------------------


def _eval(spark, sf):
    """Hourly table, forecasts, matches and bias; matches are a table, as actual values and bias both read them."""
    hours = t.hourly_table(spark, sf)
    matches = sinks.materialise(t.matches(spark, sf, hours=hours), session.run_folder(spark), "matches")
    return hours, t.baselines(hours), matches, matching.bias_table(matches)


def _reconciled(spark, sf):
    _, forecast, matches, bias = _eval(spark, sf)
    return evaluation.reconcile(forecast, matches, bias)


def _mart(spark, sf, done=None, **limits):
    hours, forecast, _, bias = _eval(spark, sf)
    if done is not None:
        limits["high_water"] = evaluation.high_water(forecast.where(done))
    return evaluation.quality_mart(forecast, hours, bias, **limits)


@register(
    o.query(
        o.reconciled(),
        f"SELECT {FORECAST_COLS}, {o.rounded(o.RECONCILED_COLS)}, {o.r('drift_vs_bias_temp', 'drift_vs_bias')} FROM reconciled",
    )
)
def reconcile_forecast(spark, sf):
    return rounded(_reconciled(spark, sf))


@register(ORACLE["reconcile_forecast"])
def reconcile_late_bias(spark, sf):
    """Observations come first, reanalysis later: the second run mends what the first assumed."""
    _, forecast, matches, bias = _eval(spark, sf)
    late = F.col("ts") >= times.instant("2024-01-15")
    early = matches.withColumns({f"{f}_era5": F.when(~late, F.col(f"{f}_era5")) for f in FEATURES})
    first = evaluation.reconcile(forecast, early, matching.bias_table(early))
    return rounded(evaluation.reconcile(sinks.materialise(first, session.run_folder(spark), "first"), matches, bias))


MART = f"SELECT station_id, ts, model_version, created_at, {o.rounded(o.MART_COLS)} FROM mart"


@register(o.query(o.mart(), MART))
def quality_mart(spark, sf):
    return rounded(_mart(spark, sf))


@register(
    o.query(
        o.mart(
            "created_at <= TIMESTAMP '2024-01-25 12:00:00' AND created_at >= "
            "(SELECT max(ts) FROM forecast WHERE ts <= TIMESTAMP '2024-01-20') - INTERVAL 3 DAY"
        ),
        MART,
    )
)
def quality_mart_asof(spark, sf):
    done = F.col("ts") <= times.instant("2024-01-20")
    return rounded(_mart(spark, sf, done, as_of="2024-01-25 12:00:00"))


CONSENSUS = (
    "SELECT station_id, model_version, ts, count(*) AS n_votes, "
    + ", ".join(o.r(f"avg(pred_{f})", f"consensus_{f}") for f in FEATURES)
    + ", "
    + ", ".join(o.r(f"stddev_pop(pred_{f})", f"std_{f}") for f in FEATURES)
    + " FROM forecast WHERE {} GROUP BY 1, 2, 3"
)


@register(o.query(o.forecast(), CONSENSUS.format("true")))
def consensus_stats(spark, sf):
    return rounded(evaluation.consensus(_forecast(spark, sf)))


@register(
    o.query(
        o.forecast(),
        CONSENSUS.format("ts > (SELECT max(ts) FROM forecast WHERE created_at <= TIMESTAMP '2024-01-20')"),
    )
)
def consensus_incremental(spark, sf):
    forecast = _forecast(spark, sf)
    done = evaluation.high_water(forecast.where(F.col("created_at") <= times.instant("2024-01-20")))
    return rounded(evaluation.consensus(forecast, done))


@register(
    o.query(
        o.reconciled(),
        "\nUNION ALL ".join(
            f"""SELECT station_id, model_version, '{f}' AS feature, {o.r(f'avg(pred_{f})', 'avg_pred')},
  {o.r(f'avg(diff_{f})', 'avg_diff')}, count(*) FILTER (abs(drift_vs_bias_{f}) > 1.5) AS n_drift FROM reconciled GROUP BY 1, 2"""
            for f in FEATURES
        ),
    )
)
def drift_summary(spark, sf):
    return rounded(evaluation.drift_summary(_reconciled(spark, sf)))


KEY4 = "station_id, ts, model_version, horizon"


@register(
    o.query(
        [
            *o.forecast(),
            f"""fresh AS (SELECT station_id, ts + INTERVAL 1 DAY AS ts, model_version, horizon,
  created_at + INTERVAL 1 DAY AS created_at, {o.each('CASE WHEN horizon <> 2 THEN pred_# + 1 END AS pred_#')}, true AS given
  FROM forecast WHERE model_version = 'climatology')""",
        ],
        f"""SELECT {KEY4}, coalesce(n.created_at, o.created_at) AS created_at,
  {', '.join(o.r(f'CASE WHEN n.given THEN n.{p} ELSE o.{p} END', p) for p in o.PRED)}, o.ts_window_start
FROM forecast o FULL JOIN fresh n USING ({KEY4})""",
    )
)
def upsert_forecast(spark, sf):
    old = _forecast(spark, sf).drop("ts_window_stop")
    day = F.expr("INTERVAL '1' DAY")
    new = old.where("model_version = 'climatology'").drop("ts_window_start")
    new = new.withColumns({"ts": F.col("ts") + day, "created_at": F.col("created_at") + day})
    new = new.withColumns({p: F.when(F.col("horizon") != 2, F.col(p) + 1) for p in o.PRED})
    merged = sinks.merge_rows(old, new, ["station_id", "ts", "model_version", "horizon"])
    return rounded(merged.select(*KEY4.split(", "), "created_at", *o.PRED, "ts_window_start"))


RANGE = ("2024-01-10 06:00:00", "2024-01-12 18:00:00")
OUTSIDE = f"NOT (ts BETWEEN TIMESTAMP '{RANGE[0]}' AND TIMESTAMP '{RANGE[1]}')"


@register(o.query(o.hourly("user_id"), SERIES + f"clean WHERE {OUTSIDE}"))
def range_delete(spark, sf):
    return rounded(maintenance.keep_outside(t.hourly(spark, sf, "user_id"), *RANGE))


@register(
    o.query(
        o.hourly("user_id"),
        SERIES + f"(SELECT * FROM clean WHERE {OUTSIDE} UNION ALL SELECT * FROM res WHERE NOT ({OUTSIDE}))",
    )
)
def range_replace(spark, sf):
    kept = maintenance.keep_outside(t.hourly(spark, sf, "user_id"), *RANGE)
    fresh = resample.resample(resample.apply_offset(t.fleet(spark, sf)))
    fresh = fresh.where(F.col("ts").between(*[times.instant(x) for x in RANGE]))
    return rounded(kept.unionByName(fresh))


# --- serving ------------------------------------------------------------------------------


def _public(spark, sf):
    hours, forecast, matches, bias = _eval(spark, sf)
    forecast = sinks.materialise(forecast, session.run_folder(spark), "forecast")  # three readers below
    closed = evaluation.reconcile(forecast, matches, bias)
    mart = evaluation.quality_mart(forecast, hours, bias)
    return serving.public_export(closed.unionByName(forecast, allowMissingColumns=True), mart)


@register(
    o.query(o.public(), f"SELECT station_id, ts, created_at, model_version, {o.rounded(o.PUBLIC)} FROM public")
)
def public_export(spark, sf):
    return rounded(_public(spark, sf))


DAY_COLS = ["pred_temp", "diff_temp", "historical_bias_temp", "drift_vs_bias_temp", "temp_era5", "abs_error_temp"]


@register(
    o.query(
        o.public(),
        f"""SELECT station_id, ts, created_at, ts + INTERVAL 1 HOUR AS ts_local, {o.rounded(DAY_COLS)} FROM public
WHERE ts >= TIMESTAMP '2024-01-14 23:00:00' AND ts < TIMESTAMP '2024-01-15 23:00:00'""",
    )
)
def feature_day(spark, sf):
    return rounded(serving.feature_day(_public(spark, sf), "temp", "2024-01-15", ZONE))


SERIES_COLS = ["pred", "actual", "era5", "abs_error", "bias", "drift"]


@register(
    o.query(o.series(), f"SELECT station_id, ts, ts_local, local_day, feature, {o.rounded(SERIES_COLS)} FROM series")
)
def daily_feature_series(spark, sf):
    return rounded(serving.daily_series(_public(spark, sf), ZONE))


@register(
    o.query(
        o.series(),
        f"""SELECT station_id, local_day, feature, {o.r('avg(abs_error)', 'mae_era5')}, {o.r('coalesce(avg(bias), 0)', 'mean_bias')},
  {o.r('coalesce(avg(drift), 0)', 'mean_drift')}, bool_or(era5 IS NOT NULL) AS has_era5 FROM series GROUP BY 1, 2, 3""",
    )
)
def daily_kpis(spark, sf):
    return rounded(serving.daily_kpis(serving.daily_series(_public(spark, sf), ZONE)))


def _inspect_sql(f: str) -> str:
    text = lambda x, form: f"CASE WHEN {x} IS NULL THEN '-' ELSE printf('{form}', {x}) END"
    plain, sign = "%.2f", "%+.2f"
    drift = f"drift_vs_bias_{f}"
    return f"""SELECT station_id, ts, model_version, '{f}' AS feature, {text(f'pred_{f}', plain)} AS pred,
  {text(f'pred_{f} - diff_{f}', plain)} AS actual, {text(f'diff_{f}', sign)} AS diff, {text(f'{f}_era5', plain)} AS era5,
  {text(f'pred_{f} - {f}_era5', sign)} AS err_era5, {text(f'historical_bias_{f}', sign)} AS bias,
  CASE WHEN {drift} IS NULL THEN '-' WHEN abs({drift}) > 1.5 THEN printf('DRIFT(%+.2f)', {drift})
  ELSE printf('OK(%+.2f)', {drift}) END AS drift_status FROM public"""


@register(o.query(o.public(), "\nUNION ALL ".join(_inspect_sql(f) for f in FEATURES)))
def forecast_inspector(spark, sf):
    return serving.inspector(_public(spark, sf))


@register("SELECT DISTINCT (ts + INTERVAL 1 HOUR)::date AS day FROM events")
def available_dates(spark, sf):
    return serving.available_dates(t.table(spark, sf, "events"), ZONE)


@register(
    """SELECT event_id, ts + INTERVAL 1 HOUR AS ts_local, ts - INTERVAL 1 HOUR AS ts_if_local,
  (ts + INTERVAL 1 HOUR)::date AS local_day, ts >= TIMESTAMP '2024-01-14 23:00:00' AND ts < TIMESTAMP '2024-01-15 23:00:00' AS on_day
FROM events"""
)
def local_time_view(spark, sf):
    ts = F.col("ts")
    start, end = times.local_day_bounds("2024-01-15", ZONE)
    return t.table(spark, sf, "events").select(
        "event_id",
        times.to_local(ts, ZONE).alias("ts_local"),
        times.to_utc(ts, ZONE).alias("ts_if_local"),
        F.to_date(times.to_local(ts, ZONE)).alias("local_day"),
        ((ts >= start) & (ts < end)).alias("on_day"),
    )


@register(
    """WITH f AS (
  SELECT 'events' AS table_name, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_rows FROM events
  UNION ALL SELECT 'orders', min(o_orderdate), max(o_orderdate), count(*) FROM orders
  UNION ALL SELECT 'lineitem', min(l_shipdate), max(l_shipdate), count(*) FROM lineitem)
SELECT *, last_ts = (SELECT max(last_ts) FROM f) AS is_latest FROM f"""
)
def freshness_audit(spark, sf):
    names = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}
    return profiling.freshness({n: (t.table(spark, sf, n), c) for n, c in names.items()})


@register(
    """SELECT station_id, event_id, ts, value, row_number() OVER (PARTITION BY station_id ORDER BY ts) AS position
FROM (SELECT event_type AS station_id, event_id, ts, value FROM events
  QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) <= 24)"""
)
def latest_rows(spark, sf):
    rows = t.table(spark, sf, "events").withColumnRenamed("event_type", "station_id")
    last = profiling.latest_rows(rows, 24, tie=("event_id",))
    from pyspark.sql import Window as W

    place = F.row_number().over(W.partitionBy("station_id").orderBy("ts")).cast("bigint")
    return last.select("station_id", "event_id", "ts", "value", place.alias("position"))


@register(
    """SELECT event_id, ts, event_type, value FROM events ORDER BY ts DESC, event_id LIMIT 50"""
)
def latest_events(spark, sf):
    rows = t.table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    return profiling.latest(rows, 50, tie=("event_id",))


@register(
    o.query(
        [
            *o.features(),
            o.REFS,
            DELTAS,
            f"means2 AS (SELECT station_id, horizon, {o.each('avg(#) AS #')} FROM deltas GROUP BY 1, 2)",
            "lasts AS (SELECT * FROM gapfree QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY ts DESC) = 1)",
        ],
        f"""SELECT station_id, l.ts AS origin, horizon, l.ts + INTERVAL 1 HOUR * horizon AS ts,
  {', '.join(o.r(f'l.{f} + m.{f}', f'pred_{f}') for f in FEATURES)} FROM lasts l JOIN means2 m USING (station_id)""",
    )
)
def last_actual_plus_delta(spark, sf):
    rows = _samples(spark, sf).select("station_id", F.posexplode("y").alias("h", "v"))
    deltas = rows.groupBy("station_id", (F.col("h") + 1).alias("horizon")).agg(
        *[F.avg(F.col("v")[j]).alias(f"delta_{f}") for j, f in enumerate(FEATURES)]
    )
    series = resample.interpolate_all(t.hourly(spark, sf))
    return rounded(evaluation.last_actual_plus_delta(series, deltas))


# --- data tests ---------------------------------------------------------------------------


def _range_sql(table: str, rules: dict, columns: dict, bad: str) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT 'accepted_range_{c}' AS rule, '{c}' AS column_name, n AS n_failed, CASE WHEN n = 0 THEN 'pass' ELSE '{bad}' END AS status
FROM (SELECT count(*) FILTER (NOT {columns.get(c, c)} BETWEEN {lo} AND {hi}) AS n FROM {table})"""
        for c, (lo, hi) in rules.items()
    )


@register(
    o.query([*o.tel(), RAW, STAGED], _range_sql("staged", STAGING_RANGES, {}, "fail"))
)
def dq_range_rules(spark, sf):
    return quality.range_rules(staging.stage(_raw(spark, sf)), STAGING_RANGES)


@register(o.query([*o.matches("user_id"), o.BIAS], _range_sql("bias", BIAS_RANGES, {}, "warn")))
def dq_bias_ranges(spark, sf):
    return quality.range_rules(matching.bias_table(t.matches(spark, sf, "user_id")), BIAS_RANGES, "warn")


@register(
    o.query(
        [*o.tel(), RAW, "counts AS (SELECT station_id, ts, count(*) AS n FROM raw GROUP BY 1, 2)"],
        """SELECT *, CASE WHEN n_failed = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
  SELECT 'not_null' AS rule, coalesce(sum(n) FILTER (station_id IS NULL OR ts IS NULL), 0)::bigint AS n_failed FROM counts
  UNION ALL SELECT 'unique', count(*) FILTER (n > 1) FROM counts)""",
    )
)
def dq_key_tests(spark, sf):
    return quality.key_rules(_raw(spark, sf), ["station_id", "ts"])


HELD = """raw2 AS (SELECT CASE WHEN event_id % 9 = 0 THEN NULL ELSE station_id END AS station_id,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE ts END AS ts, * EXCLUDE (station_id, ts) FROM raw)"""


@register(
    o.query(
        [
            *o.tel(),
            RAW.replace("SELECT station_id, date_trunc", "SELECT event_id, station_id, date_trunc"),
            HELD,
            STAGED.replace("FROM raw", "FROM raw2"),
            "kept AS (SELECT * FROM staged WHERE station_id IS NOT NULL AND ts IS NOT NULL)",
            "copies AS (SELECT station_id, ts, count(*) AS n FROM raw2 GROUP BY 1, 2)",
        ],
        "SELECT rule, n_failed::bigint AS n_failed, CASE WHEN rule IN ('rows', 'staged_rows') OR rule LIKE 'null%' THEN 'info' WHEN n_failed = 0 THEN 'pass' ELSE 'fail' END AS status FROM (\n"
        "  SELECT 'rows' AS rule, (SELECT count(*) FROM raw2) AS n_failed UNION ALL SELECT 'staged_rows', (SELECT count(*) FROM kept)\n"
        "  UNION ALL SELECT 'not_null', coalesce(sum(n) FILTER (station_id IS NULL OR ts IS NULL), 0) FROM copies\n"
        "  UNION ALL SELECT 'unique', count(*) FILTER (n > 1 AND station_id IS NOT NULL AND ts IS NOT NULL) FROM copies\n"
        + "".join(
            f"  UNION ALL SELECT 'accepted_range_{c}', count(*) FILTER (NOT ({c} BETWEEN {lo} AND {hi})) FROM kept\n" for c, (lo, hi) in STAGING_RANGES.items()
        )
        + "".join(f"  UNION ALL SELECT 'null_{c}', count(*) FILTER ({c} IS NULL) FROM kept\n" for c in STD)
        + "  UNION ALL SELECT 'minimum_rows', greatest(100 - count(*), 0) FROM kept)",
    )
)
def dq_write_pass(spark, sf):
    """All checks of staged telemetry, counted while it is written, with no scan of their own."""
    raw = _raw(spark, sf)
    part = lambda c, n: F.when(F.col("event_id") % n != 0, F.col(c)).alias(c)
    raw = raw.select(part("station_id", 9), part("ts", 13), *[c for c in raw.columns if c not in ("station_id", "ts")])
    found = sinks.write_staged(spark, raw, f"{session.run_folder(spark)}/staged", STAGING_RANGES, 100)
    return quality.report(spark, found)


BAD = " OR ".join(
    [f"{p}_{f} IS NULL" for p in ("pred", "actual", "abs_error") for f in FEATURES]
    + [f"{p}_{f} < 0" for p in ("pred", "actual") for f in ("wind", "solar", "rain")]
    + [f"abs_error_{f} < 0" for f in FEATURES]
    + [f"{p}_pres <= 0 OR {p}_rh < 0 OR {p}_rh > 100" for p in ("pred", "actual")]
    + [
        "(ts <= TIMESTAMP '2024-01-24 23:00:00' AND ("
        + " OR ".join(
            [f"{f}_era5 IS NULL" for f in FEATURES]
            + ["pres_era5 <= 0", "rh_era5 < 0", "rh_era5 > 100"]
            + [f"{f}_era5 < 0" for f in ("wind", "solar", "rain")]
        )
        + "))"
    ]
)


@register(o.query(o.mart(), f"SELECT station_id, ts, model_version, created_at FROM mart WHERE {BAD}"))
def dq_sanity_rule(spark, sf):
    bad = quality.sanity_failures(_mart(spark, sf), AS_OF)
    return bad.select("station_id", "ts", "model_version", "created_at")


@register(
    o.query([*o.matches("user_id"), o.BIAS], "SELECT count(*) AS n_rows, count(*) >= 100 AS passes FROM bias")
)
def dq_row_gate(spark, sf):
    return profiling.row_gate(matching.bias_table(t.matches(spark, sf, "user_id")))


# --- maintenance --------------------------------------------------------------------------

RUNS = """runs AS (SELECT station_id, coalesce(min(prev) FILTER (epoch(ts - prev) > 4500), max(ts)) AS continuous_end
  FROM (SELECT station_id, ts, lag(ts) OVER (PARTITION BY station_id ORDER BY ts) AS prev FROM res) GROUP BY 1)"""


@register(
    o.query(
        [
            *o.tel("user_id"),
            o.HOURLY,
            RUNS,
            """late AS (SELECT r.*, l.last_telemetry FROM runs r
  JOIN (SELECT station_id, max(ts) AS last_telemetry FROM tel GROUP BY 1) l USING (station_id)
  WHERE epoch(last_telemetry - continuous_end) > 7200)""",
            """slots AS (SELECT *, unnest(generate_series(continuous_end + INTERVAL 1 HOUR, date_trunc('hour', last_telemetry), INTERVAL 1 HOUR)) AS ts FROM late)""",
        ],
        "SELECT station_id, continuous_end, last_telemetry, ts FROM slots ANTI JOIN res USING (station_id, ts)",
    )
)
def continuity_gap_plan(spark, sf):
    tel = t.fleet(spark, sf)
    made = resample.resample(tel).select("station_id", "ts")
    return maintenance.bridge_plan(made, tel).select("station_id", "continuous_end", "last_telemetry", "ts")


@register(
    """SELECT station_id, last_run, floor(epoch(TIMESTAMP '2024-01-20 12:00:00' - last_run)) / 3600 < 1 AS skip,
  floor(floor(epoch(TIMESTAMP '2024-01-20 12:00:00' - last_run)) / 3600 * 1e6 + 0.5) / 1e6 AS age_hours
FROM (SELECT event_type AS station_id, max(ts) AS last_run FROM events WHERE ts <= TIMESTAMP '2024-01-20 12:00:00' GROUP BY 1)"""
)
def forecast_freshness(spark, sf):
    runs = t.table(spark, sf, "events").select(F.col("event_type").alias("station_id"), "ts")
    return rounded(maintenance.should_skip(runs, "2024-01-20 12:00:00", 1, ["station_id"])).select(
        "station_id", "last_run", "skip", "age_hours"
    )


@register(
    """SELECT o_orderpriority, strftime(unnest(generate_series(date_trunc('month', min(o_orderdate)),
  date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)), '%Y-%m') AS month FROM orders GROUP BY 1"""
)
def month_sequence(spark, sf):
    return maintenance.month_sequence(t.table(spark, sf, "orders"), "o_orderdate", ["o_orderpriority"])


@register(
    o.query(
        [
            *o.tel("user_id"),
            """ends AS (SELECT station_id, max(ts) AS last_ts, floor(epoch(TIMESTAMP '2024-02-20 12:00:00' - max(ts)))::bigint AS gap FROM tel GROUP BY 1)""",
            """aged AS (SELECT t.*, gap, floor(epoch(last_ts - ts)) AS age, gap // 604800 AS blocks FROM tel t JOIN ends USING (station_id))""",
            """copies AS (
  SELECT *, unnest(generate_series(1, blocks)) * 604800 AS shift FROM aged WHERE age < 604800
  UNION ALL SELECT *, gap FROM aged WHERE age < gap - blocks * 604800)""",
        ],
        """SELECT * FROM (SELECT station_id, ts + INTERVAL 1 SECOND * shift AS ts, event_id, """
        + o.rounded(FEATURES)
        + """ FROM copies) WHERE ts <= TIMESTAMP '2024-02-20 12:00:00'
  AND (station_id, ts) NOT IN (SELECT (station_id, ts) FROM tel)""",
    )
)
def replay_extend(spark, sf):
    return rounded(maintenance.replay_extend(t.fleet(spark, sf), "2024-02-20 12:00:00"))


@register(
    """SELECT c_custkey::varchar AS station_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Default Station' ELSE c_name END AS station_name,
  c_nationkey / 2::double AS latitude, 0::double AS longitude, h AS elevation_m, h AS height_above_ground_m,
  14 AS min_training_days, 30 AS retrain_window_days, TIMESTAMP '2024-01-30 23:00:00' AS updated_at
FROM (SELECT *, CASE WHEN c_acctbal > 0 THEN floor(c_acctbal) WHEN c_nationkey <= 0 THEN 2
  ELSE round(c_nationkey * 3 + 1.5) END::int AS h FROM customer)"""
)
def station_dimension(spark, sf):
    text = lambda c: F.col(c).cast("string")
    config = t.table(spark, sf, "customer").select(
        text("c_custkey").alias("station_id"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).otherwise(" ").alias("station_name"),
        (F.col("c_nationkey") / 2).cast("string").alias("latitude"),
        F.lit("").alias("longitude"),
        F.when(F.col("c_acctbal") > 0, text("c_acctbal")).otherwise("").alias("elevation"),
        text("c_nationkey").alias("floor"),
        F.lit("").alias("min_training_days"),
        F.lit("30").alias("retrain_window_days"),
    )
    return stations.dimension(config, AS_OF)
