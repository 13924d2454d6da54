"""Registered streaming queries; each must equal its batch counterpart."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import oracle as o
from checks import tables as t
from checks.queries import FORECAST_COLS, GAPS, CONSENSUS, MATCH_COLS, MINUTES, register, rounded
from meteospark import session
from meteospark.catalog import FEATURES
from meteospark.functions import times
from meteospark.operators import evaluation, matching
from meteospark.sources import sinks
from meteospark.streaming import jobs, state

RUN = ["station_id", "ts", "model_version", "horizon"]


def _stream(spark, path, **options):
    """A stored table as a stream."""
    schema = spark.read.options(**options).parquet(path).schema
    return spark.readStream.schema(schema).options(**options).parquet(path)


def _by_month(df, folder, name, at="ts"):
    path = f"{folder}/{name}"
    df.withColumn("month", times.month_of(F.col(at))).write.partitionBy("month").parquet(path)
    return path


def _arriving(spark, sf, folder):
    """Readings in sendings that overlap in time, one of them sent twice, one sending a batch. A sending is as
    many files as tasks run at once, so neither its writing nor its batch is the work of one task."""
    events, files = t.table(spark, sf, "events"), spark.sparkContext.defaultParallelism
    for part in (0, 1, 2, 1):
        sent = events.where(F.col("event_id") % 3 == part).repartition(files, "event_id")
        t.readings(sent, "event_type").write.mode("append").parquet(f"{folder}/in")
    return _stream(spark, f"{folder}/in", maxFilesPerTrigger=files)


@register(o.query([*o.tel(), o.HOURLY], f"SELECT station_id, ts, {o.rounded(FEATURES)} FROM res"))
def stream_hourly(spark, sf):
    """Hourly means of all readings, late ones and open slots included."""
    folder = session.run_folder(spark)
    tel = _arriving(spark, sf, folder).withColumn("temp", F.col("temp") - 1.5)
    handle = jobs.hourly_arrivals(spark, f"{folder}/readings", f"{folder}/hours", ["station_id", "ts", "event_id"])
    jobs.run_batches(tel, handle, f"{folder}/cp")
    return rounded(spark.read.parquet(f"{folder}/hours").drop("month"))


@register(
    o.query(
        o.tel(),
        """SELECT station_id, date_trunc('minute', ts) AS ts, event_id, floor(temp * 1e6 + 0.5) / 1e6 AS temp FROM tel
QUALIFY row_number() OVER (PARTITION BY station_id, date_trunc('minute', ts) ORDER BY event_id) = 1""",
    )
)
def stream_dedup(spark, sf):
    """The smallest event of each station and minute, whenever it arrives."""
    folder = session.run_folder(spark)
    tel = _arriving(spark, sf, folder).select("station_id", times.floor_minute(F.col("ts")).alias("ts"), "event_id", "temp")
    handle = jobs.dedup_arrivals(spark, f"{folder}/minutes", ["station_id", "ts"], ["event_id"])
    jobs.run_batches(tel, handle, f"{folder}/cp")
    return rounded(spark.read.parquet(f"{folder}/minutes").drop("month"))


@register(o.query([*o.tel(), MINUTES, GAPS], "SELECT * FROM gaps"))
def stream_gap_alarm(spark, sf):
    """Minute gaps; late readings split those already announced."""
    folder = session.run_folder(spark)
    handle = jobs.gap_arrivals(spark, f"{folder}/minutes", f"{folder}/gaps")
    times_only = _arriving(spark, sf, folder).select("station_id", "ts")  # a batch is stored with what is asked of it
    jobs.run_batches(times_only, handle, f"{folder}/cp")
    return sinks.read_table(spark, f"{folder}/gaps").drop("month")


@register(
    o.query(
        o.reconciled(),
        f"SELECT {FORECAST_COLS}, {o.rounded(o.RECONCILED_COLS)}, {o.r('drift_vs_bias_temp', 'drift_vs_bias')} FROM reconciled",
    )
)
def stream_reconcile(spark, sf):
    """Arriving observations close stored forecasts."""
    folder = session.run_folder(spark)
    hours = t.hourly_table(spark, sf)
    matches = sinks.materialise(t.matches(spark, sf, hours=hours), folder, "joined")
    arrivals = _by_month(matches, folder, "matches")
    bias = _by_month(matching.bias_table(matches), folder, "bias")
    stored = _by_month(t.baselines(hours), folder, "forecast")
    handle = jobs.reconcile_arrivals(spark, stored, bias, RUN)
    jobs.run_batches(_stream(spark, arrivals).drop("month"), handle, f"{folder}/cp")
    return rounded(spark.read.option("mergeSchema", True).parquet(stored).drop("month"))


@register(o.query(o.matches(), f"SELECT station_id, ts, {o.rounded(MATCH_COLS)} FROM matches"))
def stream_rematch(spark, sf):
    """Late reanalysis replaces the stored matches of its hours."""
    folder = session.run_folder(spark)
    hours = t.hourly_table(spark, sf)
    places = t.busy_stations(spark, sf)
    grid = sinks.materialise(t.grid(spark, sf), folder, "cells")
    known = matching.match(hours, grid.where("valid_time < '2024-01-20'"), places)
    stored = _by_month(known, folder, "matches")
    hours_path = _by_month(hours, folder, "hours")
    grid_path = _by_month(grid, folder, "grid", "valid_time")
    handle = jobs.rematch_late_grid(spark, hours_path, grid_path, places, stored)
    jobs.run_batches(_stream(spark, grid_path).drop("month"), handle, f"{folder}/cp")
    return rounded(spark.read.parquet(stored).drop("month"))


@register(o.query(o.forecast(), CONSENSUS.format("true")))
def stream_consensus(spark, sf):
    """Arriving forecast runs re-aggregate the targets they touch."""
    folder = session.run_folder(spark)
    stored = _by_month(t.baselines(t.hourly_table(spark, sf)), folder, "forecast")
    handle = jobs.consensus_arrivals(spark, stored, f"{folder}/stats")
    jobs.run_batches(_stream(spark, stored).drop("month"), handle, f"{folder}/cp")
    return rounded(spark.read.parquet(f"{folder}/stats").drop("month"))


@register(
    o.query(
        o.reconciled(),
        f"SELECT {FORECAST_COLS}, {o.rounded(o.RECONCILED_COLS)}, {o.r('drift_vs_bias_temp', 'drift_vs_bias')} FROM reconciled",
    )
)
def stream_late_bias(spark, sf):
    """Forecasts closed before their reanalysis are mended when it arrives."""
    folder = session.run_folder(spark)
    hours = t.hourly_table(spark, sf)
    places = t.busy_stations(spark, sf)
    grid = sinks.materialise(t.grid(spark, sf), folder, "cells")
    early = sinks.materialise(matching.match(hours, grid.where("valid_time < '2024-01-20'"), places), folder, "early")
    matched = _by_month(early, folder, "matches")
    first = evaluation.reconcile(t.baselines(hours), early, matching.bias_table(early))
    stored = _by_month(first, folder, "forecast")
    hours_path = _by_month(hours, folder, "hours")
    grid_path = _by_month(grid, folder, "grid", "valid_time")
    handle = jobs.rematch_late_grid(spark, hours_path, grid_path, places, matched, stored, RUN)
    jobs.run_batches(_stream(spark, grid_path).drop("month"), handle, f"{folder}/cp")
    return rounded(spark.read.option("mergeSchema", True).parquet(stored).drop("month"))


def _in_order(spark, sf, folder, parts=4):
    """Readings in files that follow each other in time, and two later readings of another station."""
    tel = t.telemetry(spark, sf).select("station_id", "ts")
    lo, hi = tel.agg(F.min("ts"), F.max("ts")).first()
    step = (hi - lo) / parts
    for k in range(parts):
        after = F.col("ts") >= F.lit(lo + k * step)
        part = tel.where(after if k == parts - 1 else after & (F.col("ts") < F.lit(lo + (k + 1) * step)))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    _clock(tel, f"{folder}/in", hi)
    return _stream(spark, f"{folder}/in", maxFilesPerTrigger=1)


def _clock(df, path, last, at="ts"):
    """Appends two rows of a station named clock, days later, in files of their own: event time goes on."""
    for days in (3, 6):
        row = df.sparkSession.range(1).select(
            *[
                (F.lit(last) + F.expr(f"INTERVAL '{days}' DAY") if c == at else F.lit("clock") if c == "station_id" else F.lit(None)).cast(kind).alias(c)
                for c, kind in df.dtypes
            ]
        )
        row.coalesce(1).write.mode("append").parquet(path)


@register(
    o.query(
        [*o.tel(), MINUTES, GAPS],
        """SELECT station_id, gap_start, gap_end, missing_min, false AS is_open FROM gaps UNION ALL
SELECT station_id, max(ts) + INTERVAL 1 MINUTE, NULL, NULL, true FROM minutes GROUP BY 1""",
    )
)
def stream_silence_alarm(spark, sf):
    """Gaps by keyed state and timers: in the end every station is silent and has an open gap."""
    folder = session.run_folder(spark)
    state.use_rocksdb(spark)
    try:
        alarms = state.silence_alarms(_in_order(spark, sf, folder), delay="10 minutes", limit=15)
        state.run_stateful(alarms, state.keep_alarms(spark, f"{folder}/alarms"), f"{folder}/cp")
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    return sinks.read_table(spark, f"{folder}/alarms").where("station_id <> 'clock'").drop("month")


@register(o.query([*o.tel(), o.HOURLY], f"SELECT station_id, ts, {o.rounded(FEATURES)} FROM res"))
def stream_late_path(spark, sf):
    """Hourly means by windowed state for the near past; what comes behind the mark is recomputed from
    stored rows. Files overlap in time and one comes twice, so most rows are late."""
    folder = session.run_folder(spark)
    tel = _arriving(spark, sf, folder).withColumn("temp", F.col("temp") - 1.5)
    near, late, hours, identity = f"{folder}/near", f"{folder}/late", f"{folder}/hours", ["station_id", "ts", "event_id"]
    jobs.run_batches(tel, state.split_late(spark, near, late, 120), f"{folder}/cp-split")
    schema = ", ".join(f"{c} {kind}" for c, kind in [*tel.dtypes, ("batch", "int"), ("month", "string")])
    rows = spark.readStream.schema(schema).parquet(near).drop("batch", "month")
    keep = lambda batch, _: sinks.upsert(spark, batch, hours, ["station_id", "ts"])
    state.run_stateful(state.near_hours(rows, identity, 120), keep, f"{folder}/cp-near", "update")
    mend = state.late_hours(spark, near, late, hours, schema, identity)
    jobs.run_batches(spark.readStream.schema(schema).parquet(late), mend, f"{folder}/cp-late")
    return rounded(sinks.read_table(spark, hours).drop("month"))


@register(
    o.query(
        o.reconciled(),
        f"SELECT {FORECAST_COLS}, {o.rounded(o.RECONCILED_COLS)}, {o.r('drift_vs_bias_temp', 'drift_vs_bias')} FROM reconciled",
    )
)
def stream_paired(spark, sf):
    """Two streams, forecasts and observations, joined by hour; a tenth of the observations comes too late
    for the join and is mended by the handler."""
    folder = session.run_folder(spark)
    hours = t.hourly_table(spark, sf)
    matches = sinks.materialise(t.matches(spark, sf, hours=hours), folder, "joined")
    forecast = sinks.materialise(t.baselines(hours), folder, "made")
    bias = _by_month(matching.bias_table(matches), folder, "bias")
    is_late = F.pmod(F.xxhash64("station_id", "ts"), F.lit(10)) == 0
    for rows, path in ((forecast, f"{folder}/forecasts"), (matches.where(~is_late), f"{folder}/observed")):
        rows.coalesce(1).write.parquet(path)
        _clock(rows, path, rows.agg(F.max("ts")).first()[0])
    one = {"maxFilesPerTrigger": 1}
    paired = state.paired_forecasts(_stream(spark, f"{folder}/forecasts", **one), _stream(spark, f"{folder}/observed", **one))
    stored = f"{folder}/stored"
    state.run_stateful(paired, state.keep_paired(spark, stored, bias, RUN), f"{folder}/cp")
    late = _by_month(matches.where(is_late), folder, "late")
    jobs.run_batches(_stream(spark, late).drop("month"), jobs.reconcile_arrivals(spark, stored, bias, RUN), f"{folder}/cp-late")
    return rounded(sinks.read_table(spark, stored).where("station_id <> 'clock'").drop("month"))
